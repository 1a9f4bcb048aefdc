"""Train, validation and test splits that keep related records together.

Related records are grouped by a distributed union-find. Every key (a case, a speaker) links its records to the smallest
of them; links are partitioned by record, each task unites its links into a local forest of stars, and the stars of all
tasks are merged again, with shortcuts in between, until every record points to the smallest of its group. A task holds at
most LINKS links; a graph of fewer is finished by the first task. Groups are then dealt to the split that is furthest
below its target, largest first, by classes of equal size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.session import durable

#: Links that one task unites.
LINKS = 500_000
#: Blocks in which the groups of one size are counted off.
BLOCKS = 1024


def docket_key(docket: Column) -> Column:
    """A docket however written: without No., #, spaces and leading zeros, with plain hyphens; null for null or empty."""
    s = F.lower(F.regexp_replace(docket, "[‐-―−]", "-"))
    s = F.regexp_replace(s, r"\bnos?\b\.?|#|\s+| ", "")
    s = F.regexp_replace(F.regexp_replace(s, r"^[.,;:-]+|[.,;:-]+$", ""), r"(?<![0-9])0+(?=[0-9])", "")
    return F.when(F.length(s) > 0, s)


def _forest(links: DataFrame) -> DataFrame:
    """Stars of each partition's links: every node but the smallest of its tree points to that one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        for b in batches:
            for v, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parent.setdefault(v, v)
                parent.setdefault(p, p)
                while parent[v] != v:
                    parent[v] = parent[parent[v]]
                    v = parent[v]
                while parent[p] != p:
                    parent[p] = parent[parent[p]]
                    p = parent[p]
                if v < p:
                    parent[p] = v
                elif p < v:
                    parent[v] = p
        vs, ps = [], []
        for v in parent:
            r = v
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            if r != v:
                vs.append(v)
                ps.append(r)
        yield pa.RecordBatch.from_pydict({"v": pa.array(vs, pa.int64()), "p": pa.array(ps, pa.int64())})

    return links.select("v", "p").mapInArrow(run, "v bigint, p bigint")


def united(links: DataFrame, links_per_task: int = LINKS, rounds: int = 64) -> DataFrame:
    """(v, p): every linked node but the smallest of its group, with that smallest one. Links are pairs of ids in any order; null ones are left out."""
    links = links.where("v is not null and p is not null and v <> p").select(F.greatest("v", "p").alias("v"), F.least("v", "p").alias("p")).distinct()
    links = durable(links)
    for _ in range(rounds):
        n = links.count()
        tasks = max(1, math.ceil(n / links_per_task))
        # by node, so that all the parents of a node meet
        links = durable(_forest(links.repartition(tasks, "v") if tasks > 1 else links.coalesce(1)).distinct())
        if tasks == 1:
            return links
        up = links.groupBy(F.col("v").alias("p")).agg(F.min("p").alias("pp"))
        # the parents of a node's parents; the other side has one row per node, so a node with many children is split by the skew join
        jumped = durable(links.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p"), (F.col("pp").isNotNull()).alias("moved")))
        open_ends = jumped.where("moved").limit(1).count() + jumped.select("v", "p").distinct().groupBy("v").count().where("count > 1").limit(1).count()
        # a jump over a parent keeps the link between that parent and its own
        links = durable(jumped.select("v", "p").unionByName(links.groupBy("v").agg(F.min("p").alias("p"))).distinct())
        if not open_ends:
            return links
    raise RuntimeError("the groups did not settle")


def related_groups(members: DataFrame, links_per_task: int = LINKS) -> DataFrame:
    """(id, group_id) for every record that shares a key with another, itself or through others, but the smallest of its group.

    members: (id, key), rows with a null in either are left out, repeated rows count once. A key of any number of records
    is reduced to its smallest one by an aggregate that combines before the shuffle.
    """
    pairs = members.where("id is not null and key is not null").distinct()
    least = pairs.groupBy("key").agg(F.min("id").alias("p"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "p")
    links = pairs.join(least, "key").select(F.col("id").alias("v"), "p")
    return united(links, links_per_task).select(F.col("v").alias("id"), F.col("p").alias("group_id"))


def deal(classes: list[tuple[int, int]], shares: list[float]) -> list[tuple[int, list[int]]]:
    """How many groups of each size every split gets: largest first, each to the split furthest below its target.

    classes: (size, number of groups). Runs of equal steps are taken at once, so the work follows the number of sizes.
    """
    whole = sum(s * n for s, n in classes)
    total = sum(shares) or 1.0
    room = [whole * x / total for x in shares]
    out = []
    for size, n in sorted(classes, reverse=True):
        got = [0] * len(shares)
        while n:
            order = sorted(range(len(room)), key=lambda i: (-room[i], i))
            first = order[0]
            second = room[order[1]] if len(order) > 1 else -math.inf
            take = n if second == -math.inf else min(n, max(1, math.floor((room[first] - second) / size)))
            if take == 1 and n > 4 * len(room) and room[order[0]] - room[order[-1]] < size:
                each = n // len(room)  # all are level: whole rounds
                for i in order:
                    got[i] += each
                    room[i] -= each * size
                n -= each * len(room)
                continue
            got[first] += take
            room[first] -= take * size
            n -= take
        out.append((size, got))
    return out


def assign_splits(records: DataFrame, groups: DataFrame, targets: list[tuple[str, float]]) -> DataFrame:
    """(id, group_id, split_name) of every record; ``records`` has ``id``, ``groups`` what ``related_groups`` gives.

    Records of one group share a split. The number of different group sizes (below the square root of twice the number of
    records) is what comes to the driver.
    """
    spark = records.sparkSession
    member = records.select("id").where("id is not null").distinct().join(groups, "id", "left").select("id", F.coalesce("group_id", "id").alias("group_id"))
    sizes = durable(member.groupBy("group_id").agg(F.count(F.lit(1)).alias("size")).withColumn("block", F.pmod(F.xxhash64("group_id"), F.lit(BLOCKS))))
    per_block = sizes.groupBy("size", "block").agg(F.count(F.lit(1)).alias("n"))
    classes = [(r["size"], r["n"]) for r in per_block.groupBy("size").agg(F.sum("n").alias("n")).collect()]
    rows = []
    for size, got in deal(classes, [t for _, t in targets]):
        at = 0
        for (name, _), n in zip(targets, got):
            if n:
                rows.append((size, at, at + n, name))
            at += n
    ranges = spark.createDataFrame(rows, "size bigint, lo bigint, hi bigint, split_name string")
    offset = per_block.select("size", "block", F.coalesce(F.sum("n").over(
        Window.partitionBy("size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    w = Window.partitionBy("size", "block").orderBy(F.xxhash64("group_id", F.lit(1)), "group_id")
    ranked = sizes.withColumn("r", F.row_number().over(w) - 1).join(offset, ["size", "block"]).withColumn("r", F.col("r") + F.col("before"))
    # three rows per size at most
    placed = ranked.join(F.broadcast(ranges), "size").where("r >= lo and r < hi").select("group_id", "split_name")
    return member.join(placed, "group_id").select("id", "group_id", "split_name")
