"""Mixing sources to target weights.

Every text of a source is to be taken the same expected number of times. Whole copies are plain; what is left over is a
probability, rounded by the pivotal method: two texts with fractions trade mass, keeping their tokens in sum and each
one's expectation, until one is taken or not. Tasks trade within their rows, then the one open text that each task and
source has left over trades with others in a tree of rounds, until one is left in a source.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.session import durable

#: Open texts that one step of the tree trades.
FAN_IN = 64
OPEN = "source string, doc_id bigint, tokens bigint, copies bigint, p double, settled boolean"


def chance(seed: int, *parts: object) -> float:
    """A number in [0, 1) that a seed and some keys determine."""
    h = zlib.crc32(repr((seed, *parts)).encode())
    return ((h * 2654435761 + (h >> 13)) & 0xFFFFFFFF) / 4294967296.0


def trade(p: float, v: float, q: float, w: float, u: float) -> tuple[float, float]:
    """Move mass between fractions p and q of sizes v and w, keeping p*v + q*w and each one's expectation; one becomes 0 or 1."""
    up = min((1 - p) * v, q * w)
    down = min(p * v, (1 - q) * w)
    d = up if u * (up + down) < down else -down
    a, b = p + d / v, q - d / w
    snap = lambda x: 0.0 if x < 1e-12 else 1.0 if x > 1 - 1e-12 else x
    return snap(a), snap(b)


def _round(rows: Iterator[tuple], seed: int, last: bool) -> Iterator[tuple]:
    """Trade in order of arrival within each source; with ``last`` an open text that is left is settled by chance."""
    open_: dict[str, list] = {}
    for source, doc, tokens, copies, p, settled in rows:
        if settled or p <= 0.0 or p >= 1.0 or tokens <= 0:
            if not settled and 0.0 < p < 1.0:  # without size it can't trade, and weighs nothing
                p = 1.0 if chance(seed, "alone", source, doc) < p else 0.0
            yield source, doc, tokens, copies + int(p >= 1.0) if not settled else copies, 0.0, True
            continue
        held = open_.get(source)
        if held is None:
            open_[source] = [doc, tokens, copies, p]
            continue
        a, b = trade(held[3], held[1], p, tokens, chance(seed, source, held[0], doc))
        if 0.0 < a < 1.0:
            yield source, doc, tokens, copies + int(b >= 1.0), 0.0, True
            held[3] = a
        else:
            yield source, held[0], held[1], held[2] + int(a >= 1.0), 0.0, True
            if 0.0 < b < 1.0:
                open_[source] = [doc, tokens, copies, b]
            else:
                yield source, doc, tokens, copies + int(b >= 1.0), 0.0, True
                del open_[source]
    for source, (doc, tokens, copies, p) in open_.items():
        if last:
            yield source, doc, tokens, copies + int(chance(seed, "end", source, doc) < p), 0.0, True
        else:
            yield source, doc, tokens, copies, p, False


def _traded(df: DataFrame, seed: int, last: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        buf: list[tuple] = []

        def out() -> pa.RecordBatch:
            c = list(zip(*buf)) if buf else [[]] * 6
            return pa.RecordBatch.from_pydict({
                "source": pa.array(c[0], pa.string()), "doc_id": pa.array(c[1], pa.int64()), "tokens": pa.array(c[2], pa.int64()),
                "copies": pa.array(c[3], pa.int64()), "p": pa.array(c[4], pa.float64()), "settled": pa.array(c[5], pa.bool_())})

        for r in _round(rows(), seed, last):
            buf.append(r)
            if len(buf) >= 10_000:
                yield out()
                buf.clear()
        yield out()

    return df.select("source", "doc_id", "tokens", "copies", "p", "settled").mapInArrow(run, OPEN)


def plan(totals: dict[str, int], targets: dict[str, tuple[float, int]], size: float | None = None) -> dict[str, float]:
    """Expected copies of a text by source, for a mixture of ``size`` tokens, or of the greatest size that keeps all shares.

    targets: share and greatest number of copies by source. Sources without tokens can't be met and don't bind the size; where
    a given size asks for more copies than allowed, the allowed number is taken and the share falls short.
    """
    live = {s: (x, c) for s, (x, c) in targets.items() if x > 0 and totals.get(s, 0) > 0 and c > 0}
    if not live:
        return {}
    if size is None:
        size = min(c * totals[s] / x for s, (x, c) in live.items())
    return {s: min(float(c), size * x / totals[s]) for s, (x, c) in live.items()}


def mix(sized: DataFrame, targets: dict[str, tuple[float, int]], size: float | None = None, seed: int = 7) -> DataFrame:
    """(doc_id, source, tokens, copies) of all texts; copies 0 are kept in, so nothing is lost from sight.

    ``sized`` has ``doc_id``, ``source`` and ``tokens``. Texts of sources without target, or without source, get 0 copies;
    texts without tokens weigh nothing and are rounded alone. An empty table gives no rows.
    """
    spark = sized.sparkSession
    sized = durable(sized.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "tokens"))
    totals = {r["source"]: r["t"] for r in sized.where(F.col("source").isin(list(targets))).groupBy("source").agg(F.sum("tokens").alias("t")).collect()}  # one row per target
    copies = plan(totals, targets, size)
    table = spark.createDataFrame([(s, float(c)) for s, c in copies.items()] or [("", 0.0)], "source string, want double")
    # one row per target
    want = F.coalesce(F.col("want"), F.lit(0.0))
    start = sized.join(F.broadcast(table), "source", "left").select(
        "source", "doc_id", "tokens", F.floor(want + 1e-9).cast("long").alias("copies"), F.greatest(F.lit(0.0), want - F.floor(want + 1e-9)).alias("p"))
    start = start.withColumn("settled", (F.col("p") < 1e-9) | F.col("source").isNull())
    done = durable(_traded(start, seed))
    parts = [done.where("settled")]
    left = done.where("not settled")
    n = left.count()  # one for each task and source at most
    while n:
        tasks = max(1, n // FAN_IN)
        last = tasks == 1
        # those of a source stay together as far as it can be
        ordered = left.repartitionByRange(tasks, "source", "doc_id") if tasks > 1 else left.coalesce(1)
        step = durable(_traded(ordered.sortWithinPartitions("source", "doc_id"), seed + 1, last))
        parts.append(step.where("settled"))
        left = step.where("not settled")
        m = 0 if last else left.count()
        if m >= n:  # every source sits in a task of its own
            step = durable(_traded(left.coalesce(1).sortWithinPartitions("source", "doc_id"), seed + 1, True))
            parts.append(step)
            m = 0
        n = m
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("doc_id", "source", "tokens", "copies")


def report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: target and actual share, tokens, texts taken, greatest number of copies."""
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.sum((F.col("copies") > 0).cast("long")).alias("texts"), F.max("copies").alias("most_copies"))
    # a window over the targets, a few rows
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    rows = targets.select("source", "target_share", "max_repeats").join(got, "source", "left")
    return rows.select(
        "source", "target_share", F.coalesce(F.col("tokens") / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats")
