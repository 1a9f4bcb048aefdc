"""Filling containers of fixed capacity with whole texts, by lexical retrieval.

In each round the largest unused texts become seeds, a third as many as containers are still wanted. Every seed asks an inverted
index with BM25 weights for its best unused neighbours that fit, in order of score; the index is cut into shards, each
seed asks all of them and the answers are merged, so that what is found doesn't depend on how many shards there are.
Document frequencies are counted over all texts. Seeds take their neighbours from the largest seed down; a seed whose
neighbours have gone to others while it has room asks again in the next round. Only where no neighbour fits any more the
room that is left takes the largest texts that fit. Only a text above the capacity is cut, at token boundaries.

A seed is compared with the texts of its group. All texts are one group up to GROUP of them; more are cut by range of
their most telling term, so that the work for a text stays the same whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.tokens import TERM_BINS
from turnmill.session import durable

#: Texts of a group on average, what a seed is compared with; texts of a shard of it, what one task indexes.
GROUP, SHARD = 25_000, 5_000
#: Neighbours that a shard names to a seed at once.
NEIGHBOURS = 32
#: A seed takes its neighbours in order of score, first those of at least such parts of its room.
PARTS = (0.5, 0.25, 0.1, 0.0)
#: Containers still wanted in a group that all get their seed at once.
FEW = 4
#: The part of the containers still wanted that gets its seed in a round is one of so many.
WAVES = 3
#: Seeds scored at once in a task.
BLOCK = 256
#: Terms in more than one of so many texts of a shard are kept as rows of a matrix, others as lists.
DENSE = 16
K1, B = 1.2, 0.75

PACKED = "container bigint, position int, doc_id bigint, piece_no int, start_token bigint, end_token bigint, tokens bigint"
_STATE = "group int, uid bigint, doc_id bigint, tokens bigint, rest bigint, box bigint, position int, room bigint, how int, open boolean"
_ASKED = "seed bigint, found array<struct<score:float,uid:bigint>>, last float"
_FOUND = pa.list_(pa.struct([("score", pa.float32()), ("uid", pa.int64())]))


def inverse_frequencies(sized: DataFrame, bins: int = TERM_BINS) -> tuple[np.ndarray, float]:
    """BM25 weights of all term bins and the mean length, over all texts; a fixed number of rows comes to the driver."""
    stats = sized.agg(F.count(F.lit(1)).alias("n"), F.avg("tokens").alias("mean")).first()
    df = np.zeros(bins, np.float64)
    got = sized.select(F.explode("bins").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n")).toPandas()  # at most ``bins`` rows
    df[got["bin"].to_numpy()] = got["n"].to_numpy()
    n = stats["n"] or 0
    return np.log(1 + (n - df + 0.5) / (df + 0.5)).astype(np.float32), float(stats["mean"] or 1.0) or 1.0


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists, and where each begins."""
    whole = lists.combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks) if whole.num_chunks else pa.array([], lists.type)
    lengths = whole.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return whole.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


class Shard:
    """An inverted index over some texts: their sizes, the bins and counts of the terms of each, and, where seeds ask, their numbers and what of them is to be placed."""

    def __init__(self, sizes: np.ndarray, bags: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, mean: float, uids: np.ndarray | None = None, rests: np.ndarray | None = None):
        self.n, self.bags = len(sizes), bags
        self.uids, self.rests = np.arange(self.n) if uids is None else uids, np.asarray(sizes) if rests is None else rests
        docs = np.repeat(np.arange(self.n), [len(b) for b in bags])
        bins, counts = (np.concatenate(x) if len(x) else np.zeros(0, np.int64) for x in (bags, counts))
        bins, size = bins.astype(np.int64), np.maximum(sizes, 1)[docs]
        weights = (idf[bins] * (counts * (K1 + 1)) / (counts + K1 * (1 - B + B * size / mean))).astype(np.float32)
        order = np.argsort(bins, kind="stable")
        self.terms, first = np.unique(bins[order], return_index=True)
        self.at = np.append(first, len(bins)).astype(np.int64)
        self.docs, self.weights = docs[order], weights[order]
        self.dense = np.flatnonzero(np.diff(self.at) * DENSE > self.n)
        self.row = np.full(len(self.terms), -1)
        self.row[self.dense] = np.arange(len(self.dense))
        self.matrix = np.zeros((len(self.dense), self.n), np.float32)
        for r, k in enumerate(self.dense):
            span = slice(self.at[k], self.at[k + 1])
            self.matrix[r, self.docs[span]] = self.weights[span]

    def scores(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """BM25 score of every text for each query; a query is a set of term bins, all of them in one array with the places where each begins."""
        n = len(at) - 1
        if not len(self.terms):
            return np.zeros((n, self.n), np.float32)
        query = np.repeat(np.arange(n), np.diff(at))
        k = np.minimum(np.searchsorted(self.terms, bins), len(self.terms) - 1)
        known = self.terms[k] == bins
        query, k = query[known], k[known]
        rows = self.row[k]
        asks = np.zeros((n, len(self.dense)), np.float32)
        asks[query[rows >= 0], rows[rows >= 0]] = 1.0
        query, k = query[rows < 0], k[rows < 0]
        lengths = self.at[k + 1] - self.at[k]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[k] - ends + lengths, lengths)
        rare = np.bincount(np.repeat(query * self.n, lengths) + self.docs[place], self.weights[place], n * self.n)
        return rare.reshape(n, self.n).astype(np.float32) + asks @ self.matrix

    def neighbours(self, seed: int, used: np.ndarray) -> list[int]:
        """Unused texts that share terms with one of them, best score first."""
        score = self.scores(self.bags[seed], np.array([0, len(self.bags[seed])]))[0]
        score[used] = 0.0
        top = np.flatnonzero(score > 0)
        return top[np.lexsort((top, -score[top]))].tolist()

    def ask(self, bins: np.ndarray, at: np.ndarray, rooms: np.ndarray, most: int = NEIGHBOURS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(score, uid) of each query's ``most`` best texts that share a term and are within its room, best first; several queries at once, scores of 0 at the end."""
        for start in range(0, len(at) - 1, BLOCK):
            cut = at[start:start + BLOCK + 1]
            block = self.scores(bins[cut[0]:cut[-1]], cut - cut[0])
            block *= self.rests[None, :] <= rooms[start:start + BLOCK, None]
            top = np.argpartition(block, self.n - most, axis=1)[:, self.n - most:] if self.n > most else np.tile(np.arange(self.n), (len(block), 1))
            score, uid = np.take_along_axis(block, top, 1), self.uids[top]
            order = np.lexsort((uid, -score), axis=1)
            yield np.take_along_axis(score, order, 1), np.take_along_axis(uid, order, 1)


def ask_all(seeds: DataFrame, texts: DataFrame, idf: np.ndarray, mean: float, shards: int, groups: int = 1, most: int = NEIGHBOURS) -> DataFrame:
    """(seed, candidates, more) of the seeds' best neighbours among ``texts`` of their group; every seed asks every shard of it.

    A shard names ``most``. Candidates are those of all shards that no unnamed text can outscore, so they are the best of the whole
    group whatever the shards; ``more`` tells whether there are others behind them.

    seeds: group, uid, bins, room; texts: group, uid, tokens, rest, bins, counts.
    """
    sent = seeds.sparkSession.sparkContext.broadcast((idf, mean))

    def run(asking: pa.Table, held: pa.Table) -> pa.Table:
        idf, mean = sent.value
        if not asking.num_rows or not held.num_rows:
            return pa.table({"seed": pa.array([], pa.int64()), "found": pa.array([], _FOUND), "last": pa.array([], pa.float32())})
        bins, at = _flat(held["bins"])
        counts, _ = _flat(held["counts"])
        number = lambda t, c: t[c].to_numpy()
        shard = Shard(number(held, "tokens"), np.split(bins, at[1:-1]), np.split(counts.astype(np.float32), at[1:-1]), idf, mean, number(held, "uid"), number(held, "rest"))
        scores, uids, sizes, lasts = [], [], [], []
        for score, uid in shard.ask(*_flat(asking["asked"]), number(asking, "room"), most):
            some = score > 0
            scores.append(score[some])
            uids.append(uid[some])
            sizes.append(some.sum(axis=1))
            # where a shard may have more, only what scores as much as its last is sure to come before those
            lasts.append(np.where(some[:, -1] & (score.shape[1] < shard.n), score[:, -1], 0.0))
        ends = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32))
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate(scores), pa.float32()), pa.array(np.concatenate(uids), pa.int64())], ["score", "uid"])
        return pa.table({"seed": asking["seed"], "found": pa.ListArray.from_arrays(ends, flat), "last": pa.array(np.concatenate(lasts), pa.float32())})

    # as many tasks as there are shards, however small: the work is in scoring, not in bytes
    n = shards * groups
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")
    left = seeds.select("group", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "uid", "bins", "room").toDF("_group", "_shard", "seed", "asked", "room").repartition(n, "_group", "_shard")
    right = texts.select("group", shard("uid").alias("shard"), "uid", "tokens", "rest", "bins", "counts").repartition(n, "group", "shard")
    got = left.groupBy("_group", "_shard").cogroup(right.groupBy("group", "shard")).applyInArrow(run, _ASKED)
    merged = got.groupBy("seed").agg(F.flatten(F.collect_list("found")).alias("found"), F.max("last").alias("last"))
    sure = F.filter("found", lambda x: x["score"] >= F.col("last"))
    order = F.transform(sure, lambda x: F.struct((-x["score"]).alias("score"), x["uid"].alias("uid")))
    return merged.select("seed", F.sort_array(order).alias("found"), (F.col("last") > 0).alias("more")).select("seed", F.col("found.uid").alias("candidates"), "more")


class _BySize:
    """Unused texts by size."""

    def __init__(self, rests: list[int], unused: list[int]):
        self.stacks: dict[int, list[int]] = {}
        for i in sorted(unused, key=lambda i: (rests[i], -i)):
            self.stacks.setdefault(rests[i], []).append(i)
        self.bits = 0
        for s in self.stacks:
            self.bits |= 1 << s

    def take(self, limit: int) -> int | None:
        """The largest of at most that size; it is used then."""
        s = (self.bits & ((1 << (limit + 1)) - 1)).bit_length() - 1
        if s < 0:
            return None
        i = self.stacks[s].pop()
        if not self.stacks[s]:
            self.bits &= ~(1 << s)
        return i


SEED, RETRIEVED, SIZED = 0, 1, 2


def _fill(group: pa.Table, capacity: int) -> pa.Table:
    """One round in a group: open seeds take their candidates, the largest first; seeds that can be told no more take what fits by size; new seeds are named."""
    order = group.sort_by([("rest", "descending"), ("doc_id", "ascending"), ("uid", "ascending")])
    uid, rest, box, pos, room, how, open_, cands, more = (order[c].to_pylist() for c in ("uid", "rest", "box", "position", "room", "how", "open", "candidates", "more"))
    where = {u: i for i, u in enumerate(uid)}
    active = [i for i, o in enumerate(open_) if o]
    held = dict.fromkeys(active, 1)
    for i, b in enumerate(box):
        if b is not None and how[i] != SEED and where[b] in held:
            held[where[b]] = max(held[where[b]], pos[i] + 1)

    def put(i: int, seed: int, kind: int) -> None:
        box[i], pos[i], how[i] = uid[seed], held[seed], kind
        held[seed] += 1
        room[seed] -= rest[i]

    for s in active:
        near = [where[u] for u in cands[s] or ()]
        # texts that take much of the room first: small ones still fit elsewhere
        for part in PARTS:
            least = room[s] * part
            for i in near:
                if box[i] is None and least <= rest[i] <= room[s]:
                    put(i, s, RETRIEVED)
    unused = [i for i, b in enumerate(box) if b is None]
    by_size, least = _BySize(rest, unused), rest[unused[-1]] if unused else 0
    for s in active:
        open_[s] = bool(more[s]) and room[s] >= max(least, 1)
        while not open_[s] and (i := by_size.take(room[s])) is not None:
            put(i, s, SIZED)
    # only a part of the containers that are still wanted get a seed, so that middling texts become seeds too before the small ones are gone
    unused = [i for i in unused if box[i] is None]
    want = -(-sum(rest[i] for i in unused) // capacity)
    for i in unused[: max(want if want <= FEW else -(-want // WAVES), bool(unused))]:
        box[i], pos[i], how[i], room[i], open_[i] = uid[i], 0, SEED, capacity - rest[i], True
    return pa.table({"group": order["group"], "uid": order["uid"], "doc_id": order["doc_id"], "tokens": order["tokens"], "rest": order["rest"], "box": pa.array(box, pa.int64()),
                     "position": pa.array(pos, pa.int32()), "room": pa.array(room, pa.int64()), "how": pa.array(how, pa.int32()), "open": pa.array(open_, pa.bool_())})


def placed(sized: DataFrame, key: str, capacity: int, group: int = GROUP, shard: int = SHARD) -> DataFrame:
    """Every text with its container (``box``, the uid of its seed), its place there, and ``how`` it came there (SEED, RETRIEVED, SIZED)."""
    spark = sized.sparkSession
    sized = durable(sized.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), "tokens", "bins", "counts"))
    idf, mean = inverse_frequencies(sized)
    n = sized.count()
    groups = max(1, math.ceil(n / group))
    rest = F.when(F.col("tokens") > capacity, (F.col("tokens") - 1) % capacity + 1).otherwise(F.col("tokens"))
    if groups > 1:
        sent = spark.sparkContext.broadcast(idf)

        def telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            idf = sent.value
            for b in batches:
                top = [int(max(x, key=lambda i: (idf[i], i))) if x else -1 for x in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(top, pa.int32())], names=["doc_id", "tokens", "bins", "counts", "top"])

        # by range of term and id: a term of a third of all texts is spread over as many groups as it fills
        sized = sized.mapInArrow(telling, "doc_id bigint, tokens bigint, bins array<int>, counts array<int>, top int").repartitionByRange(groups, "top", "doc_id").withColumn("group", F.spark_partition_id())
    else:
        sized = sized.withColumn("group", F.lit(0))
    texts = durable(sized.select("group", F.monotonically_increasing_id().alias("uid"), "doc_id", "tokens", rest.cast("long").alias("rest"), "bins", "counts"))
    shards = max(1, math.ceil(min(n, group) / shard), math.ceil(min(spark.sparkContext.defaultParallelism, n / 500) / groups))
    none = F.lit(None)
    state = texts.select("group", "uid", "doc_id", "tokens", "rest", none.cast("bigint").alias("box"), none.cast("int").alias("position"), none.cast("bigint").alias("room"),
                         none.cast("int").alias("how"), F.lit(False).alias("open"), none.cast("array<bigint>").alias("candidates"), F.lit(False).alias("more"))

    def filled(state: DataFrame) -> DataFrame:
        return durable(state.groupBy("group").applyInArrow(lambda t: _fill(t, capacity), _STATE))

    state = filled(state)
    while not state.where("open").isEmpty():
        asking = texts.select("uid", "bins").join(state.where("open and room > 0").select("group", "uid", "room"), "uid")
        free = texts.join(state.where("box is null").select("uid"), "uid")
        found = ask_all(asking, free, idf, mean, shards, groups)
        state = filled(state.join(found, F.col("uid") == F.col("seed"), "left").drop("seed"))
    return state


def pack(sized: DataFrame, key: str, capacity: int, group: int = GROUP, shard: int = SHARD) -> DataFrame:
    """Containers of all texts of ``token_sizes(..., terms=True)``: PACKED with the key as ``doc_id``; a container is named by its seed.

    A text above the capacity leaves whole pieces, each a container of its own with a negative number, and a rest that is packed
    as any other text. Empty texts take no room and lie in some container of their group. Rows without key are left out;
    repeated keys are packed as often as they come. An empty table gives no containers.
    """
    full = placed(sized, key, capacity, group, shard)
    pieces = F.expr(f"cast((tokens - rest) div {capacity} as int)")
    rests = full.select(F.col("box").alias("container"), "position", "doc_id", pieces.alias("piece_no"), (F.col("tokens") - F.col("rest")).alias("start_token"),
                        F.col("tokens").alias("end_token"), F.col("rest").alias("tokens"))
    cut = full.where(F.col("tokens") > F.col("rest")).select("uid", "doc_id", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece_no"))
    # below all others: the place among all pieces in blocks of the texts' order
    name = -1 - F.monotonically_increasing_id()
    start = F.col("piece_no").cast("long") * capacity
    return rests.unionByName(cut.select(name.alias("container"), F.lit(0).alias("position"), "doc_id", "piece_no", start.alias("start_token"), (start + capacity).alias("end_token"),
                                        F.lit(capacity).cast("long").alias("tokens")))
