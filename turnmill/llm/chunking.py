"""Splitting oversized items at natural boundaries, with overlap, under a limit.

Every boundary of an item (the end of a sentence; inside a sentence above the limit the ends of its words, and inside a
word above it plain positions) is joined to its farthest legal successor: the last end of a sentence that a piece which
begins one overlap before it can reach, else the last that it can reach with less overlap, else the last end of a word. Squaring this successor table again and again (pointer doubling) while applying
it to what is reached so far gives all greedy cuts of all items in a logarithmic number of joins.

Positions are measured in the unit that binds an item: characters, or microseconds spread evenly over its characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.sentences import Model, _types, with_chances
from turnmill.session import durable

NATURAL, WORD, FORCED = 0, 1, 2
_SPOKEN = re.compile(r"\S+")


@dataclass(frozen=True)
class Limits:
    """Largest size of a piece and overlap of neighbours, in characters and in seconds."""

    chars: int = 1000
    chars_overlap: int = 100
    seconds: int = 30
    seconds_overlap: int = 2


def oversized(df: DataFrame, text: str, start: str, stop: str, duration: str, limits: Limits) -> DataFrame:
    """``df`` with ``over`` (above a limit), ``span_us`` (length in microseconds, null if unknown), ``size`` (characters) and ``timed`` (time binds).

    The length is stop - start, or duration where either is null; a null text has size 0. A length that is not a number counts as unknown.
    """
    sec = F.when(F.col(start).isNotNull() & F.col(stop).isNotNull(), F.col(stop) - F.col(start)).otherwise(F.col(duration))
    sec = F.when(~F.isnan(sec) & (F.abs(sec) < 1e12), sec)
    us = F.round(sec * 1e6).cast("long")
    size = F.coalesce(F.length(text), F.lit(0))
    long_time = F.coalesce(us > limits.seconds * 1_000_000, F.lit(False))
    timed = long_time & ((size <= limits.chars) | (size * F.lit(float(limits.seconds * 1_000_000)) < us * F.lit(float(limits.chars))))
    return df.withColumn("over", long_time | (size > limits.chars)).withColumn("span_us", us).withColumn("size", size).withColumn("timed", timed)


def cut_points(text: str | None, ends: list[int], span_us: int | None, timed: bool, limits: Limits) -> list[tuple[int, int, int]]:
    """(measure, position, kind) of every boundary of one item after its beginning, in order, none twice; the last is its end.

    The kind says what a cut there parts: nothing (NATURAL), words of a sentence (WORD), or words of a sentence that alone is above the limit of
    characters (FORCED). An item without text is cut by time alone, at legal steps.
    """
    size = len(text) if text else 0
    if timed:
        limit, lap, total = limits.seconds * 1_000_000, limits.seconds_overlap * 1_000_000, span_us
    else:
        limit, lap, total = limits.chars, limits.chars_overlap, size
    step = max(limit - lap, 1)
    if size == 0:
        marks = list(range(limit, total, step)) + [total]
        return [(m, 0, NATURAL) for m in marks]
    scale = total / size if timed else 1.0
    room = max(int(step / scale), 1)
    out: list[tuple[int, int, int]] = []
    prev = 0
    for e in sorted({x for x in ends if 0 < x < size} | {size}):
        unit = text[prev:e]
        if (e - prev) * scale > step:
            kind = FORCED if len(unit.strip()) > limits.chars else WORD
            last = prev
            for m in _SPOKEN.finditer(text, prev, e):
                while m.end() - last > room and m.end() - m.start() > room:
                    last = max(last + room, m.start() + room if last <= m.start() else last + room)
                    if last >= m.end():
                        break
                    if last < e:
                        out.append((0, last, kind))
                if m.end() < e:
                    out.append((0, m.end(), kind))
                    last = m.end()
        out.append((0, e, NATURAL))
        prev = e
    seen, done = [], -1
    for _, p, k in out:
        if p > done:
            m = total if p == size else min(int(p * scale), total)
            if seen and seen[-1][0] >= m:
                if p == size:
                    seen[-1] = (m, p, k)
                continue
            seen.append((m, p, k))
            done = p
    return seen


def successors(points: list[tuple[int, int, int]], timed: bool, limits: Limits) -> np.ndarray:
    """The measure of the farthest legal successor of each boundary of one item, -1 for the last; ``points`` as of ``cut_points``, with the beginning.

    A piece that ends at a successor begins one overlap before its boundary. Ends of sentences come first: where none can be
    reached so, the overlap gives way to one that fits the limit; only where a piece can reach none do ends of words count,
    and where not even the next of these can be reached with the overlap, it gives way again.
    """
    limit, lap = (limits.seconds * 1_000_000, limits.seconds_overlap * 1_000_000) if timed else (limits.chars, limits.chars_overlap)
    at = np.array([m for m, _, _ in points], np.int64)
    ends = np.array([m for m, _, k in points if k == NATURAL], np.int64)
    lapped = at + np.where(at == 0, limit, max(limit - lap, 1))

    def last(among: np.ndarray, most: np.ndarray) -> np.ndarray:
        got = among[np.maximum(np.searchsorted(among, most, "right") - 1, 0)]
        return np.where(got > at, got, -1)

    following = np.append(at[1:], -1)
    to = last(ends, lapped)
    for other in (last(ends, at + limit), last(at, lapped), following):
        to = np.where(to < 0, other, to)
    return np.where(following < 0, -1, to)


def boundaries(laid: DataFrame, keys: list[str], model: Model, limits: Limits) -> DataFrame:
    """``keys``, ``timed``, ``m``, ``pos``, ``kind``, ``to`` (the farthest legal successor) of every boundary, the beginning included.

    ``laid`` also has ``long_text``, ``span_us`` and ``timed``. An item's boundaries come from one text and are joined to their successors where they are found.
    """
    sent = laid.sparkSession.sparkContext.broadcast(model.sendable())
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for b in batches:
            rows, to = [], []
            for text, us, timed, end, *gaps in zip(*(c.to_pylist() for c in b.columns[n:])):
                ends = model.ends(end, *gaps) if end is not None else []
                rows.append([(0, 0, NATURAL), *cut_points(text, ends, us, timed, limits)])
                to.append(successors(rows[-1], timed, limits))
            counts = np.fromiter((len(r) for r in rows), np.int64, len(rows))
            take = pa.array(np.repeat(np.arange(len(rows)), counts))
            flat = [x for r in rows for x in r]
            cols = {k: b.column(i).take(take) for i, k in enumerate(keys)}
            cols["timed"] = b.column(n + 2).take(take)
            cols["m"], cols["pos"], cols["kind"] = pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], pa.int64()), pa.array([x[2] for x in flat], pa.int32())
            cols["to"] = pa.array(np.concatenate(to) if to else [], pa.int64())
            yield pa.RecordBatch.from_pydict(cols)

    parts = with_chances(laid.select(*keys, "long_text", "span_us", "timed", "laid_end", "laid_at", "laid_keys", "laid_codes"), keys, model)
    schema = f"{_types(laid, keys)}, timed boolean, m bigint, pos bigint, kind int, to bigint"
    return reduce(DataFrame.unionAll, [part.mapInArrow(run, schema) for part in parts])


def greedy_cuts(jumps: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``m`` of all cuts reached from 0 by the successor table.

    In round k the table holds what lies 2^k cuts ahead, so items with fewer cuts leave it by themselves; the rounds end when it is empty.
    """
    on = [*keys, "m"]
    reached = jumps.where("m = 0").select(*keys, F.col("to").alias("m"))
    while not jumps.isEmpty():
        reached = durable(reached.unionByName(reached.join(jumps, on).select(*keys, F.col("to").alias("m"))).distinct())
        jumps = durable(jumps.withColumnRenamed("m", "from").withColumnRenamed("to", "m").join(jumps, on).select(*keys, F.col("from").alias("m"), "to"))
    return reached


def split_oversized(laid: DataFrame, keys: list[str], model: Model, limits: Limits) -> DataFrame:
    """Pieces of the items in ``laid``: ``keys``, ``piece_no``, ``start_char``, ``end_char``, ``start_m``, ``end_m``, ``cut`` (0 natural, 1 word, 2 forced).

    Pieces cover their item whole, none is above the limit, none ends inside a sentence where it could end after one, and
    neighbours overlap by the given amount, or by less where a natural cut would be lost otherwise. ``laid`` holds the oversized items with ``long_text``, ``size``, ``span_us`` and
    ``timed``; an item without text is cut by time. Items that are not oversized are not in it.
    """
    points = durable(boundaries(laid, keys, model, limits))
    lap = F.when(F.col("timed"), F.lit(limits.seconds_overlap * 1_000_000)).otherwise(F.lit(limits.chars_overlap))
    limit = F.when(F.col("timed"), F.lit(limits.seconds * 1_000_000)).otherwise(F.lit(limits.chars))
    cuts = greedy_cuts(points.where("to >= 0").select(*keys, "m", "to"), keys)
    w = Window.partitionBy(*keys).orderBy("m")
    out = (cuts.join(points, [*keys, "m"])
           .withColumn("_before", F.coalesce(F.lag("m").over(w), F.lit(0)))
           .withColumn("_at", F.coalesce(F.lag("pos").over(w), F.lit(0)))
           .withColumn("piece_no", (F.row_number().over(w) - 1).cast("int"))
           .withColumn("start_m", F.when(F.col("_before") == 0, F.lit(0)).otherwise(F.greatest(F.col("_before") - lap, F.col("m") - limit, F.lit(0)))))
    share = F.when(F.col("m") == F.col("_before"), F.lit(0.0)).otherwise((F.col("_before") - F.col("start_m")) / F.when(F.col("m") > 0, F.col("m")))
    start = F.when(~F.col("timed"), F.col("start_m")).otherwise(F.greatest(F.lit(0), F.ceil(F.col("_at") - share * F.col("pos"))))
    return out.select(*keys, "piece_no", F.least(start.cast("long"), F.col("_at")).alias("start_char"), F.col("pos").alias("end_char"), "start_m", F.col("m").alias("end_m"), F.col("kind").alias("cut"))
