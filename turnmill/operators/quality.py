"""Quality of utterances: which can be used, and why others can't."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.functions import measures as M
from turnmill.operators.current import beside, unused_name


#: Seconds of a recording that one task orders at once.
STRETCH = 600.0


def flag_overlaps(df: DataFrame, keys: list[str], start: str, stop: str, flag: str, least: float = M.OVERLAP, stretch: float = STRETCH) -> DataFrame:
    """``flag``: whether a row shares more than ``least`` with any other of its recording, without pairing rows.

    In order of start, something before reaches far enough into this row, or this one into something after. Recordings
    are cut into stretches of time; what reaches in from earlier stretches, and the first start in later ones, come from
    one summary row per stretch, so that a long recording is no single task. Rows with a null or NaN time, and rows not longer than
    ``least``, overlap nothing. Null keys form a recording of their own.
    """
    block, s, e = unused_name(df, "stretch"), F.col(start), F.col(stop)
    ok = F.coalesce(~F.isnan(s) & ~F.isnan(e) & (F.abs(s) < 1e15), F.lit(False))
    rows = df.withColumn(block, F.when(ok, F.floor(s / stretch)))
    long = F.col(block).isNotNull() & (e - s > least)
    inside = Window.partitionBy(*keys, block).orderBy(F.col(start).asc_nulls_last(), F.col(stop))
    along = Window.partitionBy(*keys).orderBy(block)
    marks = (rows.where(F.col(block).isNotNull()).groupBy(*keys, block).agg(F.max(e).alias("_reach"), F.min(F.when(long, s)).alias("_next"))
             .withColumn("_in", F.max("_reach").over(along.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("_out", F.min("_next").over(along.rowsBetween(1, Window.unboundedFollowing))))
    joined = beside(rows, marks.select(*keys, block, "_in", "_out"), [*keys, block])
    before = F.greatest(F.max(e).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("_in"))
    after = F.least(F.min(F.when(long, s)).over(inside.rowsBetween(1, Window.unboundedFollowing)), F.col("_out"))
    hit = F.coalesce(long & (before - s > least), F.lit(False)) | F.coalesce(long & (e - after > least), F.lit(False))
    return joined.withColumn(flag, hit).drop(block, "_in", "_out")


def with_group_max(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The greatest value of the keys beside every row: an aggregate that combines before the shuffle, joined back."""
    most = df.groupBy(*keys).agg(F.max(value).alias(name))
    return beside(df, most, keys)


def flag_utterances(df: DataFrame, keys: list[str], start: str = "start", stop: str = "stop", duration: str = "duration", words: str = "word_count") -> DataFrame:
    """``bad_times``, ``bad_rate``, ``overlapping``, ``too_long`` and the exclusive ``reason`` in that order ('passed' for none).

    Null times are bad times. Overlap and the length of the recording look at all rows, rejected ones too.
    """
    s, e, d = F.col(start), F.col(stop), F.col(duration)
    bad_times = F.coalesce((s < 0) | (e < 0) | (e < s) | (F.abs(d - (e - s)) > M.DRIFT), F.lit(True))
    rate = M.words_per_minute(F.col(words), d)
    bad_rate = F.coalesce((d >= M.JUDGED_FROM) & ((rate > M.FASTEST) | (rate < M.SLOWEST)), F.lit(False))
    last = unused_name(df, "last_end")
    out = with_group_max(flag_overlaps(df, keys, start, stop, "overlapping"), keys, stop, last)
    out = out.withColumns({"bad_times": bad_times, "bad_rate": bad_rate, "too_long": F.coalesce(F.when(F.col(last) > 0, d / F.col(last)) > M.LARGEST_SHARE, F.lit(False))}).drop(last)
    return out.withColumn("reason", F.when(F.col("bad_times"), "invalid_timestamps").when(F.col("bad_rate"), "abnormal_wpm").when(F.col("overlapping"), "overlapping")
                          .when(F.col("too_long"), "too_long_ratio").otherwise("passed"))


def keep_valid(df: DataFrame, column: str = "valid", include_invalid: bool = False) -> DataFrame:
    """Valid rows; a table without the column is valid as a whole, a null in it is not."""
    return df if include_invalid or column not in df.columns else df.where(F.coalesce(F.col(column), F.lit(False)))


def reason_histogram(df: DataFrame, reason: str = "invalid_reason") -> DataFrame:
    """(reason, n) of the kinds before a colon; null or empty reasons are 'unknown'."""
    r = F.split_part(F.coalesce(F.nullif(F.col(reason), F.lit("")), F.lit("unknown")), F.lit(":"), F.lit(1))
    return df.groupBy(r.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def usable_ranges(df: DataFrame, start: str = "start_sec", stop: str = "end_sec") -> DataFrame:
    """Rows with both times and start before stop, with their ``duration_sec``."""
    return df.where(F.col(start) < F.col(stop)).withColumn("duration_sec", F.col(stop) - F.col(start))
