"""Structured Streaming over landing folders: new files only, late and repeated events, sessions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def process_new_files(spark: SparkSession, path: str, schema: str, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Handle Parquet files that came since the last call; the checkpoint remembers what was done."""
    q = (spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def fresh_only(stream: DataFrame, key: list[str], at: str, delay: str) -> DataFrame:
    """A stream without repetitions of a key within the delay."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, at: str, key: str, value: str, size: str, delay: str, slide: str | None = None) -> DataFrame:
    """Counts and sums by key and window of event time; rows later than the delay are dropped by the watermark."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    return (stream.withWatermark(at, delay).groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n", "total"))


def sessions(stream: DataFrame, at: str, key: str, gap: str, delay: str) -> DataFrame:
    """Sessions of a key: events no further apart than the gap."""
    return (stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n"))


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Running number and sum of a key's values, kept in state."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            v = f[value].dropna()
            n, total = n + len(f), total + float(v.sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"`{key}` {kind}, n bigint, total double", "n bigint, total double", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything that is available, through a query, as a table in the shared folder.

    Each batch has a folder of its own, so that one that is repeated after a loss replaces itself; in "complete" mode the last one is the result.
    """
    spark, out = stream.sparkSession, f"{checkpoint.rstrip('/')}-{name}"
    done: list[int] = []

    def keep(batch: DataFrame, no: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={no}")
        done.append(no)

    stream.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    if not done:
        return spark.createDataFrame([], stream.schema)
    last = [max(done)] if mode == "complete" else sorted(set(done))
    return spark.read.schema(stream.schema).parquet(*[f"{out}/batch={n}" for n in last])
