"""Overlapping and gapped time intervals: continuous periods and the gaps between them.

A sweep line as DataFrame operations. Every interval becomes a plus event at its start and a minus event at its
stop; events at one instant are combined before the shuffle, so a key has at most one row per instant however many
intervals it has. A key's time line is then cut into buckets of fixed width. Running counts are taken inside the
buckets (at most ``bucket`` rows each, whatever the skew) and carried over through one summary row per bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Width of a bucket in units of time: an upper bound for the rows that one task sorts for one key and bucket.
BUCKET = 1 << 20


def sweep(df: DataFrame, keys: list[str], start: str, stop: str, bucket: int = BUCKET) -> DataFrame:
    """Transitions of the active count: columns ``keys``, ``_t``, ``_opens`` (true where coverage begins).

    Rows with a null key, start or stop, or stop <= start, cover nothing and are left out. Intervals are half open,
    so that touching ones leave no transition between them. Repeated intervals change nothing.
    """
    ok = (F.col(start) < F.col(stop))
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    events = df.where(ok).select(
        *keys,
        F.explode(F.array(F.struct(F.col(start).cast("long").alias("_t"), F.lit(1).cast("long").alias("_d")),
                          F.struct(F.col(stop).cast("long").alias("_t"), F.lit(-1).cast("long").alias("_d")))).alias("_e"),
    ).select(*keys, "_e._t", "_e._d")
    net = (events.groupBy(*keys, "_t").agg(F.sum("_d").alias("_d")).where("_d <> 0")
           .withColumn("_b", F.floor(F.col("_t") / F.lit(bucket)).cast("long")))
    inside = Window.partitionBy(*keys, "_b").orderBy("_t")
    local = net.withColumn("_run", F.sum("_d").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    # One row per key and bucket: a recording of a day has about 80.
    along = Window.partitionBy(*keys).orderBy("_b")
    carry = (net.groupBy(*keys, "_b").agg(F.sum("_d").alias("_net"))
             .select(*keys, "_b", F.coalesce(F.sum("_net").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_carry")))
    counted = local.join(carry, [*keys, "_b"]).withColumn("_active", F.col("_carry") + F.col("_run"))
    return (counted.where((F.col("_active") == 0) | (F.col("_active") == F.col("_d")))
            .select(*keys, "_b", "_t", (F.col("_active") > 0).alias("_opens")))


def periods_and_gaps(df: DataFrame, keys: list[str], start: str, stop: str, bucket: int = BUCKET) -> DataFrame:
    """Covered periods and the gaps between neighbouring ones.

    Result: ``keys``, ``kind`` ('period' or 'gap'), ``start``, ``stop`` (long). An empty table gives none.
    """
    marks = sweep(df, keys, start, stop, bucket)
    inside = Window.partitionBy(*keys, "_b").orderBy("_t")
    along = Window.partitionBy(*keys).orderBy("_b")
    firsts = marks.groupBy(*keys, "_b").agg(F.min("_t").alias("_first"))
    following = firsts.select(*keys, "_b", F.lead("_first").over(along).alias("_beyond"))
    paired = (marks.withColumn("_next", F.lead("_t").over(inside))
              .join(following, [*keys, "_b"])
              .withColumn("_end", F.coalesce("_next", "_beyond")))
    return (paired.where(F.col("_end").isNotNull())
            .select(*keys, F.when(F.col("_opens"), "period").otherwise("gap").alias("kind"), F.col("_t").alias("start"), F.col("_end").alias("stop")))
