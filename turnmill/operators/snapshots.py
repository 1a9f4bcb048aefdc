"""What changed between full snapshots of a table.

Each key's rows are laid out by the index of the snapshot they were seen in; the content before, and gaps in the
indexes, tell additions, changes and removals in one pass over all snapshots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The content of a record without any; no digest holds this character.
NO_CONTENT = "\u0000"


def canonical_url(url: Column) -> Column:
    """Lower case, without white space around it and without a final slash; null stays null."""
    return F.regexp_replace(F.lower(F.trim(url)), "/+$", "")


def last_seen_hash(versions: Column) -> Column:
    """content_hash (lower case) of the version last seen; null for a null or empty list, or one without hashes.

    Null elements and versions without hash are passed over; a version without last_seen is the oldest; among
    equals the greatest hash counts.
    """
    known = F.transform(
        F.filter(versions, lambda v: v.isNotNull() & v["content_hash"].isNotNull()),
        lambda v: F.struct(v["last_seen"].alias("seen"), F.lower(F.trim(v["content_hash"])).alias("hash")),
    )
    return F.array_max(known)["hash"]


def snapshot_changes(df: DataFrame, snapshot: str, key: str, version: str, content: str) -> DataFrame:
    """Rows added, removed or changed between consecutive snapshots.

    Result: ``snapshot_no`` (the later one), the key, ``change``. Within one snapshot and key the row with the latest
    ``version`` counts (null is oldest; among equals the greatest content), null keys and null snapshots name nothing
    and are left out. Consecutive are the snapshots that occur in the table. The latest row is found by an
    aggregate that combines before the shuffle, so a key that fills a third of the table reaches a task as a few rows.
    """
    rows = df.where(F.col(snapshot).isNotNull() & F.col(key).isNotNull())
    latest = (rows.groupBy(F.col(snapshot).alias("_s"), F.col(key).alias("_k"))
              .agg(F.max(F.struct(F.col(version).alias("v"), F.coalesce(F.col(content), F.lit(NO_CONTENT)).alias("c"))).alias("_m"))
              .select("_s", "_k", F.col("_m.c").alias("_c")))
    # One row per snapshot: the number of deliveries, not of records.
    numbers = rows.groupBy(F.col(snapshot).alias("_s")).agg(F.lit(1).alias("_one"))
    order = Window.orderBy("_s")
    numbers = numbers.select("_s", F.row_number().over(order).alias("_i"), F.lead("_s").over(order).alias("_after"))
    w = Window.partitionBy("_k").orderBy("_i")
    seen = (latest.join(numbers, "_s")
            .withColumn("_i0", F.lag("_i").over(w)).withColumn("_c0", F.lag("_c").over(w)).withColumn("_i1", F.lead("_i").over(w)))
    came = (F.when(F.col("_i") == 1, None)
            .when(F.col("_i0").isNull() | (F.col("_i0") < F.col("_i") - 1), F.lit("added"))
            .when(F.col("_c0") != F.col("_c"), F.lit("changed")))
    went = F.when(F.col("_after").isNotNull() & (F.col("_i1").isNull() | (F.col("_i1") > F.col("_i") + 1)), F.lit("removed"))
    out = seen.select("_k", F.explode(F.array(F.struct(F.col("_s").alias("s"), came.alias("c")), F.struct(F.col("_after").alias("s"), went.alias("c")))).alias("_e"))
    return out.where("_e.c is not null").select(F.col("_e.s").cast("long").alias("snapshot_no"), F.col("_k").alias(key), F.col("_e.c").alias("change"))
