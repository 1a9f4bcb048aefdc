"""Current rows of tables whose records can be delivered more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def current_rows(df: DataFrame, keys: list[str], version: str, tie_break: list[Column] | None = None) -> DataFrame:
    """The latest row of every key.

    * A null version is older than any other; rows with a null key column are dropped (they name no record).
    * Ties in ``version`` are settled by ``tie_break`` (descending, nulls last); identical copies count once.
    * The key is the full record key, so a group holds the deliveries of one record only. Spark's window group
      limit keeps one row per key before the shuffle, so a record delivered very often is cut down on the map side.
    """
    order = [F.col(version).desc_nulls_last(), *[c.desc_nulls_last() for c in tie_break or []]]
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    w = Window.partitionBy(*keys).orderBy(*order)
    rank = unused_name(df, "rank")
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)


def unused_name(df: DataFrame, name: str) -> str:
    """A name for a passing column that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def beside(df: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the columns of its own summary by ``keys`` (one row per key, nulls are a key); rows stay as they are."""
    on = []
    for i, k in enumerate(keys):
        name = unused_name(df, f"on_{i}")
        summary = summary.withColumnRenamed(k, name)
        on.append((k, name))
    return df.join(summary, [F.col(k).eqNullSafe(F.col(n)) for k, n in on], "left").drop(*[n for _, n in on])


def previous(df: DataFrame, keys: list[str], block: Column, order: list[str], value: str, name: str) -> DataFrame:
    """``name``: the value of the row before in a key's order, null for the first, where the key's rows are ordered in blocks.

    ``block`` must rise with the order. Rows are sorted within their block only; the first of a block looks at the last of
    the block before, which comes from one summary row per block. A null value before is null, as with lag.
    """
    b, last, before = (unused_name(df, n) for n in ("block", "last", "before"))
    rows = df.withColumn(b, block)
    w = Window.partitionBy(*keys, b).orderBy(*order)
    ends = rows.groupBy(*keys, b).agg(F.max_by(F.struct(F.col(value).alias("x")), F.struct(*order)).alias(last))
    ends = ends.select(*keys, b, F.lag(last).over(Window.partitionBy(*keys).orderBy(b)).alias(before))
    rows = beside(rows, ends, [*keys, b])
    first = F.row_number().over(w) == 1
    return rows.withColumn(name, F.when(first, F.col(f"{before}.x")).otherwise(F.lag(value).over(w))).drop(b, before)
