"""Content versions of fetched documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.operators.current import previous


def version_history(seen: DataFrame, key: str, digest: str, at: str) -> DataFrame:
    """(key, digest, first_seen, last_seen, times): a content seen again only moves its last_seen."""
    return seen.where(F.col(key).isNotNull() & F.col(digest).isNotNull()).groupBy(key, digest).agg(
        F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count(F.lit(1)).alias("times"))


def change_log(seen: DataFrame, key: str, digest: str, at: str, block: str = "month") -> DataFrame:
    """(key, at, old_hash, new_hash) whenever the content of a key is another than at the fetch before; first contents log nothing.

    A key's fetches are ordered by month (or another unit of time), so that one that is fetched very often is no single task.
    """
    rows = seen.where(F.col(key).isNotNull() & F.col(digest).isNotNull()).select(key, digest, at)
    rows = previous(rows, [key], F.date_trunc(block, F.col(at)), [at, digest], digest, "old_hash")
    return rows.where(F.col("old_hash") != F.col(digest)).select(key, F.col(at).alias("at"), "old_hash", F.col(digest).alias("new_hash"))


def latest_version(history: DataFrame, key: str) -> DataFrame:
    """The version last seen of every key; of several the one first seen first."""
    rest = [c for c in history.columns if c != key]
    return history.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("last_seen", -F.unix_micros(F.col("first_seen").cast("timestamp")))).alias("v")).select(key, "v.*")


def latest_of_array(rows: DataFrame, key: str, versions: str) -> DataFrame:
    """The version last seen in an array of versions; rows without any are left out."""
    known = F.filter(F.coalesce(F.col(versions), F.array()), lambda v: v.isNotNull())
    last = F.array_max(F.transform(known, lambda v: F.struct(v["last_seen"].alias("last_seen"), v["content_hash"].alias("content_hash"), v["raw_path"].alias("raw_path"))))
    return rows.select(key, last.alias("v")).where("v is not null").select(key, "v.*")


def expired(rows: DataFrame, now: str) -> DataFrame:
    """Entries whose expiry lies before ``now`` (text of a timestamp)."""
    return rows.where(F.lit(now).cast("timestamp_ntz") > F.col("expires_at"))
