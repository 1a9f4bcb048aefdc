"""Fetching documents in parallel through a pluggable function, with a versioned cache.

Nothing here opens a connection: the caller passes a function from a request to a response. Requests that the cache
holds are not fetched again; failures are kept apart and told by class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.functions import ids
from turnmill.operators import versions as V

RESPONSES = "request_key string, url string, status_code int, content_type string, content binary, error string, fetched_at timestamp"


@dataclass
class Response:
    """What a fetch gave; ``error`` is None where it went well."""

    status_code: int | None
    content_type: str | None = None
    content: bytes | None = None
    error: str | None = None


def with_request_keys(requests: DataFrame, method: str = "GET") -> DataFrame:
    """``request_key`` of every url; rows without url are left out."""
    return requests.where(F.col("url").isNotNull()).withColumn("request_key", ids.request_key(F.lit(method), F.col("url")))


def fetch(requests: DataFrame, cache: DataFrame, get: Callable[[str], Response], at: str, parallel: int = 32, force: bool = False) -> DataFrame:
    """Responses to the requests that ``cache`` (request_key, ...) lacks, or to all with ``force``; an exception of ``get`` becomes an error.

    Urls are spread by a hash, so that slow hosts don't meet in one task; repeated urls are fetched once.
    """
    wanted = with_request_keys(requests).select("request_key", "url").dropDuplicates(["request_key"])
    if not force:
        wanted = wanted.join(cache.select("request_key").distinct(), "request_key", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for key, url in zip(f["request_key"], f["url"]):
                try:
                    r = get(url)
                except Exception as e:  # noqa: BLE001 - every failure is a row
                    r = Response(None, error=f"{type(e).__name__}: {e}")
                rows.append((key, url, r.status_code, r.content_type, r.content, r.error, pd.Timestamp(at)))
            out = pd.DataFrame(rows, columns=["request_key", "url", "status_code", "content_type", "content", "error", "fetched_at"])
            out["status_code"] = out["status_code"].astype("Int32")
            yield out

    return wanted.repartition(parallel, F.xxhash64("request_key")).mapInPandas(run, RESPONSES)


def classified(responses: DataFrame, store: bool = False) -> DataFrame:
    """``class`` of every response: new, skipped, transient or failed."""
    return responses.withColumn("class", ids.fetch_class(F.col("status_code"), F.col("error"), F.lit(False), store))


def summary(requests: DataFrame, cache: DataFrame, responses: DataFrame) -> DataFrame:
    """(class, n) over all requests, the cached ones too."""
    keyed = with_request_keys(requests).select("request_key").distinct()
    hit = keyed.join(cache.select("request_key").distinct(), "request_key", "left_semi").select(F.lit("cached").alias("class"))
    return hit.unionByName(classified(responses).select("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def add_versions(history: DataFrame | None, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The version history with new contents, and the log of changes among the new ones.

    history: request_key, content_hash, first_seen, last_seen, times, raw_path. The same content only moves its last_seen.
    """
    ok = responses.where(F.col("content").isNotNull() & F.col("status_code").between(200, 299))
    seen = ok.select("request_key", ids.content_hash(F.col("content")).alias("content_hash"), "fetched_at", ids.extension(F.col("content_type")).alias("ext"))
    seen = seen.withColumn("raw_path", F.concat(F.lit("raw/"), "content_hash", "ext"))
    new = seen.groupBy("request_key", "content_hash").agg(
        F.min("fetched_at").alias("first_seen"), F.max("fetched_at").alias("last_seen"), F.count(F.lit(1)).alias("times"), F.min("raw_path").alias("raw_path"))
    both = new if history is None else history.unionByName(new)
    merged = both.groupBy("request_key", "content_hash").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("times").alias("times"), F.min("raw_path").alias("raw_path"))
    before = seen.select("request_key", "content_hash", "fetched_at")
    if history is not None:
        before = before.unionByName(V.latest_version(history, "request_key").select("request_key", "content_hash", F.col("last_seen").alias("fetched_at")))
    return merged, V.change_log(before, "request_key", "content_hash", "fetched_at")


def without_expired(history: DataFrame, now: str, days: int) -> DataFrame:
    """Versions last seen within so many days before ``now``."""
    return history.where(F.col("last_seen") >= F.lit(now).cast("timestamp") - F.make_interval(days=F.lit(days)))
