"""Writing dataset tiers with a manifest that is complete only when all tables are."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions import measures as M
from turnmill.schemas import STATE_VERSION


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def save_state(spark: SparkSession, root: str, terms: list[str] | None, settings: dict[str, str], by: str, completed: bool) -> None:
    """Write the manifest of a tier."""
    fs, p = _fs(spark, f"{root}/index.json")
    out = fs.create(p, True)
    doc = {"version": STATE_VERSION, "terms": sorted(terms or []), "completed": completed, "created_by": by, "settings": settings}
    out.write(bytearray(json.dumps(doc, sort_keys=True).encode()))
    out.close()


def load_state(spark: SparkSession, root: str) -> dict | None:
    """The manifest, None where it is missing or unreadable."""
    fs, p = _fs(spark, f"{root}/index.json")
    if not fs.exists(p):
        return None
    try:
        text = "\n".join(r[0] for r in spark.read.text(f"{root}/index.json").collect())  # a small file
        return json.loads(text)
    except ValueError:
        return None


def state_matches(state: dict | None, terms: list[str] | None, settings: dict[str, str]) -> bool:
    """Whether a tier was finished with the same version, terms and settings; who made it doesn't matter."""
    return bool(state and state.get("completed") and state.get("version") == STATE_VERSION and sorted(state.get("terms", [])) == sorted(terms or []) and state.get("settings") == settings)


def write_tier(spark: SparkSession, root: str, tables: dict[str, DataFrame], terms: list[str] | None = None, settings: dict[str, str] | None = None,
               by: str = "turnmill", force: bool = False, partition_by: dict[str, list[str]] | None = None) -> bool:
    """Write tables under a root; False where a matching tier is there already. The manifest is incomplete until the last table is written."""
    settings = settings or {}
    if not force and state_matches(load_state(spark, root), terms, settings):
        return False
    save_state(spark, root, terms, settings, by, False)
    for name, df in tables.items():
        w = df.write.mode("overwrite")
        keys = (partition_by or {}).get(name)
        (w.partitionBy(*keys) if keys else w).parquet(f"{root}/{name}.parquet")
    save_state(spark, root, terms, settings, by, True)
    return True


def simple_rows(utterances: DataFrame) -> DataFrame:
    """Rows of the simple tier from utterances with usable times; a column ``audio_bytes`` becomes their audio."""
    u = utterances.where(F.col("start_sec") < F.col("end_sec"))
    kind = F.coalesce("transcript_type", F.lit("unknown"))
    uid = F.concat_ws("_", "term", "docket", kind, F.format_string("%.2f", "start_sec"))
    content = F.col("audio_bytes") if "audio_bytes" in utterances.columns else F.lit(None).cast("binary")
    return u.select(uid.alias("id"), F.struct(content.alias("bytes"), F.concat(uid, F.lit(".wav")).alias("path")).alias("audio"), F.col("text").alias("sentence"), F.col("speaker_name").alias("speaker"),
                    "speaker_id", F.coalesce("is_justice", F.lit(False)).alias("is_justice"), (F.col("end_sec") - F.col("start_sec")).alias("duration"), "term", "docket",
                    kind.alias("recording_type"), "start_sec", "end_sec")


def write_simple(spark: SparkSession, root: str, rows: DataFrame, shard_mb: int = 100, bytes_per_row: int = 200_000) -> None:
    """The simple tier: one folder per split of duration, shards of about the given size, spread by a hash so that no recording weighs on one task."""
    split = rows.withColumn("split", M.duration_split(F.col("duration"))).where("split is not null")
    n = split.count()
    shards = max(1, math.ceil(n * bytes_per_row / (shard_mb << 20)))
    split.repartition(shards, F.xxhash64("id")).write.mode("overwrite").partitionBy("split").parquet(f"{root}/_all")
    for name, _, _ in M.DURATION_SPLITS:
        spark.read.parquet(f"{root}/_all").where(F.col("split") == name).drop("split").write.mode("overwrite").parquet(f"{root}/{name}")


def pending(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is still to do: wanted without what is there."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def spread(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """Rows in a reproducible random layout for even work."""
    return rows.repartition(parts, F.xxhash64(key))
