"""Session settings and durable intermediate results."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that every plan here assumes. Cluster sizes (executors, memory, partitions) stay with the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with this library's settings; ``extra`` overrides them."""
    b = SparkSession.builder.appName("turnmill")
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python tasks can import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="turnmill-"), "turnmill.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("turnmill", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, which all executors share.

    Only where that is unset on one machine (tests) a temporary folder takes its place; on a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = _own.setdefault("", tempfile.mkdtemp(prefix="turnmill-"))
    return path.rstrip("/")


def durable(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` as a table written to the shared folder: computed once, with no lineage, safe from lost executors.

    A checkpoint would compute the rows twice, once to count and once to write. The folder goes when the process ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/turnmill-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended before: its folder goes with it
        if path.startswith("/"):
            shutil.rmtree(path, ignore_errors=True)


def spread_scan(df: DataFrame) -> DataFrame:
    """A scan in at least as many parts as the cluster runs at once: a table in few files would leave most cores idle in front
    of a costly Python stage. Larger tables have more parts and stay as they are."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
