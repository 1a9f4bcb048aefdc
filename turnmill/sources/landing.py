"""Reading landing folders of JSON documents, media listings and dataset tiers."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from turnmill import schemas
from turnmill.functions import ids


def read_documents(spark: SparkSession, path: str, schema: str | object, key: str) -> DataFrame:
    """One document per file below a folder; files that don't fit, and objects without ``key``, are passed over. ``source_path`` tells where from."""
    s = schema if isinstance(schema, str) else schema.simpleString()[7:-1]
    df = (spark.read.schema(f"{s}, _corrupt string" if isinstance(schema, str) else schema.add("_corrupt", "string"))
          .option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.json").json(path))
    return df.where(F.col(key).isNotNull() & F.col("_corrupt").isNull()).withColumn("source_path", F.col("_metadata.file_path")).drop("_corrupt")


def read_case_pages(spark: SparkSession, path: str) -> DataFrame:
    """Cases of all pages (files that hold a list of objects) below a folder; empty and corrupt pages add none."""
    return read_documents(spark, path, schemas.RAW_CASE, "ID")


def list_media(spark: SparkSession, path: str, formats: tuple[str, ...] = ("mp3", "ogg")) -> DataFrame:
    """Media files below a folder without their content: path, length, format, recording_id, term, docket."""
    glob = "*.{" + ",".join(formats) + "}"
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "length", "modificationTime")
    where = ids.term_and_docket(F.col("path"))
    return f.withColumns({"format": F.lower(F.element_at(F.split("path", r"\."), -1)), "recording_id": ids.recording_id_of_path(F.col("path")),
                          "term": where["term"], "docket": where["docket"]})


def folder_totals(files: DataFrame) -> DataFrame:
    """Number and bytes of listed files."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one with the schema where the path is missing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def load_flex(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Recordings and utterances of the flex tier."""
    return read_or_empty(spark, f"{root}/recordings.parquet", schemas.RECORDINGS), read_or_empty(spark, f"{root}/utterances.parquet", schemas.UTTERANCES)


def load_simple(spark: SparkSession, root: str, split: str = "all") -> DataFrame:
    """Utterances of one split of the simple tier, or of all with ``_split`` telling which."""
    names = ("lt1m", "lt5m", "lt30m") if split == "all" else (split,)
    out = None
    for n in names:
        part = read_or_empty(spark, f"{root}/{n}", schemas.SIMPLE_UTTERANCES).withColumn("_split", F.lit(n))
        out = part if out is None else out.unionByName(part)
    return out


def rows_in_order(df: DataFrame) -> Iterator:
    """Rows one partition at a time, for readers that need no more than a stream."""
    return df.toLocalIterator(prefetchPartitions=True)


class Page(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__(first)
        self.first, self.last = first, last


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.most = options["path"], int(options.get("maxPages", 1 << 30))

    def partitions(self) -> list[Page]:
        n = 0
        while n < self.most and os.path.exists(os.path.join(self.folder, f"page-{n}.json")):
            n += 1
        return [Page(a, min(a + 64, n)) for a in range(0, n, 64)]

    def read(self, partition: Page) -> Iterator[tuple[int, str]]:
        for p in range(partition.first, partition.last):
            try:
                with open(os.path.join(self.folder, f"page-{p}.json"), encoding="utf-8") as f:
                    items = json.load(f)
            except ValueError:
                continue
            for x in items if isinstance(items, list) else []:
                yield p, json.dumps(x)


class CasePages(DataSource):
    """``spark.read.format("case_pages").load(folder)``: numbered pages from 0 up to the first that is missing, one row per listed item."""

    @classmethod
    def name(cls) -> str:
        return "case_pages"

    def schema(self) -> str:
        return "page int, item string"

    def reader(self, schema: object) -> PageReader:
        return PageReader(self.options)
