"""Markdown file sources: (file_path, text) rows, one per file."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.config import ParserOptions

SCHEMA = "file_path string, text string"


def _legacy(content: pd.Series) -> pd.Series:
    """What isn't UTF-8: the first of UTF-16 (with its mark), GBK and Latin-1 (which takes any bytes) that can decode it."""

    def decode(raw: bytes | None) -> str | None:
        if raw is None:
            return None
        for codec in (["utf-16"] if raw[:2] in (b"\xff\xfe", b"\xfe\xff") else []) + ["gbk"]:
            try:
                return raw.decode(codec)
            except UnicodeDecodeError:
                continue
        return raw.decode("latin-1")

    return content.map(decode)


def decoded(raw: DataFrame) -> DataFrame:
    """file_path, text of rows (file_path, content). UTF-8 (a byte-order mark is dropped) stays in the JVM; other files'
    bytes pass through Python."""
    plain = F.when(F.substring(F.hex("content"), 1, 6) == "EFBBBF", F.substring("content", 4, 1 << 30)).otherwise(F.col("content")).cast("string")
    rows = raw.withColumn("known", F.is_valid_utf8(F.col("content").cast("string")))
    rows = rows.withColumn("other", F.pandas_udf(_legacy, "string")(F.when(~F.col("known"), F.col("content"))))
    return rows.select("file_path", F.when(F.col("known"), plain).otherwise(F.col("other")).alias("text"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_files(spark: SparkSession, *paths: str) -> DataFrame:
    """The given files, whatever their suffix; missing ones are left out, repeated ones read once."""
    found = [p for p in dict.fromkeys(paths) if _exists(spark, p)]
    if not found:
        return spark.createDataFrame([], SCHEMA)
    return decoded(spark.read.format("binaryFile").load(found).select(_plain_path().alias("file_path"), "content"))


def read_directory(spark: SparkSession, directory: str | None = None, options: ParserOptions = ParserOptions()) -> DataFrame:
    """All files below a directory with one of the suffixes (case-sensitive); none if the directory is missing."""
    top = directory or options.input_dir
    if not _exists(spark, top):
        return spark.createDataFrame([], SCHEMA)
    glob = "*{" + ",".join(options.extensions) + "}"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(top)
    return decoded(raw.select(_plain_path().alias("file_path"), "content"))


def _plain_path() -> Column:
    return F.regexp_replace("path", "^file:/*", "/")
