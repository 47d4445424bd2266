"""Entry points: documents or files to blocks, blocks to vectors in a store."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.config import ParserOptions, VectorOptions
from blockloom.operators import augment, embed, requests
from blockloom.operators.blocks import blocks
from blockloom.operators.store import VectorTable
from blockloom.sources.files import read_directory, read_files


def parse(docs: DataFrame, options: ParserOptions = ParserOptions()) -> DataFrame:
    """Blocks of documents (file_path, text); other columns are ignored, null texts have none."""
    return blocks(docs.select("file_path", "text"), options)


def process_files(spark: SparkSession, *paths: str, options: ParserOptions = ParserOptions()) -> DataFrame:
    return parse(read_files(spark, *paths), options)


def process_directory(spark: SparkSession, directory: str | None = None, options: ParserOptions = ParserOptions()) -> DataFrame:
    return parse(read_directory(spark, directory, options), options)


def vectorize(parsed: DataFrame, options: VectorOptions = VectorOptions(), factory: Callable[[], embed.Provider] | None = None, tasks: int = 1, limited: bool = True) -> DataFrame:
    """Records of all blocks: metadata, document, embedding (null where its request failed) and error."""
    full = augment.with_text(parsed)
    numbered = requests.request_batches(full, options.batch_size, options.request_texts, options.request_tokens)
    dim = options.dimension
    rows = full.join(numbered.drop("block_seq"), ["file_path", "block_id"]).select("file_path", "batch", "request", "block_seq", "block_id", F.col("augmented_text").alias("text"), "tokens")
    vectors = embed.embed(rows, factory or (lambda: embed.HashedWords(dim)), options, tasks, limited)
    meta = augment.metadata(parsed)
    return meta.join(parsed.select("block_id", F.col("content").alias("document"), "file_path"), "block_id").join(vectors, ["file_path", "block_id"])


@dataclass(frozen=True)
class Saved:
    """What a run of save() has done: summary (one row: success, failure, wait_seconds, the first ten failed_ids), failed
    (block_id and error of all failures) and records. The last two read the run's folder until discard() removes it."""

    summary: DataFrame
    failed: DataFrame
    records: DataFrame
    folder: str

    def discard(self) -> None:
        spark = self.records.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def save(spark: SparkSession, parsed: DataFrame, options: VectorOptions = VectorOptions(), **how) -> Saved:
    """Embed blocks, once, and append them to the store. The records are written to a folder of the run beside the collection
    before anything reads them, so that neither the append nor the counts call the service again."""
    store = VectorTable(spark, options.store_dir, options.collection)
    folder = f"{store.path}.runs/{uuid.uuid4().hex}"
    vectorize(parsed, options, **how).write.parquet(folder)
    records = spark.read.parquet(folder)
    store.append(records.select(*(f.name for f in store.read().schema.fields)))
    summary = embed.status(records, options)
    summary = spark.createDataFrame(summary.collect(), summary.schema)  # one row
    return Saved(summary, embed.failed(records, options), records, folder)


def preview(parsed: DataFrame, n: int = 2) -> DataFrame:
    """The first blocks: block_id, the beginnings of content (100 characters) and augmented text (150), tags, element."""
    cut = lambda c, size: F.when(F.char_length(c) > size, F.concat(F.substring(c, 1, size), F.lit("..."))).otherwise(F.col(c)).alias(c)
    return augment.with_text(parsed).orderBy("file_path", "block_seq").limit(n).select("block_id", cut("content", 100), cut("augmented_text", 150), F.size("tags").alias("n_tags"), "protected_element_type")


def stats(spark: SparkSession, options: VectorOptions = VectorOptions()) -> DataFrame:
    store = VectorTable(spark, options.store_dir, options.collection)
    return store.read().agg(F.lit(options.dimension).alias("embedding_dimension"), F.count("*").alias("record_count"), F.lit(options.batch_size).alias("batch_size"))


def write_json(parsed: DataFrame, directory: str) -> None:
    """Blocks as JSON lines, a directory of part files."""
    parsed.drop("file_path", "block_seq").write.mode("overwrite").option("ignoreNullFields", "false").json(directory)


def write_json_array(parsed: DataFrame, directory: str) -> str:
    """Blocks as one pretty-printed array file, streamed through the driver partition by partition; for small outputs."""
    os.makedirs(directory, exist_ok=True)
    path = os.path.join(directory, "parsed_result.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, row in enumerate(parsed.orderBy("file_path", "block_seq").drop("file_path", "block_seq").toLocalIterator()):
            f.write(("," if i else "") + "\n  " + json.dumps(row.asDict(recursive=True), ensure_ascii=False, indent=2).replace("\n", "\n  "))
        f.write("\n]\n")
    return path
