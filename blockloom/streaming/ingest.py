"""Incremental ingestion: new files become blocks as they arrive. Each file is whole in its row, so no state crosses batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from blockloom.config import ParserOptions
from blockloom.operators.blocks import blocks
from blockloom.sources.files import _plain_path, decoded

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def watch(spark: SparkSession, directory: str, sink: Callable[[DataFrame, int], None], checkpoint: str, options: ParserOptions = ParserOptions(), once: bool = False) -> StreamingQuery:
    """Parse files that appear below a directory and hand each micro-batch's blocks to `sink(blocks, batch_id)`."""
    glob = "*{" + ",".join(options.extensions) + "}"
    raw = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(directory)

    def batch(files: DataFrame, number: int) -> None:
        sink(blocks(decoded(files.select(_plain_path().alias("file_path"), "content")), options), number)

    writer = raw.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
