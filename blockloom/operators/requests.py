"""Outer batches and token-bounded requests, numbered inside each document so that no window needs all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.operators.folds import request_ids


def outer_batches(blocks: DataFrame, batch_size: int) -> DataFrame:
    """Adds batch (0-based), from the block's place in its document."""
    return blocks.withColumn("batch", F.floor((F.col("block_seq") - 1) / batch_size).cast("int"))


def request_batches(blocks: DataFrame, batch_size: int = 512, most_texts: int = 16, most_tokens: int = 512) -> DataFrame:
    """file_path, batch, block_seq, block_id, request of blocks with `tokens`."""
    row = F.struct("block_seq", "block_id", "tokens")
    grouped = outer_batches(blocks, batch_size).groupBy("file_path", "batch").agg(F.sort_array(F.collect_list(row)).alias("rows"))  # batch_size rows at most
    numbered = grouped.withColumn("req", request_ids(F.transform("rows", lambda r: r["tokens"]), min(batch_size, most_texts), most_tokens))
    each = numbered.select("file_path", "batch", F.explode(F.arrays_zip("rows", "req")).alias("z"))
    return each.select("file_path", "batch", F.col("z.rows.block_seq").alias("block_seq"), F.col("z.rows.block_id").alias("block_id"), F.col("z.req").alias("request"))
