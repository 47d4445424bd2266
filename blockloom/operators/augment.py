"""Augmented text, flat metadata and token estimates of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.functions.text import token_estimate


def augmented(content: Column, tags: Column, kind: Column) -> Column:
    """`key: value` of all tags, then the content, joined by spaces; protected blocks stay as they are."""
    labels = F.transform(tags, lambda t: F.concat(t["key"], F.lit(": "), t["value"]))
    return F.when(kind.isNotNull(), content).otherwise(F.array_join(F.concat(labels, F.array(content)), " "))


def flat_tags(tags: Column) -> Column:
    """Map `tag_<key>` -> value; the last of several values of a key wins."""
    last = F.filter(tags, lambda t, i: ~F.exists(F.slice(tags, i + 2, F.size(tags)), lambda u: u["key"] == t["key"]))
    return F.map_from_entries(F.transform(last, lambda t: F.struct(F.concat(F.lit("tag_"), t["key"]), t["value"])))


def with_text(blocks: DataFrame) -> DataFrame:
    """Blocks with augmented_text and tokens."""
    out = blocks.withColumn("augmented_text", augmented(F.col("content"), F.col("tags"), F.col("protected_element_type")))
    return out.withColumn("tokens", token_estimate(F.col("augmented_text")))


def metadata(blocks: DataFrame) -> DataFrame:
    """block_id, line range, flags, protected_element_type ('' for text), tag_map."""
    return blocks.select("block_id", "start_line", "end_line", "is_splited", F.coalesce("protected_element_type", F.lit("")).alias("protected_element_type"), "protected_element_overlength", flat_tags(F.col("tags")).alias("tag_map"))
