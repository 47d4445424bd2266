"""A training-corpus pipeline: each stage works on all rows that the stage before has kept.

All stages but the last return the columns of `documents`; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm import decontaminate, jaccard_join, language_id, packing, secrets
from blockloom.llm.common import row_key, store, table
from blockloom.llm.queries import BYTE_BPE, vocabulary

#: A document is rejected if it has no letter, or if less than this share of its trigrams is in its best language.
LEAST_COVER = 0.25
#: Keys of dropped rows that are broadcast, at most; beyond them rows move to their keys.
MOST_KEYS = 1 << 21


def apart(docs: DataFrame, **more: Column) -> DataFrame:
    """docs as one struct column `doc`, so that no column of it can clash with those that are added."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), *(c.alias(name) for name, c in more.items()))


def together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some learned language; one whose text is null, empty or has no letter, or is in none of them, goes. A row
    is judged by its text alone, so repeated rows share their fate; ties of languages don't matter; a text of any length is
    judged whole; an empty table stays empty; other columns, of any name, are passed on."""
    return language_id.keep(docs, language_id.fit(docs, F.lit(True)), LEAST_COVER)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents: the one with the smallest doc_id, of several the one with the smallest hash
    of id and text; one without an id only if all have none. Rows that repeat id and text are one. Rows without words (null
    and empty texts too) are in no group and stay, all of them. Long texts are compared whole. An empty table stays empty."""
    linked = jaccard_join.join(docs, percent=80, shingle=5).filter("n_shingles > 0")
    linked = store(linked.select("root", "doc_id", "key"), "linked-rows")
    many = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key").alias("x")
    each = linked.groupBy("root", many).agg(F.count("*").alias("n")).groupBy("root").agg(F.min(F.struct("x", "n")).alias("y"))
    kept = store(each.select(F.col("y.x.key").alias("key"), F.col("y.n").alias("n")), "kept-rows")
    rows = apart(docs, key=row_key(), words=F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    dropped = store(linked.select("key").distinct().join(kept, "key", "left_anti"), "dropped-rows")
    if dropped.count() <= MOST_KEYS:  # texts stay where they are
        out = rows.filter("words").join(F.broadcast(dropped), "key", "left_anti")
    else:
        out = rows.filter("words").join(kept.select("key"), "key", "left_semi")
    if kept.filter("n > 1").limit(1).count():  # rows that repeat doc_id and text
        out = out.dropDuplicates(["key"])
    return together(out.select("doc").union(rows.filter("not words").select("doc")), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item. A row goes for its own text only: others with its doc_id, or without
    one, stay; repeated rows share their fate. Null and empty texts have no words and stay. Without items all rows stay."""
    hits = store(decontaminate.matches(docs, table(spark, sf_dir, "benchmark")).select("key").distinct(), "hits")
    return together(apart(docs, key=row_key()).join(hits, "key", "left_anti"), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced by a mark and n_chars, where there is such a column, counted anew. Null and empty texts
    stay as they are; of overlapping spans the first is marked and the rest joined to it; long texts are scanned whole."""
    clean = secrets.redact(docs, secrets.fit(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows; a null or empty text is its end id. See packing for ties, repeated rows and long texts."""
    return packing.pack(docs, vocabulary(BYTE_BPE), length=1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_languages),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]
#: Tokenizer ids and learnt models are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
