"""The registered queries over the table-made corpora, and DuckDB SQL for the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blockloom.config import ParserOptions, VectorOptions
from blockloom.functions import text as T
from blockloom.operators import augment, blocks, embed, folds, requests, rows, scope, store, tags
from blockloom.sources.corpora import corpus

OPTIONS = ParserOptions(max_chars=450, exclude=("#ignore/.*", "#temp$"))
Query = Callable[[SparkSession, str], DataFrame]


def _lines(spark, sf, *names):
    out = None
    for n in names:
        own = rows.classify(rows.lines(corpus(spark, sf, n)))
        out = own if out is None else out.union(own)
    return out


def _headed(spark, sf, *names):
    """Lines with their headings: documents are exchanged, not lines."""
    docs = functools.reduce(DataFrame.union, (corpus(spark, sf, n) for n in names))
    return scope.headings(rows.classify(rows.lines(rows.spread(docs))))


def _tag_text(tag):
    return F.concat_ws("=", tag["key"], tag["value"])


def lines_(spark, sf):
    return rows.lines(corpus(spark, sf, "conversations")).select("file_path", F.col("idx").cast("long").alias("idx"), "text")


def row_classify(spark, sf):
    return _lines(spark, sf, "conversations", "orders", "pages").select("file_path", F.col("idx").cast("long").alias("idx"), rows.kind().alias("kind"), F.col("header_level").cast("long").alias("header_level"))


def row_kind_counts(spark, sf):
    return _lines(spark, sf, "conversations", "orders", "pages", "documents").groupBy(rows.kind().alias("kind")).agg(F.count("*").alias("n"), F.sum(F.char_length("text")).alias("chars"))


def headers(spark, sf):
    return _lines(spark, sf, "conversations", "orders").filter("is_header").select("file_path", F.col("idx").cast("long").alias("idx"), F.col("header_level").cast("long").alias("level"), F.col("clean_text").alias("heading"))


def tags_parsed(spark, sf):
    found = _lines(spark, sf, "conversations", "orders", "documents").filter("is_tag").select("file_path", F.col("idx").cast("long").alias("idx"), tags.parse_tag(F.col("clean_text")).alias("t"))
    return found.select("file_path", "idx", F.col("t.key").alias("tag_key"), F.col("t.value").alias("tag_value"), F.col("t.original_text").alias("original_text"))


def tags_excluded(spark, sf):
    options = ParserOptions(exclude=("#role/.*",))
    found = _lines(spark, sf, "conversations").filter("is_tag").select(tags.parse_tag(F.col("clean_text"), options).alias("t"))
    return found.agg(F.count_if(F.col("t").isNull()).alias("excluded"), F.count_if(F.col("t").isNotNull()).alias("kept"))


def heading_path(spark, sf):
    return _headed(spark, sf, "conversations", "orders").select("file_path", F.col("idx").cast("long").alias("idx"), F.col("sec").cast("long").alias("sec"), F.col("lvl").cast("long").alias("lvl"), "title")


def _active_tags(spark, sf, *names):
    """Tags in force at each text line: those of its section and of all sections above, parsed before it."""
    tag = F.when(F.col("is_tag"), tags.parse_tag(F.col("clean_text")))
    state = scope.active_tags(_headed(spark, sf, *names), tag).filter("not is_tag and not is_header")
    return state.select("file_path", F.col("idx").cast("long").alias("idx"), F.array_join(F.transform("active", _tag_text), ";").alias("tags"))


def active_tags(spark, sf):
    return _active_tags(spark, sf, "conversations", "orders")


def nested_titles(spark, sf):
    return _headed(spark, sf, "nested").select("file_path", F.col("idx").cast("long").alias("idx"), F.col("sec").cast("long").alias("sec"), F.col("lvl").cast("long").alias("lvl"), "title")


def nested_tags(spark, sf):
    return _active_tags(spark, sf, "nested")


def nested_blocks(spark, sf):
    """Blocks of documents with three heading levels, and with text, a table and code in one section."""
    return _flat(_parsed(spark, sf, "nested"))


def table_runs(spark, sf):
    state = scope.elements(_headed(spark, sf, "orders"))
    return state.filter("is_table").groupBy("file_path", "run_id").agg(F.count("*").alias("n_rows"), F.max("idx").cast("long").alias("last_line")).withColumn("run_id", F.col("run_id").cast("long"))


def code_groups(spark, sf):
    state = scope.elements(_headed(spark, sf, "pages"))
    inside = state.filter(F.col("opens") | F.col("closes") | (F.col("plain") & F.col("in_code")))
    return inside.groupBy("file_path", F.col("gid").cast("long").alias("gid")).agg(F.count("*").alias("n_rows"), F.sum(F.char_length("text")).alias("chars"))


def segments(spark, sf):
    state = scope.elements(_headed(spark, sf, "conversations", "orders", "pages"))
    return state.filter("buf").groupBy("file_path", F.col("seg").cast("long").alias("seg")).agg(F.count("*").alias("n_rows"), F.sum(F.char_length("text")).alias("chars"), F.min("idx").cast("long").alias("first_line"))


def _pieces(spark, sf, *names):
    state = scope.elements(_headed(spark, sf, *names))
    return folds.each(blocks.segments(state).withColumn("pieces", folds.text_pieces(F.col("rows"), OPTIONS.max_chars)), ("file_path", F.col("seg").cast("long").alias("seg"), "rows"), "pieces", "i", "p")


def text_overflow_pieces(spark, sf):
    return _pieces(spark, sf, "conversations", "documents").select("file_path", "seg", F.col("p.a").cast("long").alias("first_row"), F.col("p.b").cast("long").alias("last_row"), F.col("p.over").alias("overflowed"))


def code_chunks(spark, sf):
    html = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.coalesce("html", F.lit("")).alias("html"))
    return folds.each(html, ("page_id",), folds.code_chunks(F.col("html"), 450), "i", "chunk").select("page_id", F.col("i").cast("long").alias("i"), "chunk")


def _order_tables(spark, sf):
    state = scope.elements(_headed(spark, sf, "orders"))
    runs = state.filter("is_table").groupBy("file_path", "run_id").agg(F.sort_array(F.collect_list(F.struct("idx", "text"))).alias("r"))
    return runs.select("file_path", T.strip(F.array_join(F.transform("r", lambda x: x["text"]), "")).alias("content"), F.get("r", F.lit(0))["idx"].alias("first"), F.get("r", F.size("r") - 1)["idx"].alias("last"))


def table_chunks(spark, sf):
    return folds.each(_order_tables(spark, sf), ("file_path",), folds.table_chunks(F.col("content"), 80), "i", "chunk").select("file_path", F.col("i").cast("long").alias("i"), "chunk")


def generic_chunks(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return folds.each(docs, ("doc_id",), folds.generic_chunks(F.col("text"), 400), "i", "chunk").select("doc_id", F.col("i").cast("long").alias("i"), F.md5(F.col("chunk").cast("binary")).alias("chunk_md5"), F.char_length("chunk").cast("long").alias("chars"))


def subchunk_line_ranges(spark, sf):
    each = folds.each(_order_tables(spark, sf).withColumn("parts", folds.table_chunks(F.col("content"), 80)), ("*", F.size("parts").alias("n")), "parts", "i", "part")
    start, end = folds.chunk_lines(F.col("first") + 1, F.col("last") + 1, F.col("content"), F.col("part"), F.col("i"), F.col("n"))
    return each.select("file_path", F.col("i").cast("long").alias("i"), start.cast("long").alias("start_line"), end.cast("long").alias("end_line"))


def _flat(parsed):
    return parsed.select(
        "file_path", F.col("block_seq").cast("long").alias("block_seq"), "block_id", "content", F.col("start_line").cast("long").alias("start_line"), F.col("end_line").cast("long").alias("end_line"),
        F.array_join(F.transform("tags", _tag_text), ";").alias("tags"), "is_splited", F.coalesce("protected_element_type", F.lit("")).alias("element"), "protected_element_overlength",
    )


def _parsed(spark, sf, name):
    return blocks.blocks(corpus(spark, sf, name), OPTIONS)


def blocks_all(spark, sf):
    """Flagship: every block of every conversation, with ids, tags, flags and line ranges."""
    return _flat(_parsed(spark, sf, "conversations"))


def blocks_text(spark, sf):
    return _flat(_parsed(spark, sf, "documents")).drop("block_seq")


def blocks_protected(spark, sf):
    return _flat(_parsed(spark, sf, "orders")).drop("block_seq").filter("element <> ''")


def blocks_code(spark, sf):
    return _flat(_parsed(spark, sf, "pages")).drop("block_seq")


def heading_only_discarded(spark, sf):
    state = scope.elements(_headed(spark, sf, "orders"))
    kept = blocks.segments(state).withColumn("t", blocks.trimmed(F.col("rows")))
    return kept.agg(F.count_if(T.heading_only(F.col("t.content"))).alias("discarded"), F.count_if(~T.heading_only(F.col("t.content"))).alias("kept"))


def split_flags(spark, sf):
    return _parsed(spark, sf, "conversations").groupBy("file_path", "is_splited").agg(F.count("*").alias("n"))


def block_ids(spark, sf):
    return _parsed(spark, sf, "conversations").select("file_path", "block_id")


def augmented_text(spark, sf):
    return augment.with_text(_parsed(spark, sf, "conversations")).select("block_id", F.md5(F.col("augmented_text").cast("binary")).alias("text_md5"), F.char_length("augmented_text").cast("long").alias("chars"))


def metadata_flat(spark, sf):
    return augment.metadata(_parsed(spark, sf, "conversations")).select("block_id", F.explode("tag_map").alias("meta_key", "meta_value"))


def token_estimate(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", T.token_estimate(F.coalesce("text", F.lit(""))).cast("long").alias("tokens"))


def _turns(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select(F.col("conv_id").cast("string").alias("file_path"), (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))).alias("block_seq"), F.col("turn").cast("string").alias("block_id"), F.coalesce("text", F.lit("")).alias("text"), T.token_estimate(F.coalesce("text", F.lit(""))).alias("tokens"))
    return turns


def request_batches(spark, sf):
    return requests.request_batches(_turns(spark, sf), batch_size=512, most_texts=4, most_tokens=200).select(F.col("file_path").alias("conv"), F.col("block_seq").cast("long").alias("block_seq"), F.col("request").cast("long").alias("request"))


def outer_batches(spark, sf):
    return requests.outer_batches(_turns(spark, sf), 4).groupBy(F.col("file_path").alias("conv"), F.col("batch").cast("long").alias("batch")).agg(F.count("*").alias("n"))


def embed_status(spark, sf):
    turns = _turns(spark, sf)
    options = VectorOptions(dimension=64)
    numbered = requests.request_batches(turns)
    rows_ = turns.join(numbered.drop("block_seq"), ["file_path", "block_id"]).select("file_path", "batch", "request", "block_seq", "block_id", "text", "tokens")
    done = embed.embed(rows_, lambda: embed.HashedWords(64), options, tasks=8, limited=False)
    return embed.status(done, options).select("success", "failure", F.size("failed_ids").cast("long").alias("n_failed_ids"))


def dimension_check(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return vectors.groupBy(F.size("embedding").cast("long").alias("dimension")).agg(F.count("*").alias("n"), F.count_if(F.size("embedding") == 64).alias("fits"))


def store_append(spark, sf):
    """What an append adds: ids of the upper half that the lower three quarters do not hold yet."""
    v = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").cast("string").alias("block_id"), "embedding", "vec_id")
    most = v.agg(F.max("vec_id").alias("m"))
    held = v.join(F.broadcast(most)).filter(F.col("vec_id") < F.col("m") * 0.75)
    new = v.join(F.broadcast(most)).filter(F.col("vec_id") >= F.col("m") * 0.5)
    return store.new_records(new.union(new).select("block_id", "embedding"), held).agg(F.count("*").alias("added"), F.min(F.col("block_id").cast("long")).alias("first_id"))


def cosine_topk(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    asked = v.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return store.cosine_topk(v, asked, 5, "vec_id").select("query_id", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def rate_window(spark, sf):
    """Requests and tokens of the trailing minute, and the oldest of them, for each user's events."""
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "ts", F.floor(F.abs("value")).cast("long").alias("tokens"))
    last = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-60_000_000, 0)
    return e.select("event_id", F.count("*").over(last).alias("rpm"), F.sum("tokens").over(last).alias("tpm"), F.min(F.unix_micros(F.col("ts").cast("timestamp"))).over(last).alias("oldest"))


def tag_key_counts(spark, sf):
    return _parsed(spark, sf, "conversations").select(F.explode("tags").alias("t")).groupBy(F.col("t.key").alias("tag_key")).agg(F.count("*").alias("n"), F.count_distinct("t.value").alias("n_values"))


def block_stats(spark, sf):
    return _parsed(spark, sf, "conversations").groupBy("file_path").agg(F.count("*").alias("n_blocks"), F.sum(F.char_length("content")).alias("chars"), F.count_if("is_splited").alias("n_split"))


QUERIES: dict[str, Query] = {
    f.__name__.rstrip("_"): f
    for f in (
        lines_, row_classify, row_kind_counts, headers, tags_parsed, tags_excluded, heading_path, active_tags, nested_titles, nested_tags, nested_blocks, table_runs, code_groups, segments, text_overflow_pieces, code_chunks, table_chunks,
        generic_chunks, subchunk_line_ranges, blocks_all, blocks_text, blocks_protected, blocks_code, heading_only_discarded, split_flags, block_ids, augmented_text, metadata_flat, token_estimate,
        request_batches, outer_batches, embed_status, dimension_check, store_append, cosine_topk, rate_window, tag_key_counts, block_stats,
    )
}
