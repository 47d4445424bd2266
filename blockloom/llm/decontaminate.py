"""Benchmark decontamination over a distributed positional inverted index, with DataFrame functions only.

1. The benchmark's windows (10 consecutive words; a shorter item is one window) and their terms.
2. The frequency of every benchmark term over all training words.
3. The `lists` rarest terms of each window are its anchors. The index gets every training posting (term, row, position) of
   an anchor term. A posting's position less the term's place in the item is its offset; the lists of one offset of an item
   are intersected, and windows keep the offsets that all of their anchors' lists have.
4. For the rows that are left, the index gets the postings of the other terms of the windows that are left. A window stands
   where the lists of all of its terms, less frequent ones first, have one offset (phrase), or where every term has a posting
   within size - 1 words of the rarest one's (proximity).

Terms are runs of 0-9, a-z (A-Z lowered) and all characters from U+0080. Null and empty texts have no words and no windows;
long texts are read whole. Of terms that are equally rare the smaller, then the first in the window, comes first, which
changes the work and not the result. A row's key is the hash of its id and text (common.row_key), so rows that share an id
or have none have hits of their own; repeated rows match alike, and each gets a row. An empty benchmark gives no hits, an
empty table no rows; other columns are ignored.
A table of the benchmark's side is broadcast only if it has at most `broadcast_bytes` (terms counted in full); beyond that
the joins shuffle, and Spark splits a hot term's postings.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blockloom.llm.common import drop, row_key, store

#: What separates terms, before and after A-Z are lowered. Splitting is about twice as fast as gathering matches.
ANY_BREAK, LOW_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _text(text: str | Column) -> Column:
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))


def terms(text: str | Column) -> Column:
    t = _text(text)
    # lower() is A-Z only where all is ASCII; elsewhere just those letters are translated
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(low, LOW_BREAK), "")


def count_terms(text: str | Column) -> Column:
    return F.size(F.array_remove(F.split(_text(text), ANY_BREAK), "")).cast("long")


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (a hash of its id and terms), item_id, w (terms) of every item that has words."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), terms(text_col).alias("w")).filter(F.size("w") > 0)
    return items.distinct().select(F.xxhash64("item_id", F.array_join("w", " ")).alias("item"), "item_id", "w")


def windows(items: DataFrame, size: int) -> DataFrame:
    """item, s (first place in the item), length, terms: every window of every item."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    flat = items.select("item", "w", F.explode(starts).alias("s"))
    return flat.select("item", "s", F.expr(f"slice(w, s + 1, {size})").alias("terms")).withColumn("length", F.size("terms"))


def index(words: DataFrame, wanted: DataFrame) -> DataFrame:
    """Postings of the wanted terms: term, key, pos."""
    return words.select("key", F.posexplode("words").alias("pos", "term")).join(wanted, "term").select("term", "key", "pos")


def held(places, all_of) -> Column:
    """Whether the sorted array `places` has all of `all_of`."""
    return F.size(F.array_except(all_of, places)) == 0


def matches(docs: DataFrame, benchmark: DataFrame, size: int = 10, lists: int = 2, kind: str = "phrase", id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", broadcast_bytes: int = 8 << 20) -> DataFrame:
    """key (see row_key), item_id, start, length of every place where a window's words stand (phrase), or of every posting of
    its rarest term with all the window's terms within size - 1 words of it (proximity)."""

    def side(table: DataFrame) -> DataFrame:
        size_ = table.agg(F.coalesce(F.sum(F.lit(48) + (F.octet_length("term") if "term" in table.columns else F.lit(0))), F.lit(0))).first()[0]
        return F.broadcast(table) if size_ <= broadcast_bytes else table

    items = store(items_of(benchmark, item_col, item_text), "bench-items")
    wins = store(windows(items, size), "bench-windows")
    each = wins.select("item", "s", "length", F.posexplode("terms").alias("j", "term"))
    words = docs.select(row_key(id_col, text_col).alias("key"), terms(text_col).alias("words"))
    every = words.select(F.explode("words").alias("term")).join(side(each.select("term").distinct()), "term")
    often = store(every.groupBy("term").agg(F.count("*").alias("freq")), "term-frequency")
    # a window with a term that no document has can't occur: the inner join leaves it fewer terms than it has
    of = Window.partitionBy("item", "s")
    ranked = each.join(often, "term").withColumns({"rank": F.row_number().over(of.orderBy("freq", "term", "j")), "held": F.count("*").over(of)})
    ranked = store(ranked.filter(F.col("held") == F.col("length")).select("item", "s", "length", "term", (F.col("s") + F.col("j")).alias("p"), "rank"), "ranked-terms")
    if kind == "proximity":
        return near(words, ranked, items, size, side)
    anchors = ranked.filter(F.col("rank") <= lists)
    places = store(anchors.select("term", "item", "p").distinct(), "anchor-places")
    postings = store(index(words, side(places.select("term").distinct())), "postings")
    first = postings.join(side(places), "term").select("key", "item", (F.col("pos") - F.col("p")).alias("offset"), "p")
    # no more places than the item has anchors
    lists_at = first.groupBy("key", "item", "offset").agg(F.collect_set("p").alias("places"))
    open_windows = anchors.groupBy("item", "s", "length").agg(F.collect_list("p").alias("need")).groupBy("item").agg(F.min(F.size("need")).alias("least"), F.collect_list(F.struct("s", "length", "need")).alias("wins"))
    left = lists_at.join(side(open_windows), "item").filter(F.size("places") >= F.col("least"))
    left = left.select("key", "item", "offset", F.filter("wins", lambda w: (F.col("offset") + w["s"] >= 0) & held(F.col("places"), w["need"])).alias("wins")).filter(F.size("wins") > 0)
    left = store(left, "anchored")
    # the lists of all terms of the windows that are left, in the rows that are left
    asked = left.select("key", "item", "offset", F.explode(F.array_distinct(F.flatten(F.transform("wins", lambda w: F.sequence(w["s"], w["s"] + w["length"] - 1))))).alias("p"))
    asked = asked.join(side(ranked.select("item", "p", "term").distinct()), ["item", "p"]).select("key", "item", "offset", "p", "term", (F.col("offset") + F.col("p")).alias("pos"))
    asked = store(asked, "asked-postings")
    more = index(words.join(left.select("key").distinct(), "key", "left_semi"), side(asked.select("term").distinct())).distinct()
    full = asked.join(more, ["key", "pos", "term"]).groupBy("key", "item", "offset").agg(F.collect_set("p").alias("places"))
    stand = left.join(full, ["key", "item", "offset"]).select("key", "item", "offset", F.explode(F.filter("wins", lambda w: held(F.col("places"), F.sequence(w["s"], w["s"] + w["length"] - 1)))).alias("w"))
    out = stand.select("key", "item", (F.col("offset") + F.col("w.s")).alias("start"), F.col("w.length").alias("length"))
    return out.join(side(items.select("item", "item_id")), "item").select("key", "item_id", "start", "length")


def near(words: DataFrame, ranked: DataFrame, items: DataFrame, size: int, side) -> DataFrame:
    """matches() for proximity. Postings meet in blocks of `size` words, so that a term that a row has often stays cheap."""
    rare = ranked.filter("rank = 1").select("term", "item", "s", "length")
    postings = store(index(words, side(rare.select("term").distinct())), "postings")
    found = postings.join(side(rare), "term").select("key", "pos", "item", "s", "length")
    others = ranked.select("item", "s", "term").distinct()
    asked = found.join(side(others), ["item", "s"]).select("*", F.explode(F.array(*(F.floor(F.col("pos") / size) + i for i in (-1, 0, 1)))).alias("block"))
    more = index(words.join(postings.select("key").distinct(), "key", "left_semi"), side(others.select("term").distinct())).distinct()
    more = more.select("key", "term", F.col("pos").alias("at"), F.floor(F.col("pos") / size).alias("block"))
    close = asked.join(more, ["key", "term", "block"]).filter(F.abs(F.col("at") - F.col("pos")) < size)
    seen = close.groupBy("key", "pos", "item", "s", "length").agg(F.count_distinct("term").alias("n"))
    full = seen.join(side(others.groupBy("item", "s").agg(F.count("*").alias("all_terms"))), ["item", "s"]).filter("n = all_terms")
    return full.join(side(items.select("item", "item_id")), "item").groupBy("key", "item_id", F.col("pos").alias("start")).agg(F.max("length").alias("length"))


def summary(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated for every row of docs."""
    hits = matches(docs, benchmark, size, id_col=id_col, text_col=text_col, **more)
    spans = hits.groupBy("key").agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.collect_set("item_id").alias("ids"))  # no more than a document's words, and than the benchmark's items
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))))
    per_row = store(spans.select("key", covered.cast("long").alias("n_hit"), F.array_sort(F.transform("ids", lambda i: i.cast("string"))).alias("items")), "hits")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"), count_terms(text_col).alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(per_row, "key", "left").select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
