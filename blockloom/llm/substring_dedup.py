"""Substring dedup over a compacted de Bruijn graph of token k-mers.

An edge is a window of `k` words (35), joining the nodes of its first and last k - 1 words. Each edge belongs to the
bucket of its minimiser (the smallest hash of its 8-word grams, the first if there are several), so equal edges share a
bucket. A document's consecutive edges with one minimiser occurrence form a unit, a path that is nonbranching inside its
document; its content hash covers all of its words. Then

1. contents that occur twice or more are repeated as a whole. A repeated content whose every occurrence is followed by
   the same content, with equally many occurrences, is joined to it (a nonbranching link, found by a Spark join); chains
   of links are compacted to one path by their source coordinates (the smallest document and start).
2. In buckets that hold different contents, contents are taken apart into edges, told apart by 128-bit digests of their
   text; edges that occur twice or more mark their coordinates.
3. Source coordinates verify the spans: the text at a path's source is digested (128 bits), and an occurrence counts only
   if the digest of its own text agrees.

Every word covered by a repeated edge is removed, wherever it occurs. Windows are judged on the input. Null and empty
texts have no words. Texts shorter than k words are kept whole. Repeated rows are copies of each other and lose what
they share. A row's key is the hash of its doc_id and text, so that a coordinate names one text also where rows share a
doc_id or have none. An empty table gives no rows. Other columns are ignored. A hot passage is one content: it is counted
with map-side combining, and its occurrences are joined with AQE's skew splitting, never gathered in one group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blockloom.llm.common import doc_index, drop, emit, hash_words, mix, row_key, ship, slices, split_words, store

GRAM, CHUNK, PLACE = 8, 1 << 22, np.uint64((1 << 24) - 1)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def units(h: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(minimiser, content, next content or 0, text, start word, edges) of every unit of the texts."""
    found = []
    for at in range(0, max(0, len(h) - k + 1), CHUNK):
        found.append(_units(h[at : at + CHUNK + k - 1], np.clip(ends - at, 0, min(len(h) - at, CHUNK + k - 1)), ends, at, k))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64, np.int32))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _units(h, cut, ends, at, k):
    n, wide = len(h), k - GRAM + 1
    gram = np.zeros(n - GRAM + 1, np.uint64)
    for j in range(GRAM):
        gram = gram * np.uint64(BASE) + h[j : n - GRAM + 1 + j]
    gram = mix(gram)
    low = (gram & ~PLACE) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while size * 2 <= wide:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[: n - k + 1], low[wide - size : wide - size + n - k + 1])
    where = (low & PLACE).astype(np.int64)
    text = doc_index(cut)[: n - k + 1]
    inside = np.arange(n - k + 1) + k <= cut[text + 1]
    new = inside & np.concatenate([[True], ~inside[:-1] | (where[1:] != where[:-1])])
    last = inside & np.concatenate([~inside[1:] | (where[1:] != where[:-1]), [True]])
    s, e = np.flatnonzero(new), np.flatnonzero(last)
    many = e - s + 1
    power = np.multiply.accumulate(np.full(n, BASE, np.uint64))
    back = np.multiply.accumulate(np.full(n, INVERSE, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power, dtype=np.uint64)])
    content = mix((total[s + many + k - 1] - total[s]) * back[s] + many.astype(np.uint64)) | np.uint64(1)
    follows = np.concatenate([(s[1:] == s[:-1] + many[:-1]), [False]]) if len(s) else np.zeros(0, bool)
    nxt = np.where(follows, np.concatenate([content[1:], content[:1]]), np.uint64(0)) if len(s) else content
    return gram[where[s]].view(np.int64), content.view(np.int64), nxt.view(np.int64), text[s], s + at - ends[text[s]], many.astype(np.int32)


def span_digest(words: list[bytes], start: int, length: int) -> tuple[int, int]:
    """128 bits of the words' text, as two signed halves."""
    d = xxhash.xxh3_128_intdigest(b" ".join(words[start : start + length]))
    return (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))


def repeated_spans(docs: DataFrame, k: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, start, length, hi, lo: runs of words made of repeated windows. hi and lo: the digest their text must have (null
    if the digests of all their windows have been compared). Runs may overlap."""
    ship(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)

    def find(batches):
        for batch in batches:
            for part in slices(batch):
                flat, ends = split_words(part.column("text"))
                m, c, nxt, text, start, n = units(hash_words(flat), ends, k)
                yield emit(m=pa.array(m), c=pa.array(c), nxt=pa.array(nxt), key=part.column("key").take(pa.array(text)), start=pa.array(start), n=pa.array(n))

    found = store(rows.select("key", "text").mapInArrow(find, "m bigint, c bigint, nxt bigint, key bigint, start bigint, n int"), "units")
    source = F.min(F.struct("key", "start")).alias("src")
    repeated = found.groupBy("c").agg(F.count("*").alias("times"), source, F.min("n").alias("n"), F.min("nxt").alias("nxt"), F.max("nxt").alias("other")).filter("times > 1")
    repeated = store(repeated.select("c", "times", "src", "n", F.when(F.col("nxt") == F.col("other"), F.col("nxt")).otherwise(0).alias("nxt")), "repeated")

    # nonbranching links, then chains of them by source coordinates
    before = repeated.filter("nxt <> 0").select(F.col("nxt").alias("c"), F.col("times").alias("before_times")).filter("c is not null")
    before = before.groupBy("c", "before_times").agg(F.count("*").alias("linked"))
    headed = repeated.join(before, (repeated.c == before.c) & (repeated.times == before.before_times), "left").select(repeated.c, "times", "src", "n", F.when(F.col("linked") == 1, 0).otherwise(1).alias("head"))
    chain = Window.partitionBy("src.key").orderBy("src.start")
    paths = headed.withColumn("path", F.sum("head").over(chain.rowsBetween(Window.unboundedPreceding, 0)))
    paths = store(paths.groupBy(F.col("src.key").alias("key"), "path").agg(F.min(F.struct("src.start", "c")).alias("first"), F.sum("n").alias("n")).select("key", F.col("first.start").alias("start"), F.col("first.c").alias("c"), (F.col("n") + k - 1).alias("length")), "paths")

    # buckets with different contents: one copy of each content, with its number of occurrences
    mixed = store(found.groupBy("m").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("m"), "mixed-buckets")
    apart = found.select("m", "c", "key", "start", "n").join(mixed, "m").groupBy("c").agg(F.count("*").alias("times"), source, F.min("n").alias("n"))

    asked = paths.select("key", F.struct(F.lit(0).cast("long").alias("times"), "start", F.col("length").cast("long").alias("length"), "c").alias("ask"))
    asked = asked.union(apart.select(F.col("src.key").alias("key"), F.struct("times", F.col("src.start").alias("start"), (F.col("n") + k - 1).cast("long").alias("length"), "c").alias("ask")))
    asked = asked.groupBy(F.col("key").alias("at")).agg(F.collect_list("ask").alias("asks"))  # no more than a document's words

    def look(batches):
        for batch in batches:
            for part in slices(batch):
                out: list[tuple] = []
                for key, text, asks in zip(part.column("key").to_pylist(), part.column("text").to_pylist(), part.column("asks").to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    for ask in asks:
                        times, start, length, c = ask["times"], ask["start"], ask["length"], ask["c"]
                        if not times:
                            out.append((c, 0, key, start, *span_digest(words, start, length)))
                        else:
                            out += [(c, times, key, p, *span_digest(words, p, k)) for p in range(start, start + length - k + 1)]
                if out:
                    yield emit(**{name: pa.array(col, pa.int64()) for name, col in zip(("c", "times", "key", "pos", "hi", "lo"), zip(*out, strict=True), strict=True)})

    seen = store(rows.select("key", "text").join(asked, F.col("key") == F.col("at")).select("key", "text", "asks").mapInArrow(look, "c bigint, times bigint, key bigint, pos bigint, hi bigint, lo bigint"), "digests")

    # edges of mixed buckets: their own occurrences are asked for only where the content occurs once
    edges = seen.filter("times > 0")
    twice = edges.groupBy("hi", "lo").agg(F.sum("times").alias("total")).filter("total > 1").select("hi", "lo")
    places = edges.filter("times = 1").join(twice, ["hi", "lo"]).select("key", "pos").distinct()
    order = Window.partitionBy("key").orderBy("pos")
    islands = places.withColumn("run", F.col("pos") - F.row_number().over(order)).groupBy("key", "run").agg(F.min("pos").alias("start"), (F.count("*") + k - 1).alias("length"))
    none = F.lit(None).cast("long")
    # one row for each path, and then one join, so that a passage with very many occurrences can be split among tasks
    named = store(paths.select("c", "length").join(seen.filter("times = 0").select("c", "hi", "lo").dropDuplicates(["c"]), "c"), "named-paths")
    whole = found.select("c", "key", "start").join(named, "c")
    spans = store(whole.select("key", "start", F.col("length").cast("long").alias("length"), "hi", "lo").union(islands.select("key", "start", "length", none, none)), "spans")
    drop(found, repeated, paths, mixed, seen, named, shuffles=True)
    return spans


def remove(docs: DataFrame, k: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space), kept_sha256 for every row."""
    spans = repeated_spans(docs, k, id_col, text_col)
    by = spans.groupBy(F.col("key").alias("at")).agg(F.collect_set(F.struct("start", "length", "hi", "lo")).alias("spans"))  # no more than a document's words, also where rows repeat id and text
    rows = _rows(docs, id_col, text_col)
    joined = rows.join(by, F.col("key") == F.col("at"), "left").select("doc_id", "text", "spans")

    def cut(batches):
        for batch in batches:
            for part in slices(batch):
                n, gone, kept, sha = [], [], [], []
                for text, own in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    out = np.zeros(len(words) + 1, np.int64)
                    for s in own or ():
                        a, b = s["start"], s["start"] + s["length"]
                        if b <= len(words) and (s["hi"] is None or span_digest(words, a, b - a) == (s["hi"], s["lo"])):
                            out[a] += 1
                            out[b] -= 1
                    left = words
                    if own:
                        covered = np.cumsum(out[:-1]) > 0
                        left = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                    rest = b" ".join(left)
                    n.append(len(words))
                    gone.append(len(words) - len(left))
                    kept.append(rest.decode())
                    sha.append(hashlib.sha256(rest).hexdigest())
                yield emit(doc_id=part.column("doc_id"), n_words=pa.array(n, pa.int64()), n_removed=pa.array(gone, pa.int64()), kept=pa.array(kept, pa.string()), kept_sha256=pa.array(sha, pa.string()))

    return joined.mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
