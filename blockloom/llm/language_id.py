"""Language identification with a bit-sliced Bloom filter of character n-grams.

Training counts letter trigrams (non-letters are one boundary symbol) per language over a bounded, hash-drawn sample of
at most about `train_docs` documents of each language (a fitted classifier's documented bound). A language contains a
trigram if its relative frequency there is at least `share` of the largest over all languages. Each filter slot is a
mask with one bit per language; the AND of a trigram's slots is the mask of all languages containing it. Per text, the
popcount of every language is corrected for that language's false-positive rate, and the largest decides.

A text that is null, empty or has no letter gives `und` and score 0. Ties go to the language first in sorted order. Long
texts are judged by all of their trigrams. Repeated rows get a row each; an empty table, or one without training rows, gives no rows or only `und`. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from blockloom.llm.common import emit, mix, ship, slices

HASHES = 3
#: Bytes of text at a time; a character takes some 60 bytes while its trigrams are made.
SLICE = 1 << 20
_tables: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """Code point -> its lower-case letter's code point, or 0 for what is no letter."""
    if "t" not in _tables:
        out = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _tables["t"] = out
    return _tables["t"]


def trigrams(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram codes centred on each letter, each text's first code (one more), and the letters of each text."""
    strings = [t or "" for t in text.to_pylist()]
    # a boundary on both sides of every text
    joined = ("\n" + "\n".join(strings) + "\n").encode("utf-32-le", "surrogatepass")
    letters = letter_table()[np.frombuffer(joined, np.uint32)].astype(np.uint64)
    ends = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])])
    centre = np.flatnonzero(letters[1:-1]) + 1
    codes = (letters[centre - 1] << np.uint64(42)) | (letters[centre] << np.uint64(21)) | letters[centre + 1]
    return codes, np.searchsorted(centre, ends + 1), None


@dataclass
class LanguageFilter:
    langs: list[str]
    slots: np.ndarray  # one uint64 mask per slot, per group of 64 languages
    false_rate: np.ndarray  # per language

    def masks(self, codes: np.ndarray, group: int) -> np.ndarray:
        """The languages (bits of one group of 64) that contain each trigram."""
        own, size = self.slots[group], np.uint64(self.slots.shape[1])
        h = mix(codes)
        step = mix(h) | np.uint64(1)
        out = own[(h % size).astype(np.int64)]
        for _ in range(HASHES - 1):
            h = h + step
            out = out & own[(h % size).astype(np.int64)]
        return out

    def decide(self, text: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, its share of all languages' corrected popcounts, and its corrected share of the text's trigrams."""
        codes, ends, _ = trigrams(text)
        n = np.diff(ends)
        counts = np.zeros((len(n), len(self.langs)))
        for group in range(self.slots.shape[0]):
            mask = self.masks(codes, group)
            for bit in range(min(64, len(self.langs) - 64 * group)):
                total = np.concatenate([[0], np.cumsum((mask >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
                counts[:, 64 * group + bit] = total[ends[1:]] - total[ends[:-1]]
        if not self.langs:
            return ["und"] * len(n), np.zeros(len(n)), np.zeros(len(n))
        true = np.maximum(0.0, (counts - n[:, None] * self.false_rate) / (1 - self.false_rate))
        best = true.argmax(axis=1)
        top, every = true[np.arange(len(n)), best], true.sum(axis=1)
        score = np.where(every > 0, top / np.maximum(every, 1e-9), 0.0)
        cover = np.minimum(1.0, top / np.maximum(n, 1))
        return [self.langs[b] if k else "und" for b, k in zip(best, n, strict=True)], np.where(n > 0, score, 0.0), np.where(n > 0, cover, 0.0)


def fit(docs: DataFrame, train: Column, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", train_docs: int = 4000, share: float = 0.4, least: int = 3, slot_bits_each: int = 24) -> LanguageFilter:
    """Learn a filter from the rows where `train` holds."""
    rows = docs.filter(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    many = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    langs = sorted(many)
    if not langs:
        return LanguageFilter([], np.zeros((1, 1), np.uint64), np.zeros(0))
    keep = F.lit(False)
    for lang in langs:
        keep = keep | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, train_docs / many[lang]))))

    def count(batches):
        for batch in batches:
            for part in slices(batch, most=SLICE):
                codes, ends, _ = trigrams(part.column("text"))
                at = pc.index_in(part.column("lang"), value_set=pa.array(langs)).to_numpy(zero_copy_only=False)
                who = np.repeat(at, np.diff(ends)).astype(np.int64)
                for k in np.unique(who):
                    grams, n = np.unique(codes[who == k], return_counts=True)
                    yield emit(lang=pa.array(np.full(len(grams), k, np.int32)), gram=pa.array(grams.astype(np.int64)), n=pa.array(n.astype(np.int64)))

    counted = rows.filter(keep).mapInArrow(count, "lang int, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    found = counted.toArrow()  # bounded by the sample
    lang, gram, n = (found.column(c).to_numpy() for c in ("lang", "gram", "n"))
    total = np.bincount(lang, weights=n, minlength=len(langs)) if len(lang) else np.ones(len(langs))
    rate = n / total[lang] if len(lang) else np.zeros(0)
    order = np.argsort(gram, kind="stable")
    lang, gram, rate = lang[order], gram[order].astype(np.uint64), rate[order]
    grams, first, which = np.unique(gram, return_index=True, return_inverse=True)
    most = np.maximum.reduceat(rate, first) if len(first) else np.zeros(0)
    into = rate >= share * most[which] if len(rate) else np.zeros(0, bool)
    size = max(1024, slot_bits_each * len(grams))
    slots = np.zeros(((len(langs) + 63) // 64, size), np.uint64)
    h = mix(gram[into])
    step = mix(h) | np.uint64(1)
    who = lang[into].astype(np.uint64)
    for _ in range(HASHES):
        np.bitwise_or.at(slots, ((who >> np.uint64(6)).astype(np.int64), (h % np.uint64(size)).astype(np.int64)), np.uint64(1) << (who & np.uint64(63)))
        h = h + step
    false = np.array([((slots[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() ** HASHES for k in range(len(langs))])
    return LanguageFilter(langs, slots, np.minimum(false, 0.99))


def _rows(docs: DataFrame, model: LanguageFilter, text_col: str, make, schema) -> DataFrame:
    """make(part, languages, scores, covers) of every slice of docs, whose columns keep their places."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, at, most=SLICE):
                yield make(part, *shared.value.decide(part.column(at).cast(pa.string())))

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, model: LanguageFilter, *keep: str, text_col: str = "text") -> DataFrame:
    """The columns `keep` of docs (none named like one of these), lang_pred, score and lang_cover for every row."""
    rows = docs.select(*keep, *([] if text_col in keep else [text_col]))
    schema = StructType([*rows.select(*keep).schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("lang_cover", DoubleType())])
    make = lambda part, lang, score, cover: pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(lang, pa.string()), pa.array(score), pa.array(cover)], names=schema.names)
    return _rows(rows, model, text_col, make, schema)


def keep(docs: DataFrame, model: LanguageFilter, least_cover: float, text_col: str = "text") -> DataFrame:
    """The rows of docs, as they are, that have a language with at least that share of their trigrams."""
    make = lambda part, lang, _, cover: part.filter(pa.array((np.array(lang, object) != "und") & (cover >= least_cover), pa.bool_()))
    return _rows(docs, model, text_col, make, docs.schema)
