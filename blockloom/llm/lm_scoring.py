"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Training tokens (words, A-Z lowered, and one end per document) are counted over all training rows: unigrams and
bigrams, 64-bit keys, combined in each task and moved to their buckets as packed columns. A count is quantised to its level
(LEVELS: exact up to ten, then steps of an eighth) and an n-gram of level q enters the filter q times, once under each
level 1..q; asking level after level until a probe fails gives the count back. The filter also holds, per history, the
level of its discounted mass.

    P(w | v) = max(c(vw) - D, 0) / c(v) + (1 - S(v) / c(v)) P(w),   P(w) = (c(w) + 0.1) / (N + 0.1 (V + 1))
    S(v) = sum over kept bigrams of (c(vx) - D)

Only bigrams seen `least` times or more are kept; the rest of v's mass goes to P(w). The filter grows with the n-grams:
all of them enter, at all their levels. It is built in segments, a bucket's keys at a time. A filter of at most
`filter_bytes` is broadcast, and every slice of text asks it in place. A larger one stays on the executors, in blocks of
segments: the texts are taken in `groups` (by hash, to bound the disk), each slice's distinct keys are shuffled to their
blocks, answered there many slices at once, and the levels are shuffled back. The number of blocks follows the cores, not the
input. Either way the same filter is asked, so scores are the same.

The exact base score uses two tiers: the counts of the `table_size` most frequent words are broadcast, the others'
(row, word, occurrences) are joined with the count table.

Null and empty texts consist of one end. Every row is scored for itself, whether or not its doc_id is null or shared;
repeated rows get a row each. Very long texts are scored whole. Of words that are equally frequent the smaller hash is in
the broadcast table, which does not change a score. An empty table gives no rows; without training rows all counts are 0.
Other columns are ignored. Words and bigrams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import dealt, doc_index, drop, emit, hash_words, mix, partitions, row_key, share, ship, slices, split_words, store

#: The end token's hash, and its place as the first word's history. Fixed values outside any word's role.
END = 0x6C6F6F6D5F656E64
LEVELS = sorted({int(1.125**k) for k in range(350)})
DISCOUNT, HASHES, MORE_HASHES, SEGMENT_BITS = 0.75, 8, 3, 1 << 20
UNI, BI, MASS = 1, 2, 3
KINDS = (UNI, BI, MASS)
#: The count that stands for each level; 0 for none.
VALUES = np.array([0.0, *((a + b) / 2 for a, b in zip(LEVELS, [*(x - 1 for x in LEVELS[1:]), LEVELS[-1]], strict=True))])
#: Keys in one row of questions, and entries that a task combines (or keys that it asks for) at once.
ASKED, COMBINED = 1 << 15, 1 << 20
#: Blocks of a filter that stays on the executors: so many, or four for each core of the cluster; more only beyond `filter_bytes` each.
BLOCKS = 64


def tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text with its end, and each text's first (one more)."""
    flat, ends = split_words(text, lower=True)
    h = np.insert(hash_words(flat), ends[1:], np.uint64(END))
    return h, ends + np.arange(len(ends))


def histories(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The token before each token; before a text's first one, the end."""
    before = np.concatenate([[np.uint64(END)], h[:-1]]) if len(h) else h
    before[ends[:-1]] = np.uint64(END)
    return before


def bigrams(h: np.ndarray, before: np.ndarray) -> np.ndarray:
    """64-bit key of each (history, token)."""
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + h)


def home(keys: np.ndarray, kind: int) -> np.ndarray:
    """What a key's bucket and segment are taken from: equal ranges of the 64-bit numbers."""
    return mix(keys ^ np.uint64(kind * 0x9E3779B97F4A7C15 % (1 << 64)))


class Tally:
    """Sums by key (with what else belongs to the key), combined whenever COMBINED entries have come together."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.many = 0

    def add(self, keys, n, *more) -> None:
        self.parts.append((keys, n, *more))
        self.many += len(keys)

    def combined(self) -> tuple:
        keys, n, *more = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        out = (keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0], *(m[order[first]] for m in more))
        self.parts, self.many = [out], len(out[0])
        return out


def packed(kind: int, buckets: int, keys: np.ndarray, n: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket: kind, bucket, its number of entries, and keys, sums and what else there is as bytes."""
    order, spans = dealt(share(home(keys, kind), buckets).astype(np.int32))
    columns = [c[order] for c in (keys, n, *more)]
    data = [b"".join(c[a:b].tobytes() for c in columns) for _, a, b in spans]
    return emit(kind=pa.array(np.full(len(spans), kind, np.int8)), bucket=pa.array([x for x, _, _ in spans], pa.int32()), n=pa.array([b - a for _, a, b in spans], pa.int64()), data=pa.array(data, pa.binary()))


def unpacked(data, n: int) -> tuple[np.ndarray, ...]:
    """Keys, sums and, for bigrams, histories of a row's bytes."""
    raw = np.frombuffer(data, np.uint64)
    return raw[:n], raw[n : 2 * n].view(np.float64), *([raw[2 * n :]] if len(raw) > 2 * n else [])


PACKED = "kind tinyint, bucket int, n bigint, data binary"


def counts(docs: DataFrame, least: int, buckets: int, pairs: bool = True) -> DataFrame:
    """Packed sums (counts) of all unigrams, and (pairs) of the bigrams with `least` or more; a bucket's in one row or a few."""

    def count(batches):
        uni, bi = Tally(), Tally()

        def out():
            for kind, tally in ((UNI, uni), (BI, bi)):
                if tally.parts:
                    yield packed(kind, buckets, *tally.combined())
                    tally.__init__()

        for batch in batches:
            for part in slices(batch):
                h, ends = tokens(part.column("text"))
                if pairs:
                    before = histories(h, ends)
                    key, first, n = np.unique(bigrams(h, before), return_index=True, return_counts=True)
                    bi.add(key, n.astype(np.float64), before[first])
                key, n = np.unique(h, return_counts=True)
                uni.add(key, n.astype(np.float64))
                if not pairs and uni.many > COMBINED:
                    uni.combined()
                if bi.many > COMBINED or uni.many > COMBINED:
                    yield from out()
        yield from out()

    def merge(batches):
        tallies: dict[tuple[int, int], Tally] = {}
        for batch in batches:
            for kind, bucket, n, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "bucket", "n")), batch.column("data"), strict=True):
                own = tallies.setdefault((kind, bucket), Tally())
                own.add(*unpacked(data.as_buffer(), n))
                if own.many > 2 * COMBINED:
                    own.combined()
        for (kind, bucket), own in sorted(tallies.items()):
            columns = own.combined()
            if kind == BI:
                columns = tuple(c[columns[1] >= least] for c in columns)
            yield emit(kind=pa.array([kind], pa.int8()), bucket=pa.array([bucket], pa.int32()), n=pa.array([len(columns[0])], pa.int64()), data=pa.array([b"".join(c.tobytes() for c in columns)], pa.binary()))
            tallies[kind, bucket] = None

    return docs.mapInArrow(count, PACKED).repartition(buckets, "bucket").mapInArrow(merge, PACKED)


def masses(counted: DataFrame, buckets: int) -> DataFrame:
    """Packed discounted masses of the histories of the kept bigrams."""

    def part(batches):
        own = Tally()
        for batch in batches:
            for n, data in zip(batch.column("n").to_pylist(), batch.column("data"), strict=True):
                if n:
                    _, times, before = unpacked(data.as_buffer(), n)
                    own.add(before, times - DISCOUNT)
                    if own.many > COMBINED:
                        yield packed(MASS, buckets, *own.combined())
                        own = Tally()
        if own.parts:
            yield packed(MASS, buckets, *own.combined())

    def merge(batches):
        tallies: dict[int, Tally] = {}
        for batch in batches:
            for bucket, n, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n")), batch.column("data"), strict=True):
                tallies.setdefault(bucket, Tally()).add(*unpacked(data.as_buffer(), n))
                if tallies[bucket].many > 2 * COMBINED:
                    tallies[bucket].combined()
        for bucket, own in sorted(tallies.items()):
            key, s = own.combined()
            yield emit(kind=pa.array([MASS], pa.int8()), bucket=pa.array([bucket], pa.int32()), n=pa.array([len(key)], pa.int64()), data=pa.array([key.tobytes() + s.tobytes()], pa.binary()))

    return counted.filter(F.col("kind") == BI).mapInArrow(part, PACKED).repartition(buckets, "bucket").mapInArrow(merge, PACKED)


def levels_of(n: np.ndarray) -> np.ndarray:
    """The number of LEVELS that are at most n, one at least."""
    return np.maximum(np.searchsorted(np.array(LEVELS, np.float64), n, side="right"), 1)


def probes(base: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """For keys with these homes: what the bit positions of one level are taken from, first and step."""
    h = mix(base + np.uint64(level * 0xD1B54A32D192ED03 % (1 << 64)))
    return h, mix(h) | np.uint64(1)


def places(base: np.ndarray, level: int, i: int) -> np.ndarray:
    """The i-th bit position of one level, inside the segment, for keys with these homes."""
    h, step = probes(base, level)
    return (h + np.uint64(i) * step) >> np.uint64(44)


@dataclass
class LogFrequencyFilter:
    """Segments `first` and on of a filter that has `segments` of them."""

    bits: np.ndarray  # segments x SEGMENT_BITS / 8
    first: int
    segments: int

    def levels(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """The last level found of each key, 0 if none. Keys that fail a probe are left out of the next ones, once they are many."""
        out, at, base, level = np.zeros(len(keys), np.uint16), np.arange(len(keys)), home(keys, kind), 1
        flat = self.bits.reshape(-1)
        begin = (share(base, self.segments) - np.uint64(self.first)) * np.uint64(SEGMENT_BITS)
        while len(at) and level <= len(LEVELS):
            h, step = probes(base, level)
            start, live, held = begin, None, None  # live: those of the level's keys that are still probed
            for i in range(HASHES if level == 1 else MORE_HASHES):
                if i:
                    h += step
                bit = h >> np.uint64(44)
                bit += start
                found = flat[(bit >> np.uint64(3)).view(np.int64)]
                found >>= (bit & np.uint64(7)).astype(np.uint8)
                found &= np.uint8(1)
                held = found if held is None else np.bitwise_and(held, found, out=held)
                if np.count_nonzero(held) < 0.8 * len(held):
                    left = np.flatnonzero(held)
                    live = left if live is None else live[left]
                    h, step, start, held = h[left], step[left], start[left], None
            if held is not None and not held.all():
                left = np.flatnonzero(held)
                live = left if live is None else live[left]
            if live is not None:
                at, base, begin = at[live], base[live], begin[live]
            out[at] = level
            level += 1
        return out

    def ask(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """The count each key has by the filter: 0, or the value of the last level found."""
        return VALUES[self.levels(keys, kind)]


class Words:
    """The distinct words of a slice of texts, for scores without a model."""

    def __init__(self, h: np.ndarray, ends: np.ndarray):
        self.ends = ends
        self.words, self.at = np.unique(h, return_inverse=True)

    def score(self, levels, total: int, distinct: int) -> np.ndarray:
        return np.zeros(len(self.at))


class Questions:
    """The distinct keys that a slice of texts asks for, and its scores once their levels are known."""

    def __init__(self, h: np.ndarray, ends: np.ndarray):
        self.ends = ends
        self.words, self.at = np.unique(h, return_inverse=True)
        before = np.concatenate([[0], self.at[:-1]]) if len(h) else self.at
        before[ends[:-1]] = np.searchsorted(self.words, np.uint64(END))  # each text has an end
        self.before = before
        # a pair of places is unique in the slice and sorts faster than the two hashes
        pair, self.pair_at = np.unique(before * np.int64(len(self.words) + 1) + self.at, return_inverse=True)
        self.pairs = bigrams(self.words[pair % (len(self.words) + 1)], self.words[pair // (len(self.words) + 1)]) if len(h) else h
        self.keys = ((self.words, UNI), (self.pairs, BI), (self.words, MASS))

    def answered(self, own: LogFrequencyFilter) -> np.ndarray:
        return np.concatenate([own.levels(keys, kind) for keys, kind in self.keys])

    def dealt(self, segments: int, each: int) -> tuple[np.ndarray, np.ndarray]:
        """Order of the keys by block of `each` segments (kinds in order inside a block), and the ordered keys' blocks."""
        block = np.concatenate([share(home(k, kind), segments) for k, kind in self.keys]).astype(np.int64) // each
        order = np.argsort(block, kind="stable")
        return order, block[order]

    def score(self, levels: np.ndarray, total: int, distinct: int) -> np.ndarray:
        """log10 probability of each token; levels are those of `keys`."""
        words, pairs, mass = np.split(VALUES[levels], [len(self.words), len(self.words) + len(self.pairs)])
        base = ((words + 0.1) / (total + 0.1 * (distinct + 1)))[self.at]
        often = np.maximum(words, 1.0)
        kept = np.minimum(mass / often, 0.98)[self.before]
        seen = np.where(mass[self.before] > 0, np.maximum(pairs[self.pair_at] - DISCOUNT, 0.0) / often[self.before], 0.0)
        return np.log10(np.minimum(seen, kept) + (1 - kept) * base)


def fill(entries: DataFrame, buckets: int, each: int) -> DataFrame:
    """seg, bits: the segments (`each` of them a bucket) that packed rows fill; one without any key may be left out."""
    segments = buckets * each

    def run(batches):
        filled: dict[int, np.ndarray] = {}
        for batch in batches:
            for kind, n, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "n")), batch.column("data"), strict=True):
                keys, times, *_ = unpacked(data.as_buffer(), n)
                base, level, q = home(keys, kind), levels_of(times), 1
                seg = share(base, segments).astype(np.int64)
                while len(base):
                    for s in np.unique(seg).tolist():
                        bits = filled.setdefault(s, np.zeros(SEGMENT_BITS, bool))
                        h, step = probes(base[seg == s], q)
                        for _ in range(HASHES if q == 1 else MORE_HASHES):
                            bits[(h >> np.uint64(44)).view(np.int64)] = True
                            h += step
                    q += 1
                    left = level >= q
                    base, level, seg = base[left], level[left], seg[left]
        for s, bits in sorted(filled.items()):
            yield emit(seg=pa.array([s], pa.int64()), bits=pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()))

    return entries.repartition(buckets, "bucket").mapInArrow(run, "seg bigint, bits binary")


def summed(entries: DataFrame) -> tuple[int, int, int]:
    """Training tokens, distinct ones, and bits that all keys need at all their levels."""

    def run(batches):
        total = distinct = hashes = 0
        for batch in batches:
            for kind, n, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "n")), batch.column("data"), strict=True):
                _, times, *_ = unpacked(data.as_buffer(), n)
                hashes += int((HASHES + (levels_of(times) - 1) * MORE_HASHES).sum())
                if kind == UNI:
                    total, distinct = total + int(times.sum()), distinct + n
        yield emit(total=pa.array([total]), distinct=pa.array([distinct]), hashes=pa.array([hashes]))

    found = entries.mapInArrow(run, "total bigint, distinct bigint, hashes bigint").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct", "hashes"))).first()
    return found[0], found[1], math.ceil(found[2] / math.log(2))


def gathered(filled: DataFrame, segments: int) -> LogFrequencyFilter:
    """The whole filter; its size has been checked."""
    bits = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    for row in filled.toLocalIterator():
        bits[row.seg] = np.frombuffer(row.bits, np.uint8)
    return LogFrequencyFilter(bits, 0, segments)


def asked(rows: DataFrame, segments: int, each: int) -> DataFrame:
    """Texts, each with its slice and place (block -1), and the slices' questions: a row for a block's next keys, with the
    numbers of them that are words, and words or bigrams."""

    def run(batches):
        made = 0
        for batch in batches:
            for part in slices(batch):
                own = (TaskContext.get().partitionId() << 32) + made
                made += 1
                n = part.num_rows
                none = np.zeros(n, np.int64)
                yield emit(slice=pa.array(none + own), block=pa.array(none - 1), at=pa.array(np.arange(n)), uni=pa.array(none), bi=pa.array(none), data=pa.nulls(n, pa.binary()), doc_id=part.column("doc_id"), text=part.column("text"))
                q = Questions(*tokens(part.column("text")))
                order, block = q.dealt(segments, each)
                keys = np.concatenate([k for k, _ in q.keys])[order]
                kinds = np.repeat(np.array(KINDS, np.int8), [len(k) for k, _ in q.keys])[order]
                cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
                spans = [(x, min(x + ASKED, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) for x in range(a, b, ASKED)]
                n, first = len(spans), [a for a, _ in spans]
                yield emit(
                    slice=pa.array([own] * n, pa.int64()), block=pa.array(block[first]), at=pa.array(first, pa.int64()), uni=pa.array([int((kinds[a:b] <= UNI).sum()) for a, b in spans], pa.int64()), bi=pa.array([int((kinds[a:b] <= BI).sum()) for a, b in spans], pa.int64()),
                    data=pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()), doc_id=pa.nulls(n, pa.int64()), text=pa.nulls(n, pa.string()),
                )

    return rows.mapInArrow(run, "slice bigint, block bigint, at bigint, uni bigint, bi bigint, data binary, doc_id bigint, text string")


def together(rows: list[list[np.ndarray]], own: LogFrequencyFilter) -> list[np.ndarray]:
    """The levels of the keys of each row (of each kind in KINDS), which are asked all at once, and equal ones once: what a call
    costs besides its keys does not depend on their number."""
    found = []
    for j, kind in enumerate(KINDS):
        keys, back = np.unique(np.concatenate([r[j] for r in rows]), return_inverse=True)
        found.append(np.split(own.levels(keys, kind)[back], np.cumsum([len(r[j]) for r in rows])[:-1]))
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def answered(questions: DataFrame, filled: DataFrame, segments: int, each: int) -> DataFrame:
    """slice, at, data (levels) of the questions. Each block's segments come before what is asked of them."""

    def run(batches):
        at, own = -1, None
        waiting: list[tuple] = []
        many = 0

        def out():
            slice_, place, data = zip(*((s, a, found.tobytes()) for (s, a, _), found in zip(waiting, together([keys for _, _, keys in waiting], own), strict=True)), strict=True)
            waiting.clear()
            return emit(slice=pa.array(slice_, pa.int64()), at=pa.array(place, pa.int64()), data=pa.array(data, pa.binary()))

        for batch in batches:
            for block, what, s, a, uni, bi, data in zip(*(batch.column(c).to_pylist() for c in ("block", "what", "slice", "at", "uni", "bi")), batch.column("data"), strict=True):
                if waiting and (block != at or many > COMBINED):
                    yield out()
                    many = 0
                if block != at:
                    at, own = block, LogFrequencyFilter(np.zeros((min(each, segments - block * each), SEGMENT_BITS // 8), np.uint8), block * each, segments)
                if what == 0:
                    own.bits[a - own.first] = np.frombuffer(data.as_buffer(), np.uint8)
                    continue
                keys = np.frombuffer(data.as_buffer(), np.uint64)
                waiting.append((s, a, np.split(keys, [uni, bi])))
                many += len(keys)
        if waiting:
            yield out()

    none = F.lit(0).cast("long")
    bits = filled.select(F.floor(F.col("seg") / each).cast("long").alias("block"), F.lit(0).alias("what"), none.alias("slice"), F.col("seg").alias("at"), none.alias("uni"), none.alias("bi"), F.col("bits").alias("data"))
    both = bits.union(questions.select("block", F.lit(1).alias("what"), "slice", "at", "uni", "bi", "data"))
    return both.repartition(max(partitions(questions), 2 * math.ceil(segments / each)), "block").sortWithinPartitions("block", "what").mapInArrow(run, "slice bigint, at bigint, data binary")


def whole_slices(batches):
    """doc_id and text, and the levels of the questions, of one slice after another."""
    at, texts, levels = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        slice_, what = batch.column("slice").to_numpy(), batch.column("what").to_numpy()
        cuts = [0, *(np.flatnonzero((slice_[1:] != slice_[:-1]) | (what[1:] != what[:-1])) + 1).tolist(), len(slice_)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if slice_[a] != at and texts:
                yield pa.Table.from_batches(texts).combine_chunks().to_batches()[0], np.concatenate(levels)
                texts, levels = [], []
            at = slice_[a]
            if what[a] == 0:
                texts.append(batch.slice(a, b - a).select(["doc_id", "text"]))
            else:
                levels += [np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column("data").slice(a, b - a)]
    if texts:
        yield pa.Table.from_batches(texts).combine_chunks().to_batches()[0], np.concatenate(levels)


SCORED = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double, rare array<bigint>, times array<bigint>"


def scored(parts, frequent, total: int, distinct: int):
    """SCORED rows of (texts, their questions, levels): the rare words and their occurrences are left to a join."""
    keys, often = frequent
    size = total + 0.1 * (distinct + 1)
    made = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    for part, q, levels in parts:
        ends, n = q.ends, part.num_rows
        model = np.add.reduceat(q.score(levels, total, distinct), ends[:-1])
        signed = q.words.view(np.int64)
        at = np.minimum(np.searchsorted(keys, signed), max(len(keys) - 1, 0))
        hit = keys[at] == signed if len(keys) else np.zeros(len(signed), bool)
        known = np.where(hit, np.log10((often[at] + 0.1) / size), 0.0) if len(keys) else np.zeros(len(signed))
        base, found = np.add.reduceat(known[q.at], ends[:-1]), np.add.reduceat(hit[q.at].astype(np.int64), ends[:-1])
        rest = np.flatnonzero(~hit[q.at])
        pair, times = np.unique(doc_index(ends)[rest] * np.int64(len(signed)) + q.at[rest], return_counts=True)
        cuts = np.searchsorted(pair, np.arange(n + 1) * np.int64(len(signed))).astype(np.int32)
        lists = lambda x: pa.ListArray.from_arrays(pa.array(cuts), pa.array(x.astype(np.int64)))  # noqa: B023, E731
        yield emit(row=pa.array(np.arange(made, made + n)), doc_id=part.column("doc_id"), n_tokens=pa.array(np.diff(ends)), n_known=pa.array(found), base=pa.array(base), score=pa.array(model), rare=lists(signed[pair % len(signed)]), times=lists(times))
        made += n


def spelled(counted: DataFrame, table_size: int):
    """The unigrams (key, n) as a table, and the `table_size` most frequent ones, broadcast."""

    def spell(batches):
        for batch in batches:
            for n, data in zip(batch.column("n").to_pylist(), batch.column("data"), strict=True):
                key, times, *_ = unpacked(data.as_buffer(), n)
                yield emit(key=pa.array(key.view(np.int64)), n=pa.array(times.astype(np.int64)))

    words = store(counted.filter(F.col("kind") == UNI).mapInArrow(spell, "key bigint, n bigint"), "words")
    top = words.orderBy(F.desc("n"), "key").limit(table_size).toArrow()  # table_size rows at most
    key, n = (top.column(c).to_numpy() for c in ("key", "n"))
    order = np.argsort(key)
    return words, words.sparkSession.sparkContext.broadcast((key[order], n[order]))


def with_rare(found: DataFrame, words: DataFrame, total: int, distinct: int) -> DataFrame:
    """SCORED rows with the share of their rare words."""
    n, size = F.coalesce("n", F.lit(0)), total + 0.1 * (distinct + 1)
    rare = found.filter(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    rare = rare.join(words, "key", "left").groupBy("row").agg(F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10((n + 0.1) / size)).alias("more_base"))
    return found.join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score"
    )


def base(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", table_size: int = 1 << 19) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score for every row, as `score` gives them: without the model, and so
    without bigrams and without a filter."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = store(counts(docs.filter(train).select(F.col(text_col).cast("string").alias("text")), 1, partitions(docs), pairs=False), "word-counts")
    total, distinct, _ = summed(counted)
    words, frequent = spelled(counted, table_size)
    drop(counted, shuffles=True)

    def run(batches):
        parts = ((part, Words(*tokens(part.column("text"))), None) for batch in batches for part in slices(batch))
        return scored(parts, frequent.value, total, distinct)

    return with_rare(store(rows.mapInArrow(run, SCORED), "scored"), words, total, distinct).drop("score")


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", least: int = 2, filter_bytes: int = 64 << 20, table_size: int = 1 << 19, groups: int = 8) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row; `train` picks the training rows."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = partitions(docs)
    counted = store(counts(docs.filter(train).select(F.col(text_col).cast("string").alias("text")), least, buckets), "ngram-counts")
    mass = store(masses(counted, buckets), "history-masses")
    entries = counted.union(mass)
    total, distinct, bits = summed(entries)
    each = max(1, math.ceil(bits / buckets / SEGMENT_BITS))
    segments = buckets * each
    filled = store(fill(entries, buckets, each), "segments")

    words, frequent = spelled(counted, table_size)
    drop(counted, mass, shuffles=True)

    if segments * SEGMENT_BITS // 8 <= filter_bytes:
        shared = spark.sparkContext.broadcast(gathered(filled, segments))

        def in_place(batches):
            def parts():
                for batch in batches:
                    for part in slices(batch):
                        q = Questions(*tokens(part.column("text")))
                        yield part, q, q.answered(shared.value)

            return scored(parts(), frequent.value, total, distinct)

        found = store(rows.mapInArrow(in_place, SCORED), "scored")
    else:
        # the blocks follow the cores and not the input, as each slice has a row of questions for each of them
        block = max(1, min(filter_bytes * 8 // SEGMENT_BITS, math.ceil(segments / max(BLOCKS, 4 * spark.sparkContext.defaultParallelism))))
        done = [store(_by_block(rows.filter(F.pmod(row_key(), F.lit(groups)) == g), filled, segments, block, frequent, total, distinct).withColumn("row", F.col("row") * groups + g), "scored") for g in range(groups)]
        found = done[0]
        for more in done[1:]:
            found = found.union(more)
    drop(filled)
    return with_rare(found, words, total, distinct)


def _by_block(rows: DataFrame, filled: DataFrame, segments: int, each: int, frequent, total: int, distinct: int) -> DataFrame:
    """SCORED rows by a filter that stays on the executors, in blocks of `each` segments."""
    sliced = store(asked(rows, segments, each), "slices")
    texts = sliced.filter("block < 0").select("slice", F.lit(0).alias("what"), "at", "doc_id", "text", "data")
    answers = store(answered(sliced.filter("block >= 0"), filled, segments, each), "answers")
    answers = answers.select("slice", F.lit(1).alias("what"), "at", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "data")
    ordered = texts.union(answers).repartition(partitions(rows), "slice").sortWithinPartitions("slice", "what", "at")

    def run(batches):
        def parts():
            for part, levels in whole_slices(batches):
                q = Questions(*tokens(part.column("text")))
                in_order = np.zeros(sum(len(k) for k, _ in q.keys), np.uint16)
                in_order[q.dealt(segments, each)[0]] = levels
                yield part, q, in_order

        return scored(parts(), frequent.value, total, distinct)

    out = store(ordered.mapInArrow(run, SCORED), "scored")
    drop(sliced, answers, shuffles=True)
    return out
