"""Every operator against a brute-force version on a small table with the awkward cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blockloom.llm import decontaminate, jaccard_join, language_id, lm_scoring, packing, quality_fm, quality_rules, queries, secrets, substring_dedup, token_counts
from blockloom.llm.common import hash_words, held_out, row_key, slices, split_words
from blockloom.llm.components import components
from blockloom.llm.queries import BYTE_BPE, WORD_BPE, vocabulary
from blockloom.llm.tokenizing import ByteIds, WordLengths, load

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, start bigint, term string, key bigint"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus():
    rng = random.Random(5)
    words = {"en": "the of and to in that was he it with for as on his is at by be this from".split(), "fr": "le la les des et à un être pour que dans ce qui sur ne pas plus été avec où".split()}
    rows = []

    def add(text, lang="en"):
        rows.append((len(rows), text, lang, "s", None if text is None else len(text), 7, "x", 9))

    make = lambda n, lang: " ".join(rng.choice(words[lang]) + rng.choice(["", "", "er", "ing", "x" * rng.randint(1, 5) + str(rng.randint(0, 99))]) for _ in range(n))
    for i in range(60):
        lang = ("en", "fr")[i % 2]
        add(make(rng.choice([3, 12, 40, 90, 200]), lang).capitalize() + (".\n" if i % 3 else "\n") + make(20, lang) + ".", lang)
    long = [r[1] for r in rows if len(r[1].split()) > 100]
    for t in long[:6]:
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        add(" ".join(w))
        add(t)
        add(t + " tail words here")
    passage = " ".join(f"passage{i}" for i in range(50))
    for i in range(4):
        add(make(30, "en") + " " + passage + " " + make(30, "en"))
    add(passage + " " + passage)
    add(" ".join(["same"] * 120))
    add(make(30, "en") + ' token = "' + hashlib.sha1(b"1").hexdigest() + '" ' + "AKIA" + "ABCDEFGHIJ0123456789")
    add(None)
    add("")
    add(" \n\t ")
    add("123 456 !!!")
    add("a\n" * 30 + "### $$$ " * 40)
    add("Ωmega 中文字 <|endoftext|> Éa don't it's  two  spaces\n\n\tend")
    add(make(9000, "fr"), None)
    rows.append(rows[3])  # a repeated row
    rows.append((None, "null id text the of and", "en", None, None, None, None, None))
    return rows


ROWS = corpus()
UNIQUE = {r[0]: r[1] or "" for r in ROWS if r[0] is not None}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def lowered(text):
    return [w.decode() for w in text.translate(LOWER).encode().split()]


def test_lm_scoring(docs, empty):
    got = lm_scoring.score(docs, ~held_out("doc_id", 10, 0)).collect()
    rows = [(i, lowered(t or "") + [None]) for i, t, *_ in ROWS]
    count = Counter(w for i, ws in rows if i is None or zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, distinct = sum(count.values()), len(count)
    base = lambda ws: sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
    expected = sorted([(i, len(ws), sum(count[w] > 0 for w in ws), total, base(ws)) for i, ws in rows], key=repr)
    found = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=repr)
    assert [x[:4] for x in found] == [x[:4] for x in expected] and [x[4] for x in found] == pytest.approx([x[4] for x in expected], rel=1e-9)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert lm_scoring.score(empty, ~held_out("doc_id", 10, 0)).count() == 0


def test_lm_base_needs_no_model(spark, docs, empty, monkeypatch):
    train = ~held_out("doc_id", 10, 0)
    columns = ["doc_id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 9).alias("base_score")]
    expected = sorted(map(repr, lm_scoring.score(docs, train, table_size=20).select(*columns).collect()))
    monkeypatch.setattr(lm_scoring, "fill", lambda *a: 1 / 0)
    monkeypatch.setattr(lm_scoring, "masses", lambda *a: 1 / 0)
    assert sorted(map(repr, lm_scoring.base(docs, train, table_size=20).select(*columns).collect())) == expected
    assert lm_scoring.base(empty, train).count() == 0
    monkeypatch.setattr(queries, "table", lambda *a: docs)
    assert queries.lm_scoring_base(spark, "").count() == docs.count()


def test_lm_scoring_by_row(spark):
    """Rows without an id, or that share one, are scored for themselves; the score is that of the smoothed model."""
    rows = [(None, "a b c"), (None, "x y"), (7, "a b c a b c"), (7, None), (-1, "a b"), (-1, "a b")]
    got = lm_scoring.score(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), F.lit(True)).collect()
    texts = [(t or "").split() + ["END"] for _, t in rows]
    count, pair = Counter(w for ws in texts for w in ws), Counter(p for ws in texts for p in zip(["END", *ws], ws, strict=False))
    n, v = sum(count.values()), len(count)

    def p(before, w):
        mass = sum(c - 0.75 for (x, _), c in pair.items() if x == before and c >= 2)
        mass = lm_scoring.VALUES[lm_scoring.levels_of(np.array([mass]))[0]] if mass else 0.0
        kept = min(mass / count[before], 0.98)
        seen = min(max(pair[before, w] - 0.75, 0) / count[before], kept) if mass and pair[before, w] >= 2 else 0.0
        return math.log10(seen + (1 - kept) * (count[w] + 0.1) / (n + 0.1 * (v + 1)))

    expected = sorted([(str(i), len(ws), sum(p(x, w) for x, w in zip(["END", *ws], ws, strict=False))) for (i, _), ws in zip(rows, texts, strict=True)])
    found = sorted((str(r.doc_id), r.n_tokens, r.score) for r in got)
    assert [x[:2] for x in found] == [x[:2] for x in expected] and [x[2] for x in found] == pytest.approx([x[2] for x in expected], rel=1e-9)


def test_filter_counts_are_close(spark):
    rng = np.random.default_rng(0)
    keys, n = rng.integers(0, 1 << 63, 3000).astype(np.uint64), rng.integers(1, 5000, 3000)
    batches = lm_scoring.packed(lm_scoring.UNI, 4, keys, n.astype(np.float64)).to_pylist()
    rows = spark.createDataFrame([(r["kind"], r["bucket"], r["n"], bytearray(r["data"])) for r in batches], lm_scoring.PACKED)
    _, distinct, bits = lm_scoring.summed(rows)
    f = lm_scoring.gathered(lm_scoring.fill(rows, 4, -(-bits // 4 // lm_scoring.SEGMENT_BITS)), 4 * -(-bits // 4 // lm_scoring.SEGMENT_BITS))
    got = f.ask(keys, 1)
    assert distinct == 3000 and (got >= n * 0.85).all() and np.mean(np.abs(got - n) <= 0.2 * n) > 0.85
    assert np.mean(f.ask(rng.integers(0, 1 << 63, 3000).astype(np.uint64), 1) > 0) < 0.02


def test_lm_scoring_asks_a_block_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    keys, n = rng.integers(0, 1 << 63, 500, dtype=np.uint64), rng.integers(1, 60, 500)
    own = lm_scoring.LogFrequencyFilter(np.zeros((2, lm_scoring.SEGMENT_BITS // 8), np.uint8), 3, 5)
    own.bits[:] = rng.integers(0, 256, own.bits.shape) & rng.integers(0, 256, own.bits.shape)  # probes of all kinds of fates
    inside = lambda x, kind: x[np.isin(lm_scoring.share(lm_scoring.home(x, kind), 5), [3, 4])]
    for level in range(1, 60):
        for i in range(lm_scoring.HASHES if level == 1 else lm_scoring.MORE_HASHES):
            x = inside(keys[n >= level], lm_scoring.UNI)
            base = lm_scoring.home(x, lm_scoring.UNI)
            bit = lm_scoring.places(base, level, i)
            np.bitwise_or.at(own.bits, ((lm_scoring.share(base, 5) - np.uint64(3)).astype(int), (bit >> np.uint64(3)).astype(int)), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))

    def one(key, kind):
        """The definition, level after level and probe after probe."""
        base, level = lm_scoring.home(np.array([key]), kind), 0
        row = int(lm_scoring.share(base, 5)[0]) - 3
        while level < len(lm_scoring.LEVELS):
            bits = [int(lm_scoring.places(base, level + 1, i)[0]) for i in range(lm_scoring.MORE_HASHES if level else lm_scoring.HASHES)]
            if not all(own.bits[row, b >> 3] >> (b & 7) & 1 for b in bits):
                break
            level += 1
        return level

    rows = [[inside(rng.choice(keys, 80), kind) for kind in lm_scoring.KINDS] for _ in range(12)]
    calls, levels = [], lm_scoring.LogFrequencyFilter.levels
    monkeypatch.setattr(lm_scoring.LogFrequencyFilter, "levels", lambda self, x, kind: calls.append(len(x)) or levels(self, x, kind))
    got = lm_scoring.together(rows, own)
    assert len(calls) == 3  # not three for each row
    assert [g.tolist() for g in got] == [[one(k, kind) for x, kind in zip(r, lm_scoring.KINDS, strict=True) for k in x] for r in rows]
    assert max(g.max() for g in got) > 10


def test_lm_scoring_blocks_do_not_follow_the_partitions(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b{i % 3} c d") for i in range(30)], "doc_id bigint, text string").repartition(2)
    seen = []
    monkeypatch.setattr(lm_scoring, "partitions", lambda df, *a: 100)  # as of a large input
    monkeypatch.setattr(lm_scoring, "_by_block", lambda rows, filled, segments, each, *a: seen.append((segments, each)) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lm_scoring.score(docs, F.lit(True), filter_bytes=1 << 20)
    segments, each = seen[0]
    assert segments >= 100
    assert math.ceil(segments / each) <= max(64, 4 * spark.sparkContext.defaultParallelism)


def test_lm_scoring_is_the_same_by_blocks(spark):
    """A filter that stays on the executors, words beyond the broadcast table: the same scores as with both broadcast."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(2000))) for i in range(120)]
    rows.append((120, rows[0][1]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    wide = by_id(lm_scoring.score(docs, F.lit(True)))
    small = by_id(lm_scoring.score(docs, F.lit(True), filter_bytes=1 << 17, table_size=3, groups=2))
    for what in ("score", "base_score", "n_known"):
        assert {i: r[what] for i, r in small.items()} == pytest.approx({i: r[what] for i, r in wide.items()}, rel=1e-9)
    for i in range(1, 120):  # c = 1 for each word, no bigram kept
        assert small[i].score == pytest.approx(small[i].base_score, rel=0.02)
    assert small[0].score > 0.5 * small[0].base_score  # its bigrams are seen twice


def test_slices_keep_all_words():
    texts = [t for _, t, *_ in ROWS] * 4
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    for lower in (False, True):
        whole, ends = split_words(batch.column("text"), lower)
        assert [w.encode() for w in whole.to_pylist()] == [w for t in texts for w in ((t or "").translate(LOWER) if lower else t or "").encode().split()]
        parts = [split_words(p.column("text"), lower) for p in slices(batch, most=4000)]
        assert len(parts) > 20
        assert [w for p, _ in parts for w in p.to_pylist()] == whole.to_pylist()
        assert np.array_equal(np.concatenate([hash_words(p) for p, _ in parts]), hash_words(whole))
        assert sum(e[-1] for _, e in parts) == ends[-1]


@pytest.mark.parametrize("k", [35, 20])
def test_substring_dedup(docs, empty, k):
    texts = [(i, (t or "").encode().split()) for i, t, *_ in ROWS]
    count = Counter(tuple(w[s : s + k]) for _, w in texts for s in range(len(w) - k + 1))
    expected = {}
    for i, w in texts:
        gone = {p for s in range(len(w) - k + 1) if count[tuple(w[s : s + k])] > 1 for p in range(s, s + k)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        expected[i] = len(w), len(gone), hashlib.sha256(kept).hexdigest()
    rows = substring_dedup.remove(docs, k).collect()
    assert len(rows) == len(ROWS)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == expected
    assert substring_dedup.remove(empty, k).count() == 0


def test_substring_dedup_tells_rows_without_id_apart(spark):
    rng = random.Random(4)
    make = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = make(60)
    texts = [(i, make(n) + " " + passage + " " + make(20)) for i, n in [(None, 5), (None, 50), (None, 17), (7, 3), (7, 90), (8, 40)]] + [(None, make(50)), (None, make(3)), (7, make(70))]
    rows = substring_dedup.remove(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3), 35).collect()
    assert sorted(r.kept for r in rows) == sorted(" ".join(t.replace(passage, "").split()) for _, t in texts)


def test_units_do_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    h, ends = rng.integers(0, 50, 4000).astype(np.uint64), np.array([0, 1500, 1520, 4000])
    whole = substring_dedup.units(h, ends, 35)
    monkeypatch.setattr(substring_dedup, "CHUNK", 300)
    parts = substring_dedup.units(h, ends, 35)
    windows = lambda u: {(int(t), int(s) + j, int(m)) for m, _, _, t, s, n in zip(*u, strict=True) for j in range(n)}
    assert windows(whole) == windows(parts)
    assert sum(whole[5]) == 1466 + 0 + 2446


def test_language_id(docs, empty):
    train = ~held_out("doc_id", 4, 2)
    model = language_id.fit(docs, train)
    got = language_id.predict(docs, model, "doc_id", "lang").collect()
    assert len(got) == len(ROWS)
    for r in got:
        text = UNIQUE.get(r.doc_id)
        if text is not None and not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert 0 <= r.score <= 1
    clear = [r for r in got if r.lang in ("en", "fr") and r.doc_id is not None and r.doc_id < 60 and len(UNIQUE[r.doc_id]) > 150]
    assert np.mean([r.lang_pred == r.lang for r in clear]) > 0.95
    assert language_id.predict(empty, language_id.fit(empty, train), "doc_id").count() == 0
    assert {r.lang_pred for r in language_id.predict(docs, language_id.fit(empty, train), "doc_id").collect()} == {"und"}


def test_quality_rules(docs, empty):
    got = quality_rules.judge(docs).collect()
    expected = []
    for i, t, *_ in ROWS:
        t = t or ""
        w = WORD.findall(t)
        grams = [tuple(w[s : s + 5]) for s in range(len(w) - 4)]
        count = Counter(grams)
        again = {p for s, g in enumerate(grams) if count[g] > 1 for p in range(s, s + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        expected.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), len(w) < 10 or 100 * len(again) > 20 * len(w)))
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert all(0 <= r.quality <= 1 and r.kept == (not r.base_failed and r.quality >= 0.5) for r in got)
    assert quality_rules.judge(empty).count() == 0


def planted_votes(spark, n=6000, good=0.75, accuracy=((0.95, 0.9), (0.85, 0.8), (0.8, 0.75), (0.9, 0.6), (0.55, 0.5)), cast=0.8):
    """Documents of known class, and rules that vote (`cast` of the time) with known accuracy on good and on bad ones."""
    rng = random.Random(12)
    rows = []
    for i in range(n):
        y = rng.random() < good
        rows.append((i, y, *(0 if rng.random() > cast else (1 if (rng.random() < right[0 if y else 1]) == y else -1) for right in accuracy)))
    names = [f"v{j}" for j in range(len(accuracy))]
    return spark.createDataFrame(rows, f"doc_id int, good boolean, {', '.join(f'{x} int' for x in names)}"), names


def test_em_estimates_the_accuracies(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "PULL", 0.001)
    voted, names = planted_votes(spark)
    rates, prior = quality_rules.fit(voted, names, rounds=80)
    assert prior == pytest.approx(0.75, abs=0.06)
    for j, (on_good, on_bad) in enumerate(((0.95, 0.9), (0.85, 0.8), (0.8, 0.75), (0.9, 0.6))):
        assert 1 - rates[f"v{j}", 1] == pytest.approx(on_good, abs=0.08) and rates[f"v{j}", 0] == pytest.approx(on_bad, abs=0.08)
    right = voted.withColumn("q", quality_rules.posterior(rates, prior, names)).agg(F.avg(((F.col("q") >= 0.5) == F.col("good")).cast("int"))).first()[0]
    assert right > 0.9


def test_a_single_weak_bad_vote_is_outvoted(spark):
    voted, names = planted_votes(spark)
    rates, prior = quality_rules.fit(voted, names)
    rows = spark.createDataFrame([(1, 1, 1, 1, -1), (-1, -1, -1, 1, 1), (0, 0, 0, 0, 0), (1, 0, 0, 0, 0)], ", ".join(f"{x} int" for x in names))
    weak, bad, none, one = (r.q for r in rows.select(quality_rules.posterior(rates, prior, names).alias("q")).collect())
    assert weak > 0.9 and bad < 0.1 and none == pytest.approx(prior) and one > none  # abstentions say nothing, good votes do


def test_quality_rules_use_no_python(docs):
    plan = quality_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


ITEMS = [(0, "passage3 passage4 PASSAGE5-passage6 passage7 passage8 passage9 passage10 passage11 passage12 passage13"), (1, "same same same"), (2, None), (3, ""), (4, "the the the"), (10, "tail words here"), (11, "中文字"), (12, "never anywhere")]


TERM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def term_list(t):
    return TERM.findall((t or "").translate(LOWER))


def brute_hits(texts, items, size=10):
    """For each row: its words, hit and item counts, the items' digest, contaminated."""
    wins = [(i, w[s : s + size]) for i, t in items for w in [term_list(t)] if w for s in range(max(len(w) - size, 0) + 1)]
    out = []
    for key, t in texts:
        w = term_list(t)
        hits = [(i, s, len(g)) for i, g in wins for s in range(len(w) - len(g) + 1) if w[s : s + len(g)] == g]
        ids = sorted({str(i) for i, _, _ in hits})
        places = {p for _, s, n in hits for p in range(s, s + n)}
        out.append((key, len(w), len(places), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(places)))
    return sorted(out, key=repr)


def hits_of(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect()), key=repr)


def test_decontamination(spark, docs, empty):
    bench = spark.createDataFrame([(*r, "clash") for r in ITEMS], "item_id bigint, text string, win string").repartition(3)
    for small in (1 << 20, 0):
        assert hits_of(decontaminate.summary(docs, bench, broadcast_bytes=small)) == brute_hits([(r[0], r[1]) for r in ROWS], ITEMS)
    assert decontaminate.summary(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.summary(docs, bench.limit(0)).collect())


def test_decontamination_uses_no_python(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert not re.search("Python|Pandas|Arrow", decontaminate.summary(docs.sparkSession.createDataFrame(docs.collect()[:9], docs.schema), bench)._jdf.queryExecution().optimizedPlan().toString())


def test_decontamination_by_row(spark):
    """Rows that share an id or have none, a repeated row, and id -1."""
    rows = [(None, "clean"), (None, "x one two three y"), (5, "nothing here"), (5, "one two three"), (5, "one two three"), (-1, "two three one two three"), (None, None)]
    bench = [(1, "one two three"), (1, "one two three"), (None, "y")]
    got = hits_of(decontaminate.summary(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), spark.createDataFrame(bench, "item_id bigint, text string")))
    found = {(r[0], r[1], r[2], r[5]) for r in got}
    assert len(got) == len(rows) and found == {(None, 1, 0, False), (None, 5, 4, True), (5, 2, 0, False), (5, 3, 3, True), (-1, 5, 3, True), (None, 0, 0, False)}


def test_decontamination_with_few_terms_and_a_hot_one(spark):
    rng = random.Random(7)
    word = lambda: rng.choice("aaaaaaab") if rng.random() < 0.9 else rng.choice("cd")
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 9, 10, 14, 30])))) for i in range(25)]
    rows = [(i, " ".join(word() for _ in range(60))) for i in range(40)] + [(100 + i, " ".join(["a"] * 30 + [items[i][1]] + ["a"] * 20)) for i in range(25)]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), spark.createDataFrame(items, "item_id bigint, text string")
    for size in (10, 4):
        assert hits_of(decontaminate.summary(docs, bench, size)) == brute_hits(rows, items, size)


def test_proximity(spark):
    rng = random.Random(11)
    items = [(1, "here tail words"), (2, "a b"), (3, "rare a a"), (4, "none of these")]
    rows = [(i, " ".join(rng.choice(["here", "tail", "words", "a", "b", "x", "y", "rare"]) for _ in range(rng.randrange(40)))) for i in range(60)]
    count = Counter(w for _, t in rows for w in term_list(t))
    expected = set()
    for d, t in rows:
        w = term_list(t)
        for i, item in items:
            need = term_list(item)
            if not all(count[x] for x in need):
                continue
            rarest = min(need, key=lambda x: (count[x], x))
            expected |= {(t, i, p) for p, x in enumerate(w) if x == rarest and set(need) <= set(w[max(0, p - 9) : p + 10])}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    near = decontaminate.matches(docs, spark.createDataFrame(items, "item_id bigint, text string"), kind="proximity").join(docs.select(row_key().alias("key"), "text"), "key")
    assert {(r.text, r.item_id, r.start) for r in near.collect()} == expected and expected


def test_token_counts(docs, empty):
    tok = load(vocabulary(WORD_BPE))
    got = token_counts.count_tokens(docs, vocabulary(WORD_BPE), limit=100).collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r.doc_id is not None:
            t = UNIQUE[r.doc_id]
            n = len(tok.encode(t, add_special_tokens=False).ids)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 100)
    assert token_counts.count_tokens(empty, vocabulary(WORD_BPE)).count() == 0


def test_tokenizing_agrees_with_the_library():
    words, ids = WordLengths(vocabulary(WORD_BPE)), ByteIds(vocabulary(BYTE_BPE))
    rng = random.Random(2)
    letters = [chr(i) for i in range(0x250)] + list("  \n\t''sstdmabc019") * 20 + ["̇", "́", "Σ", "中", "é"]
    for i in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) + "<|endoftext|>" * (i % 50 == 0)
        assert words.count(t) == len(words.tok.encode(t, add_special_tokens=False).ids), repr(t)
        assert ids.encode(t) == np.array(ids.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)


def test_secret_scan(docs, empty):
    model = secrets.fit(docs)
    got = secrets.scan(docs, model).collect()
    assert len(got) == len(ROWS)
    patterns = [r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "AKIA[A-Z0-9]+", "[0-9a-f]+"]
    for r in got:
        if r.doc_id is not None:
            spans = [(m.start(), k, m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, UNIQUE[r.doc_id]) if len(m[1] if k == 0 else m[0]) >= (6, 20, 24)[k]]
            assert r.base_sha256 == hashlib.sha256(secrets.joined(spans).encode()).hexdigest()
            assert all(x in r.spans for x in secrets.joined(spans).split(","))
    clean = {r.doc_id: r for r in secrets.redact(docs, model).collect()}
    assert len(clean) == len({r[0] for r in ROWS}) and not any("AKIAABC" in (r.text or "") for r in clean.values())
    assert clean[0].text == UNIQUE[0] and clean[0].start == 7
    assert secrets.scan(empty, secrets.fit(empty)).count() == 0


def test_automata_find_the_format():
    rng = random.Random(3)
    hexes = [hashlib.sha1(str(i).encode()).hexdigest().translate(secrets.TO_CLASS) for i in range(200)]
    plain = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(16, 30))).translate(secrets.TO_CLASS) for _ in range(400)]
    model = secrets.Model({"hex": hexes}, plain)
    text = "see " + hashlib.sha1(b"new").hexdigest() + " and internationalisation-of-things"
    assert model.score(hashlib.sha1(b"x").hexdigest()) > model.bits
    assert secrets.learned_spans(text, [], model) == [(4, 3, 44)]
    assert len(model.automata["hex"].step) > 1


def test_automata_learn_from_all_documents(spark):
    """A kind in few of many documents, behind many copies of one value."""
    rng = random.Random(8)
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHIJ0123456789") for _ in range(16)) for _ in range(40)]
    texts = ["see " + keys[0]] * 600 + ["ordinary words of a document"] * 1400 + [f"see {k} there" for k in keys]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    model = secrets.fit(docs, sample_docs=50)
    assert "access" in model.automata and model.automata["access"].total(0) == 40


def test_short_and_glued_credentials_are_scored():
    rng = random.Random(6)
    make = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    lower = "abcdefghijklmnopqrstuvwxyz"
    labelled = {"long": [make("ABCDEF0123456789", 32).translate(secrets.TO_CLASS) for _ in range(200)], "short": [make("GHIJKLMNOPQR", 10).translate(secrets.TO_CLASS) for _ in range(200)]}
    model = secrets.Model(labelled, [make(lower, rng.randint(6, 14)).translate(secrets.TO_CLASS) for _ in range(1600)])
    long, short = make("ABCDEF0123456789", 32), make("GHIJKLMNOPQR", 10)
    for before in ("", "auth=", "aws_access=", "https://host.example/"):
        for value in (long, short):
            text = f"some ordinary words {before}{value} follow"
            at = text.index(value)
            assert secrets.learned_spans(text, [], model) == [(at, 3, at + len(value))]
    text = "password=hunter2hunter2/" + long
    assert secrets.learned_spans(text, [(0, 0, 23)], model) == [(24, 3, 24 + 32)]
    assert secrets.learned_spans("nothing but ordinary sentences, internationalisation/of.things", [], model) == []


def near_copies(rng, groups=6):
    rows, n = [], 0
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.choice([4, 11, 30, 150, 600]))]
        for _ in range(rng.choice([1, 8, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, max(1, len(w) // 60)])):
                w[rng.randrange(len(w))] = f"n{rng.randint(0, 10**6)}"
            rows.append((n, " ".join(w)))
            n += 1
    return rows


@pytest.mark.parametrize(("percent", "size"), [(90, 3), (80, 5)])
def test_jaccard_join(spark, empty, percent, size):
    rows = near_copies(random.Random(percent)) + [(900, None), (901, ""), (902, "two Words"), (903, "TWO words"), (904, "a"), (905, "a a a a a")]
    rows += [rows[0]]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, cls int, sig string").repartition(4)
    sets = {}
    for i, t in rows:
        w = lowered(t or "")
        sets[i] = {tuple(w[s : s + size]) for s in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    got = jaccard_join.join(docs, percent, size).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), find(i)) for i, s in sets.items()}
    assert jaccard_join.join(empty, percent, size).count() == 0


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_linked_sets_share_a_signature(percent):
    rng, bands, linked = np.random.default_rng(percent), jaccard_join.Bands(percent), 0
    for _ in range(1500):
        n = int(rng.integers(1, 60)) if rng.random() < 0.5 else int(rng.integers(60, 900))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        cut = int(rng.integers(0, int((100 - percent) / 100 * n) + 2))
        new = int(rng.integers(0, cut + 1))
        b = np.concatenate([a[cut - new :], rng.integers(0, 1 << 63, new).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if len(b) and both < max(len(a), len(b)) and 100 * both >= percent * (len(a) + len(b) - both):
            linked += 1
            sig, who = jaccard_join.signatures([a, b], bands)
            assert set(sig[who == 0].tolist()) & set(sig[who == 1].tolist())
            differ = sum(int(x).bit_count() for x in (jaccard_join.bitmap(a) ^ jaccard_join.bitmap(b)).view(np.uint64))
            assert differ <= len(a) + len(b) - 2 * both
    assert linked > 500


def test_jaccard_pairs_of_a_group_cut_into_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[i % 9 :], rng.integers(0, 1 << 63, i % 7).astype(np.uint64)])) for i in range(50)]
    rows = [(sig, c, len(s), c // 3, jaccard_join.bitmap(s).tolist()) for sig in (5, 6) for c, s in enumerate(sets)] + [(7, 50, 60, 50, [0] * 16)]
    expected = set()
    for a in range(50):
        for b in range(a + 1, 50):
            differ = sum(int(x).bit_count() for x in (jaccard_join.bitmap(sets[a]) ^ jaccard_join.bitmap(sets[b])).view(np.uint64))
            if a // 3 != b // 3 and 100 * min(len(sets[a]), len(sets[b])) >= 80 * max(len(sets[a]), len(sets[b])) and 180 * differ <= 20 * (len(sets[a]) + len(sets[b])):
                expected.add((a, b))
    members = spark.createDataFrame(rows, "sig bigint, cls bigint, n bigint, root bigint, bits array<bigint>")
    assert len(expected) > 50
    for together, pairs in ((2048, 1 << 19), (8, 40)):
        monkeypatch.setattr(jaccard_join, "TOGETHER", together)
        monkeypatch.setattr(jaccard_join, "PAIRS", pairs)
        got = jaccard_join.close_pairs(members, 80).collect()
        assert len(got) == len(expected) and {(r.a, r.b) for r in got} == expected


def test_jaccard_pairs_are_given_once(spark):
    # 60 classes that share 40 signatures each: every pair comes up 40 times
    rows = [(sig, c, 60, c, 40 + c, [7] * 16) for sig in range(40) for c in range(60)]
    members = spark.createDataFrame(rows, "sig bigint, cls bigint, n bigint, root bigint, deg bigint, bits array<bigint>")
    assert jaccard_join.given_pairs(members, 80).count() == 60 * 59 // 2


def test_wide_bitmaps_bound_the_difference():
    rng = np.random.default_rng(5)
    for n in (1, 200, 250, 257, 700):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 9 :], rng.integers(0, 1 << 63, n // 7).astype(np.uint64)]))
        differ = len(np.setxor1d(a, b))
        assert differ / 2 <= jaccard_join.bits_apart(jaccard_join.wide_bitmap(a), jaccard_join.wide_bitmap(b)) <= differ
        assert jaccard_join.bits_apart(jaccard_join.wide_bitmap(a), jaccard_join.wide_bitmap(a)) == 0


def test_sets_by_key_gives_each_wanted_row_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FILTER_BYTES", 64)  # several parts
    rows = spark.createDataFrame([(i % 300, f"w{i % 300} a b c d {i % 300}") for i in range(900)], "key bigint, text string").repartition(6)
    wanted = spark.range(0, 300, 2).withColumnRenamed("id", "key")
    got = jaccard_join.sets_by_key(rows, wanted, 3).filter("key % 2 = 0").collect()
    assert sorted(r.key for r in got) == list(range(0, 300, 2))
    for r in got:
        s = jaccard_join.sets_of(pa.array([f"w{r.key} a b c d {r.key}"]), 3)[0]
        assert r.s == s.view(np.int64).tolist() and r.cls == jaccard_join.digest(s) and r.wide == jaccard_join.wide_bitmap(s)


def test_jaccard_moves_a_set_for_its_pairs_only(spark, monkeypatch):
    rng = np.random.default_rng(3)
    ka = np.concatenate([np.full(500, 7), rng.integers(1000, 1100, 90)]).astype(np.int64)  # one row with many partners, and others
    kb = np.concatenate([np.arange(100, 600), rng.integers(2000, 2100, 90)]).astype(np.int64)
    key, dest, slot = jaccard_join.routes(ka, kb)
    groups = {}
    for k, d, g in zip(key.tolist(), dest.tolist(), slot.tolist(), strict=True):
        groups.setdefault((d, g), set()).add(k)
    assert all(any({a, b} <= g and (a == d or b == d) for (d, _), g in groups.items()) for a, b in zip(ka.tolist(), kb.tolist(), strict=True))
    assert all(d in g and len(g) <= jaccard_join.PARTNERS + 1 for (d, _), g in groups.items())
    assert len(key) == len(ka) + len(groups) and len(groups) < 120
    assert all(len(x) == 0 for x in jaccard_join.routes(ka[:0], kb[:0]))

    # rows that repeat, several broadcasts, and a leader whose groups are given in several batches
    monkeypatch.setattr(jaccard_join, "ROUTES", 40)
    monkeypatch.setattr(jaccard_join, "PARTNERS", 4)
    monkeypatch.setattr(jaccard_join, "ELEMENTS", 50)
    text = {i: " ".join([*(f"w{j}" for j in range(40 - i % 12)), f"x{i}"]) for i in range(80)}
    rows = spark.createDataFrame([(i % 80, text[i % 80]) for i in range(200)], "key bigint, text string").repartition(5)
    sets = {i: jaccard_join.sets_of(pa.array([text[i]]), 3)[0] for i in text}
    pairs = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(40, 79)]
    got = jaccard_join.verified(rows, spark.createDataFrame(pairs, "ka bigint, kb bigint"), 80, 3).collect()
    linked = {(x, y) for x, y in pairs if 100 * len(np.intersect1d(sets[x], sets[y])) >= 80 * len(np.union1d(sets[x], sets[y]))}
    name = {i: jaccard_join.digest(x) for i, x in sets.items()}
    assert 0 < len(linked) < len(pairs)
    assert sorted((r.a, r.b) for r in got) == sorted((min(name[x], name[y]), max(name[x], name[y])) for x, y in linked)


def test_jaccard_moves_only_repeated_signatures(spark, monkeypatch):
    words = random.Random(2)
    texts = [" ".join(words.choice("abcdefghijklmnopqrstuvwxyz") + str(words.randrange(99)) for _ in range(80)) for _ in range(60)]
    texts += [t.rsplit(" ", 2)[0] + " x y" for t in texts[:20]]
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id bigint, key bigint, text string").repartition(3)
    sig, who = jaccard_join.signatures(jaccard_join.sets_of(pa.array(texts), 3), jaccard_join.Bands(90))
    found = jaccard_join.repeated(rows, 90, 3, 8).cache()
    values, times = np.unique(sig, return_counts=True)
    assert found.agg({"n": "sum"}).first()[0] == (times > 1).sum()
    monkeypatch.setattr(jaccard_join, "FILTER_BYTES", 64)
    each, spans = jaccard_join.filters(found, 8)
    assert len(spans) > 1
    moved = 0
    for span in spans:
        shared = spark.sparkContext.broadcast(jaccard_join.gathered(found, each, *span))
        moved += jaccard_join.signed_rows(rows, 90, 3, 8, shared, each, span).filter("kind = 1").agg({"n": "sum"}).first()[0]
    assert times[times > 1].sum() <= moved < len(sig) / 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 103), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 105: 100, 103: 100}


def test_quality_fm(spark, docs, empty):
    rng = random.Random(4)
    rows = [(i, " ".join((rng.choice("abcdefgh") * 5 + ("###" if i % 3 == 0 else "")) for _ in range(60)), i % 3 != 0) for i in range(400)]
    table = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(q)) for i, _, q in rows] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    got = by_id(quality_fm.score(table, quality_fm.fit(table, labels, ~held_out("doc_id", 5, 0))))
    assert np.mean([(got[i].score >= 0.3) == q for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]) > 0.95
    odd = quality_fm.score(docs, quality_fm.fit(docs, labels.limit(0), F.lit(True))).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    assert quality_fm.score(empty, quality_fm.Machine()).count() == 0


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    m = quality_fm.Machine()
    index, value = np.array([3, 9, 200, 9000], np.int32), rng.random(4).astype(np.float32)
    slow = m.bias + (m.w[index] * value).sum() + sum(float(m.v[i] @ m.v[j]) * value[a] * value[b] for a, i in enumerate(index) for b, j in enumerate(index) if a < b)
    assert m.raw(index, value, np.array([0, 4]))[0][0] == pytest.approx(slow, abs=1e-5)


def test_packing(docs, empty):
    got = packing.pack(docs, vocabulary(BYTE_BPE), length=128).collect()
    tok = load(vocabulary(BYTE_BPE))
    ids = {t: np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4") for t in {r[1] or "" for r in ROWS}}
    texts = {}
    for r in ROWS:
        texts.setdefault(r[0], set()).add(r[1] or "")
    sizes, places = Counter(), Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sizes[r.sequence_id] and r.length > 0
        sizes[r.sequence_id] += r.length
        places[r.doc_id] += r.length
        assert any(r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(x[r.start : r.start + r.length].tobytes()) for x in (ids[t] for t in texts[r.doc_id]))
    assert all(n <= 128 and n & (n - 1) == 0 for n in sizes.values())
    expected = Counter()
    for r in ROWS:
        expected[r[0]] += len(ids[r[1] or ""])
    assert places == expected
    assert packing.pack(empty, vocabulary(BYTE_BPE)).count() == 0


def test_word_codes_are_the_words_own():
    flat, _ = split_words(pa.array(["b a", "a b c\u00e9 a", None, "cc c", "x" * 5000 + " a"]), lower=True)
    words, codes = flat.to_pylist(), packing.word_codes(flat).tolist()
    assert len({*zip(words, codes, strict=True)}) == len(set(words)) == len(set(codes))
    assert packing.word_codes(flat.slice(2)).tolist() == codes[2:]


def test_positions_do_not_depend_on_length():
    rng = random.Random(1)
    make = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    spread = [packing.positions(pa.array([make(n) for _ in range(300)])).std() for n in (20, 2000)]
    assert 0.8 < spread[0] / spread[1] < 1.25


def test_word_codes_need_no_memory_of_the_whole_text(monkeypatch):
    import tracemalloc

    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh\u00e9", k=rng.randint(1, 12))) for _ in range(200_000)]
    flat, _ = split_words(pa.array([" ".join(words), "", "x" * 300_000]))
    tracemalloc.start()
    codes = packing.word_codes(flat)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20  # some 80 bytes for each of 1.7 million before
    monkeypatch.setattr(packing, "CODED_BYTES", 1)  # one word at a time
    assert packing.word_codes(flat.slice(0, 2000)).tolist() == codes[:2000].tolist()
    monkeypatch.setattr(packing, "CODED_BYTES", 1 << 30)  # all at once
    assert packing.word_codes(flat).tolist() == codes.tolist()


def test_hilbert_key_is_a_curve():
    cells = np.array([(x, y) for x in range(8) for y in range(8)])
    order = cells[np.argsort(packing.hilbert_key(cells, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()
    cube = np.array([(x, y, z) for x in range(4) for y in range(4) for z in range(4)])
    keys = packing.hilbert_key(cube, 2)
    assert sorted(keys.tolist()) == list(range(64)) and (np.abs(np.diff(cube[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()
