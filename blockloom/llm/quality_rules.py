"""Quality rules as weak supervision, with DataFrame functions only.

Every rule votes good (1), bad (-1) or abstains (0) on a document's statistics. Expectation-maximisation over the table
of vote patterns (at most 3**rules rows, whatever the input) estimates how accurate each rule's votes are on good and on bad
documents, and the posterior probability of "good" replaces the test that all rules pass. A rule that abstains says nothing;
votes for "good" count as votes do, so a single weak bad vote can be outvoted. Accuracies start from, and are pulled to, a
prior that 97 of 100 votes on good documents say so, and three of ten on bad ones; the prior weighs as much as
`PULL` of the documents, at every size.

Words are runs of anything but U+0020 and U+0009..U+000D. A null or empty text has no words and fails the base test.
Repeated rows get a row each; documents with the same votes have the same posterior, and one of exactly the threshold is
kept; an empty table gives no rows; other columns are ignored. Texts of any length are handled whole: repeated 5-word
windows are found by sorting a document's window hashes inside its own row, so nothing is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import store

WORD = r"[^\x20\x09-\x0D]+"
GRAM = 5


def let(value: Column, use) -> Column:
    """use(value) with value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more."""

    def covered(at: Column) -> Column:
        last = F.size(at) - 1
        return F.aggregate(F.sequence(F.lit(0), last), F.lit(0).cast("long"), lambda n, j: n + F.when(j == last, GRAM).otherwise(F.least(F.lit(GRAM), F.get(at, j + 1) - F.get(at, j))).cast("long"))

    def shared(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        at = lambda s, i, x: F.coalesce(F.get(s, i)["g"] == x["g"], F.lit(False))
        again = lambda s: F.filter(F.transform(s, lambda x, i: F.when(at(s, i - 1, x) | at(s, i + 1, x), x["i"])), lambda x: x.isNotNull())
        return let(F.array_sort(let(ordered, again)), covered)

    grams = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - GRAM), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(GRAM))))
    count = lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(shared(g))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= GRAM, F.lit(0).cast("long")).otherwise(let(hashes, lambda h: let(grams(h), count)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the document's counts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t")).select("doc_id", "t", F.regexp_extract_all("t", F.lit(WORD), 0).alias("words"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"), F.size(x).cast("long").alias("n"))).alias("lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count("t", F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count("t", F.lit("[.!?]")).cast("long").alias("n_stops"),
        F.size(F.filter("words", lambda w: w.rlike(r"[A-Za-z\x{80}-\x{10FFFF}]"))).cast("long").alias("n_lettered"),
    ).withColumns({"n_dup_lines": F.col("lines.dup"), "n_lines": F.col("lines.n")}).drop("lines")


def _vote(bad: Column, good: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), -1).when(F.coalesce(good, F.lit(False)), 1).otherwise(0).cast("int")


def votes() -> dict[str, Column]:
    """The rules' votes on a row of statistics()."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "v_length": _vote(n < 10, n >= 40),
        "v_word_length": _vote((chars < 2.5 * n) | (chars > 14 * n), (chars >= 3 * n) & (chars <= 10 * n)),
        "v_symbols": _vote(100 * F.col("n_symbols") > 20 * n, 100 * F.col("n_symbols") <= 5 * n),
        "v_marks": _vote(100 * F.col("n_symbols") > 3 * chars, 100 * F.col("n_symbols") <= chars),
        "v_lettered": _vote(100 * F.col("n_lettered") < 60 * n, 100 * F.col("n_lettered") >= 95 * n),
        "v_lines": _vote(100 * F.col("n_dup_lines") > 30 * F.col("n_lines"), (F.col("n_lines") >= 3) & (F.col("n_dup_lines") == 0)),
        "v_repeats": _vote(100 * F.col("n_repeat_words") > 20 * n, 100 * F.col("n_repeat_words") <= 5 * n),
        "v_capitals": _vote(100 * F.col("n_capitals") > 40 * chars, 100 * F.col("n_capitals") <= 12 * chars),
        "v_stops": _vote((n >= 40) & ((F.col("n_stops") == 0) | (100 * F.col("n_stops") > 50 * n)), (100 * F.col("n_stops") >= n) & (100 * F.col("n_stops") <= 30 * n)),
        "v_digits": _vote(100 * F.col("n_digits") > 25 * chars, 100 * F.col("n_digits") <= 6 * chars),
    }


#: Share of good documents and rates of bad votes, among bad and good documents, that the estimates start from; how many
#: documents (as a share of all) the prior counts for.
GOOD, BAD_VOTES, PULL = 0.8, (0.3, 0.03), 0.1


def log_odds(prior: Column, vote, rate, rules: int) -> Column:
    """Log odds of "good": vote(j) is -1, 0 or 1, rate(j, y) the share of bad ones among rule j's votes on class y."""
    def add(a: Column, j: Column) -> Column:
        bad, good = rate(j, 0), rate(j, 1)
        return a + F.when(vote(j) == -1, F.log(good / bad)).when(vote(j) == 1, F.log((1 - good) / (1 - bad))).otherwise(0.0)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rules - 1)), F.log(prior / (1 - prior)), add)


def posterior(rates: dict[tuple[str, int], float], prior: float, names: list[str]) -> Column:
    """P(good | votes); rates: (rule, class) -> share of bad ones among its votes there. Abstentions don't count."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for j in names:
        bad, good = rates[j, 0], rates[j, 1]
        odds = odds + F.when(F.col(j) == -1, math.log(good / bad)).when(F.col(j) == 1, math.log((1 - good) / (1 - bad))).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit(voted: DataFrame, names: list[str], rounds: int = 30) -> tuple[dict[tuple[str, int], float], float]:
    """EM over the vote patterns: for each rule and class the share of bad ones among its votes, and the share of good documents.

    The patterns (3**rules at most) are one array in one row, and the rounds one fold over it. The state is the share of
    good documents and an array of rates, rule by rule, bad class before good.
    """
    rules = len(names)
    state = F.struct(F.lit(GOOD).alias("prior"), F.array(*(F.lit(p) for _ in names for p in BAD_VOTES)).alias("r"))
    pattern = F.struct(F.col("n").cast("double").alias("n"), F.array(*names).alias("v"))
    one = voted.groupBy(*names).agg(F.count("*").alias("n")).agg(F.collect_list(pattern).alias("seen"))
    zero = F.lit(0.0)

    def good(p: Column, s: Column) -> Column:
        return 1 / (1 + F.exp(-log_odds(s["prior"], lambda j: F.get(p["v"], j), lambda j, y: F.get(s["r"], j * 2 + y), rules)))

    def again(w: Column) -> Column:
        total = lambda of: F.aggregate(w, zero, lambda a, x: a + of(x))

        def rate(t: Column, k: Column) -> Column:
            j, y = F.floor(k / 2).cast("int"), k % 2
            mine = lambda x: F.when(y == 1, x["g"]).otherwise(x["b"])
            bad = total(lambda x: F.when(F.get(x["v"], j) == -1, mine(x)).otherwise(zero))
            cast = total(lambda x: F.when(F.get(x["v"], j) != 0, mine(x)).otherwise(zero))
            pull = PULL * (t["g"] + t["b"]) + 1
            return (bad + pull * F.when(y == 1, BAD_VOTES[1]).otherwise(BAD_VOTES[0])) / (cast + pull)

        prior = lambda t: (t["g"] + GOOD * (PULL * (t["g"] + t["b"]) + 1)) / ((1 + PULL) * (t["g"] + t["b"]) + 1)
        return let(F.struct(total(lambda x: x["g"]).alias("g"), total(lambda x: x["b"]).alias("b")), lambda t: F.struct(prior(t).alias("prior"), F.transform(F.sequence(F.lit(0), F.lit(2 * rules - 1)), lambda k: rate(t, k)).alias("r")))

    def step(s: Column, _: Column) -> Column:
        weigh = lambda p: let(good(p, s), lambda q: F.struct(p["v"].alias("v"), (p["n"] * q).alias("g"), (p["n"] * (1 - q)).alias("b")))
        return let(F.transform("seen", weigh), again)

    out = one.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), state, step).alias("s")).first()["s"]
    return {(j, y): out["r"][2 * i + y] for i, j in enumerate(names) for y in (0, 1)}, out["prior"]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 30, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, every rule's vote, quality (posterior) and kept, for every row."""
    rules = votes()
    voted = store(statistics(docs, id_col, text_col), "quality-statistics").withColumns(rules)
    names = list(rules)
    rates, prior = fit(voted, names, rounds)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return voted.withColumns({"base_failed": failed, "quality": posterior(rates, prior, names)}).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("quality") >= threshold)).alias("kept"), "quality", *names
    )
