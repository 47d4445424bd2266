"""The queries of this subpackage: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm import decontaminate, jaccard_join, language_id, lm_scoring, packing, quality_fm, quality_rules, secrets, substring_dedup, token_counts
from blockloom.llm.common import held_out, table

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = lm_scoring.score(docs, ~held_out("doc_id", 10, 0))
    return out.select("doc_id", held_out("doc_id", 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove(table(spark, sf_dir, "documents"), k=35).drop("kept")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, ~held_out("doc_id", 4, 2))
    return language_id.predict(docs, model, "doc_id").select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "lang_cover")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.summary(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE), limit=2048)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), percent=90, shingle=3).select("doc_id", "n_shingles", "component_id")


def op9_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_fm.fit(docs, labels, ~held_out("doc_id", 5, 0))
    return quality_fm.score(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), length=1024)


def lm_scoring_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op1 that don't depend on the model, which is not made for them."""
    out = lm_scoring.base(table(spark, sf_dir, "documents"), ~held_out("doc_id", 10, 0))
    return out.select("doc_id", held_out("doc_id", 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def quality_rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def token_counts_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_token_counts(spark, sf_dir).select("doc_id", "n_bytes", (F.col("over_limit") == (F.col("n_tokens") > 2048)).alias("consistent"))


def secret_scan_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_scoring, op2_substring_dedup, op3_language_id, op4_quality_rules, op5_decontamination, op6_token_counts, op7_secret_scan, op8_jaccard_join, op9_quality_fm, op10_packing, lm_scoring_base, quality_rules_base, token_counts_base, secret_scan_base)
}
_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
#: crc32 of the id's digits: each byte is folded in, and then eight steps of the reversed polynomial are taken.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
        lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
ORACLE: dict[str, str] = {
    "lm_scoring_base": f"""
        WITH d AS (SELECT doc_id, coalesce({_CRC} % 10 = 0, false) AS held_out, list_append(list_transform({_WORDS}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')), ' ') AS w FROM documents),
        t AS (SELECT doc_id, held_out, unnest(w) AS x FROM d), c AS (SELECT x, count(*) AS c FROM t WHERE NOT held_out GROUP BY x), s AS (SELECT sum(c) AS n, count(*) AS v FROM c)
        SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n)::BIGINT AS train_tokens, round(sum(log10((coalesce(c, 0) + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1)))), 4) AS base_score
        FROM t LEFT JOIN c USING (x), s GROUP BY doc_id, held_out""",
    "quality_rules_base": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
        g AS (SELECT doc_id, s, array_to_string(list_slice(w, s + 1, s + 5), ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS s FROM d WHERE len(w) > 4)),
        r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + 5)) AS p FROM g JOIN (SELECT doc_id, g FROM g GROUP BY ALL HAVING count(*) > 1) USING (doc_id, g)) GROUP BY doc_id),
        l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
        o AS (SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
            FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id))
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM o""",
    "token_counts_base": "SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes, true AS consistent FROM documents",
    "secret_scan_base": """
        SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: len(x) >= 6))::BIGINT AS n_assign,
            len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: len(x) >= 20))::BIGINT AS n_access, len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: len(x) >= 24))::BIGINT AS n_hex FROM documents""",
    "op2_substring_dedup": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, s, md5(array_to_string(list_slice(w, s + 1, s + 35), ' ')) AS h FROM (SELECT doc_id, w, unnest(range(0, len(w) - 34)) AS s FROM d WHERE len(w) >= 35)),
        again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM win JOIN again USING (h)),
        word AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op5_decontamination": f"""
        WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
        b AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, list_slice(w, s + 1, s + 10) AS t FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
        size AS (SELECT DISTINCT len(t) AS n FROM win),
        pl AS (SELECT doc_id, n, s, list_slice(w, s + 1, s + n) AS t FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, size WHERE len(w) >= n)),
        hit AS (SELECT doc_id, s, n, item_id FROM pl JOIN win USING (t)),
        place AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
        item AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN place USING (doc_id) LEFT JOIN item USING (doc_id)""",
    "op8_jaccard_join": """
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s + 1, s + 3), ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 2, 1))) AS s FROM d WHERE len(w) > 0)),
        size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (SELECT x, y FROM both_ JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * i >= 90 * (p.n + q.n - i)),
        reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y)
        SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(y) AS component_id FROM d LEFT JOIN size USING (doc_id) JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id""",
}
