"""Markdown documents made from tables, by SQL that Spark and DuckDB both run (schema: file_path, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# `join_list` stands for the engine's ordered concatenation of (position, line) pairs by newlines.
CONVERSATIONS = """
SELECT concat('conv/', cast(conv_id AS {text}), '.md') AS file_path,
       concat('#conv/', cast(conv_id AS {text}), chr(10), {turns}, chr(10)) AS text
FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id"""
TURN = "concat('## turn ', cast(turn AS {text}), chr(10), '#role/', coalesce(role, 'none'), chr(10), coalesce(text, ''))"
ORDERS = """
SELECT concat('order/', cast(o_orderkey AS {text}), '.md') AS file_path,
       concat('# order ', cast(o_orderkey AS {text}), chr(10), '#?status/', max(o_orderstatus), chr(10), '| line | part | quantity |', chr(10), '|---|---|---|', chr(10), {items}, chr(10), chr(10), 'customer ', cast(max(o_custkey) AS {text}), chr(10)) AS text
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey"""
ITEM = "concat('| ', cast(l_linenumber AS {text}), ' | ', cast(l_partkey AS {text}), ' | ', cast(cast(l_quantity AS int) AS {text}), ' |')"
PAGES = """
SELECT concat('page/', cast(page_id AS {text}), '.md') AS file_path,
       concat('# page ', cast(page_id AS {text}), chr(10), '```', chr(10), coalesce(html, ''), chr(10), '```', chr(10), 'end', chr(10)) AS text
FROM pages"""
DOCUMENTS = """
SELECT concat('doc/', cast(doc_id AS {text}), '.md') AS file_path,
       concat('# ', coalesce(source, 'none'), chr(10), '#lang/', coalesce(lang, 'none'), chr(10), coalesce(text, ''), chr(10)) AS text
FROM documents"""
# Headings of three levels, each with a tag, that open and close again; code and a table in the same section.
NESTED = """
SELECT concat('cust/', cast(c_custkey AS {text}), '.md') AS file_path,
       concat('# customer ', cast(c_custkey AS {text}), chr(10), '#segment/', max(c_mktsegment), chr(10), 'about', chr(10), {items}) AS text
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"""
ENTRY = """concat('## status ', o_orderstatus, chr(10), '#state/', o_orderstatus, chr(10), 'between', chr(10), '### order ', cast(o_orderkey AS {text}), chr(10), '#?order/', cast(o_orderkey AS {text}), chr(10),
       '| key |', chr(10), '|---|', chr(10), '| ', cast(o_orderkey AS {text}), ' |', chr(10), '```', chr(10), 'code', chr(10), '```', chr(10), 'after', chr(10))"""
CORPORA = {"nested": NESTED, "conversations": CONVERSATIONS, "orders": ORDERS, "pages": PAGES, "documents": DOCUMENTS}


def corpus_sql(name: str, engine: str) -> str:
    kind = {"text": "string" if engine == "spark" else "varchar"}
    turn, item = TURN.format(**kind), ENTRY.format(**kind) if name == "nested" else ITEM.format(**kind)
    if engine == "spark":
        listed = lambda x, *by: f"array_join(transform(array_sort(collect_list(struct({', '.join(by)}, {x} AS x))), e -> e.x), chr(10))"
    else:
        listed = lambda x, *by: f"string_agg({x}, chr(10) ORDER BY {', '.join(by)}, {x})"
    return CORPORA[name].format(**kind, turns=listed(turn, "turn"), items=listed(item, "o_orderkey") if name == "nested" else listed(item, "l_linenumber"))


def corpus(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for t in {"conversations": ("conversations",), "orders": ("orders", "lineitem"), "pages": ("pages",), "documents": ("documents",), "nested": ("customer", "orders")}[name]:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(corpus_sql(name, "spark"))
