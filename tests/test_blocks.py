"""Blocks: the sample document's known result, and hand-made cases."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from blockloom.config import ParserOptions
from blockloom.functions import text as T
from blockloom.operators import folds
from blockloom.operators.blocks import blocks
from blockloom.plans import catalog
from blockloom.plans.pipeline import parse

SAMPLE = """#project/demo
Lead text of the sample.

## First part
#?topic/one
The first part has a line.
It has a second line that is rather longer than the one before it.
A third line.

### Detail
#depth
A detail under the first part.
```py
code = 1
# a comment
more = 2
```
## Second part
#kind/table
| name | size |
|------|------|
| alpha | 1 |
| beta | 2 |
| gamma | 3 |
| delta | 4 |

Closing words.
"""
#: Worked out by hand at 90 characters: first and last line, split, element, content, tags (the file's apart), title.
FIRST, LONG = "## First part\nThe first part has a line.\n", "It has a second line that is rather longer than the one before it."
RESULT = [
    (2, 2, False, None, "Lead text of the sample.", ["project=demo"], None),
    (4, 7, True, None, FIRST + LONG, ["project=demo", "seed=topic/one"], "null/First part"),
    (7, 8, True, None, LONG + "\nA third line.", ["project=demo", "seed=topic/one"], "null/First part"),
    (10, 12, True, None, "### Detail\nA detail under the first part.", ["project=demo", "seed=topic/one", "topic=depth"], "null/First part/Detail"),
    (13, 14, True, "code", "```py\ncode = 1", ["project=demo", "seed=topic/one", "topic=depth"], "null/First part/Detail"),
    (13, 17, True, "code", "```py\ncode = 1\nmore = 2\n```", ["project=demo"], "a comment"),
    (20, 25, True, "table", "| name | size |\n|------|------|\n| alpha | 1 |\n| beta | 2 |\n| gamma | 3 |\n| delta | 4 |", ["project=demo", "kind=table"], "a comment/Second part"),
    (27, 27, True, None, "Closing words.", ["project=demo", "kind=table"], "a comment/Second part"),
]


def run(spark, text, limit=450, **options):
    docs = spark.createDataFrame([("f", text)], "file_path string, text string")
    return [
        (r.start_line, r.end_line, r.content, r.is_splited, r.protected_element_type, [(t.key, t.value) for t in r.tags if t.key != "file_path"])
        for r in blocks(docs, ParserOptions(max_chars=limit, **options)).orderBy("block_seq").collect()
    ]


@pytest.mark.parametrize("partitions", [1, 5])
def test_sample(spark, partitions):
    docs = spark.createDataFrame([("s.md", SAMPLE), ("other.md", "x")], "file_path string, text string").repartition(partitions)
    found = blocks(docs, ParserOptions(max_chars=90)).filter("file_path = 's.md'").orderBy("block_seq").collect()
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    for r, (first, last, split, element, content, own, title) in zip(found, RESULT, strict=True):
        base = 0 if element else 1  # ids of text count lines from 0, those of protected elements from 1
        expected = [*own, "file_path=s.md", *([f"title={title}"] if title else [])]
        assert (r.start_line, r.end_line, r.is_splited, r.protected_element_type, r.content, [f"{t.key}={t.value}" for t in r.tags]) == (first, last, split, element, content, expected)
        assert r.block_id == md5(f"s.md_{first - base}_{last - base}_{md5(content)[:16]}") and r.protected_element_overlength is False


CODE, TABLE = "code", "table"
CASES = [
    ("# A\nt\n### C\nu\n## B\nv\n", 450, [(1, 2, "# A\nt", False, None, [("title", "A")]), (3, 4, "### C\nu", False, None, [("title", "A/null/C")]), (5, 6, "## B\nv", False, None, [("title", "A/B")])]),
    ("# A\n\n## B\ntext\n", 450, [(3, 4, "## B\ntext", False, None, [("title", "A/B")])]),
    ("intro\n```\nx=1\n```\nend\n", 450, [(1, 1, "intro", True, None, []), (2, 4, "```\nx=1\n```", True, CODE, []), (5, 5, "end", True, None, [])]),
    ("# T\n```\na\n# c\nb\n```\nend\n", 450, [(2, 3, "```\na", True, CODE, [("title", "T")]), (2, 6, "```\na\nb\n```", True, CODE, [("title", "c")]), (4, 7, "# c\nend", True, None, [("title", "c")])]),
    ("```\na\n| x |\nb\n```\nc\n", 450, [(3, 3, "| x |", True, TABLE, []), (4, 4, "b", True, None, []), (5, 6, "```\nc", True, CODE, [])]),
    ("| h |\n|---|\n| 1 |", 450, [(1, 3, "| h |\n|---|\n| 1 |", False, TABLE, [])]),
    ("aaaa\nbbbb\ncccc\n", 10, [(1, 3, "aaaa\nbbbb\ncccc", True, None, []), (3, 3, "cccc", True, None, [])]),
    ("aa\nxxxxxxxxxxxxxxx\nbb\n", 10, [(1, 2, "aa\nxxxxxxxxxxxxxxx", True, None, []), (2, 2, "xxxxxxxxxxxxxxx", True, None, []), (3, 3, "bb", True, None, [])]),
    ("\nxxxxxxxxxxxxxxx\n", 10, [(2, 2, "xxxxxxxxxxxxxxx", True, None, [])]),
    ("aaaaaa\nbbbbbb\n#k/v\ncc\n", 10, [(1, 2, "aaaaaa\nbbbbbb", True, None, []), (2, 4, "bbbbbb\ncc", True, None, [("k", "v")])]),
    ("|h|\n|-|\n|aaaa|\n|aaaa|\n|aaaa|\n\n", 20, [(1, 2, "|h|\n|-|\n|aaaa|", True, TABLE, []), (2, 3, "|h|\n|-|\n|aaaa|", True, TABLE, []), (3, 5, "|h|\n|-|\n|aaaa|", True, TABLE, [])]),
    ("```\naaaa\nbbbb\n```\n", 10, [(1, 1, "```\naaaa", True, CODE, []), (2, 4, "bbbb\n```", True, CODE, [])]),
    ("| a |\n#k\n| b |\n\n", 450, [(1, 1, "| a |", True, TABLE, []), (3, 3, "| b |", True, TABLE, [("topic", "k")])]),
    ("# A\r\nx\r\n", 450, [(1, 2, "# A\nx", False, None, [("title", "A")])]),
    ("　# 标题\nx\n", 450, [(1, 2, "# 标题\nx", False, None, [("title", "标题")])]),
    ("#\tx\n", 450, [(1, 1, "#\tx", False, None, [("title", "x")])]),
    ("a\n```\nb\n", 450, [(2, 3, "```\nb", True, CODE, []), (1, 1, "a", True, None, [])][::-1]),
    ("", 450, []), ("\n \n", 450, []),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_case(spark, case):
    text, limit, expected = CASES[case]
    assert run(spark, text, limit) == expected


def test_strict_mode_protects_code(spark):
    assert run(spark, "# T\n```\n# c\n#x\n| t |\n```\nend\n", mode="strict") == [(2, 6, "```\n# c\n#x\n| t |\n```", True, "code", [("title", "T")]), (7, 7, "end", True, None, [("title", "T")])]


def test_excluded_tags_leave_the_content(spark):
    assert run(spark, "#temp\n#a/b\n#?p/q\nx\n", exclude=("#temp$",)) == [(4, 4, "x", False, None, [("a", "b"), ("seed", "p/q")])]


def test_ids_order_and_partition_invariance(spark):
    rows = [(f"d{i}.md", "\n".join(f"## s{j}\n#k/{j}\n" + "word " * 40 + "\nmore\n| a |\n|-|\n| b |\n\n```\ncode\n```" for j in range(i % 4 + 1))) for i in range(30)] + [("null.md", None)]
    found = []
    for n in (1, 4, 16):
        docs = spark.createDataFrame(rows, "file_path string, text string").repartition(n)
        found.append(sorted(map(str, parse(docs, ParserOptions(max_chars=120)).collect())))
    assert found[0] == found[1] == found[2]
    parsed = parse(spark.createDataFrame(rows, "file_path string, text string"), ParserOptions(max_chars=120))
    ids = [r.block_id for r in parsed.select("block_id").collect()]
    assert len(ids) == len(set(ids))


def test_one_exchange_for_scope(spark):
    docs = spark.createDataFrame([("f", "x")], "file_path string, text string")
    from blockloom.operators.blocks import states

    plan = states(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_documents_are_exchanged_and_not_lines(spark, tmp_path):
    from blockloom import runtime
    from blockloom.operators import rows
    from blockloom.operators.blocks import states

    spark.createDataFrame([(str(i), "# a\nx\n" * 50) for i in range(200)], "file_path string, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plan = states(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange hashpartitioning")  # plans read from the end to the start
    size = runtime.input_bytes(docs)
    assert 1000 < size < 1 << 30 and runtime.input_bytes(spark.createDataFrame([(1,)], "x int")) == 0
    monkey, rows.SPREAD_BYTES = rows.SPREAD_BYTES, size // 50
    try:
        assert rows.spread(docs).rdd.getNumPartitions() >= 50  # grows with the input
    finally:
        rows.SPREAD_BYTES = monkey


def test_partitions_follow_rows_that_take_few_bytes(spark, tmp_path, monkeypatch):
    from blockloom import runtime
    from blockloom.operators import rows

    at = str(tmp_path / "a b" / "docs.parquet")
    spark.range(5000).selectExpr("concat('f', id) AS file_path", "'# a\\nx\\n' AS text").write.parquet(at)
    docs = spark.read.parquet(at)
    assert runtime.input_rows(docs) == 5000 and runtime.input_rows(docs.union(docs)) in (5000, 10000)
    assert runtime.input_rows(spark.createDataFrame([(1,)], "x int")) == 0
    monkeypatch.setattr(rows, "SPREAD_ROWS", 100)
    assert runtime.input_bytes(docs) < rows.SPREAD_BYTES and rows.spread(docs).rdd.getNumPartitions() >= 50
    assert rows.lines(rows.spread(docs)).count() == 10000


def test_one_scan_and_one_exchange_for_blocks(spark, tmp_path):
    spark.createDataFrame([("f", "# a\nx\n| t |\n")], "file_path string, text string").write.parquet(str(tmp_path / "docs"))
    plan = blocks(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1 and "Join" not in plan


def test_tags_of_levels_that_come_again(spark):
    """Tags of a section end with it, those of sections above stay, also where a level is left out or comes again."""
    text = "#top\n# A\n#a/1\n### C\n#c/1\nx\n## B\n#b/1\ny\n#b/2\n# D\nz\n## B\n#?p/q\nw\n"
    top, seed = ("topic", "top"), ("seed", "p/q")
    found = [(content, [t for t in own if t[0] != "title"]) for _, _, content, _, _, own in run(spark, text)]
    assert found == [
        ("### C\nx", [top, ("a", "1"), ("c", "1")]), ("## B\ny", [top, ("a", "1"), ("b", "1"), ("b", "2")]),
        ("# D\nz", [top]), ("## B\nw", [top, seed]),
    ]


def greedy(text, limit):
    """generic_chunks, character by character."""
    if len(text) <= limit:
        return [text]
    out, start = [], 0
    while start < len(text):
        end = min(len(text), start + limit)
        if start + limit < len(text):
            for mark in "\n ":
                at = text.rfind(mark, start, end)
                if at - start > limit * 0.7 and at > start:
                    end = at
                    break
        out.append(text[start:end].strip())
        start = end
    return [p for p in out if p]


def test_generic_chunks_against_brute_force(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choices(["a", "bc", " ", "\n", "\U0001f600", "\u00e9", "\r", "\t"], weights=[8, 8, 3, 1, 1, 1, 0.2, 0.2], k=draw.choice([0, 3, 40, 400]))) for _ in range(120)]
    texts += ["", " " * 50, "\n" * 21, "x" * 20, "x" * 41, "x" * 14 + "\n" + "y" * 30, "x" * 15 + " " + "y" * 3 + " " + "z" * 30]
    for limit in (1, 2, 3, 10, 20):
        frame = spark.createDataFrame([(t,) for t in texts], "text string")
        assert [r.c for r in frame.select(folds.generic_chunks(F.col("text"), limit).alias("c")).collect()] == [greedy(t, limit) for t in texts]


def test_strip_line_is_strip(spark):
    lines = ["", "\n", " ", "a", "a\n", " a b \n", "a \n", "a\t", "\x1ca\n", "a\x85\n", "\u3000x\n", "x\u00a0\n", "é\n", "aé\n", "😀\n", "| a |\n", "a\n\n", "a\r\n", "\x7f\n", "~", "!\n"]
    df = spark.createDataFrame([(x,) for x in lines], "t string").select("t", T.strip("t").alias("a"), T.strip_line(F.col("t")).alias("b"))
    assert [(r.t, r.b) for r in df.collect()] == [(r.t, r.a) for r in df.collect()]


def test_folds_are_computed_once_and_titles_take_one_window(spark):
    plan = lambda name: catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    for name in ("subchunk_line_ranges", "table_chunks", "code_chunks"):
        assert plan(name).count("aggregate(") == 1, name
    assert plan("generic_chunks").count("regexp_extract_all(") == 1
    assert plan("nested_titles").count("Window [") == 1


def test_blocks_are_one_fold_over_runs(spark, tmp_path):
    spark.createDataFrame([("f", "# a\nx\n| t |\n")], "file_path string, text string").write.parquet(str(tmp_path / "docs"))
    plan = blocks(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Aggregate [" not in plan  # the one window numbers blocks


def test_runs_have_the_kinds_of_their_lines(spark):
    from blockloom.operators import rows

    draw = random.Random(3)
    parts = ["# a", "#k/v", "| x |", "|", "| x | ", "|x", "```", "~~~ py", " ```", "a", " a", "", "　# b", "`a`", "## ", "#", "|\x1c|\x1c", "a```"]
    docs = spark.createDataFrame([(str(i), "\n".join(draw.choices(parts, k=draw.choice([0, 1, 5, 40])))) for i in range(60)], "file_path string, text string")
    kind = {"text": rows.PLAIN, "fence": rows.FENCE, "header": rows.HEADER, "tag": rows.TAG, "table": rows.TABLE}
    expected = sorted((r.file_path, r.idx, r.text, kind[r.kind]) for r in rows.classify(rows.lines(docs)).withColumn("kind", rows.kind()).collect())
    found = sorted((r.file_path, run.idx + n, text, run.kind) for r in rows.runs(docs).collect() for run in r.runs for n, text in enumerate(run.texts))
    assert found == expected


def test_state_is_kept_over_many_runs(spark):
    from blockloom.operators.blocks import STEPS

    n = 3 * STEPS
    found = run(spark, "#top\n" + "".join(f"# h{i}\n#k/{i}\nx\n" for i in range(n)))
    assert [(first, own) for first, _, _, _, _, own in found] == [(3 * i + 2, [("topic", "top"), ("k", str(i)), ("title", f"h{i}")]) for i in range(n)]
