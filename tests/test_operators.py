import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockloom import config
from blockloom.config import ParserOptions, VectorOptions
from blockloom.functions import text as T
from blockloom.operators import augment, embed, folds, requests, store, tags
from blockloom.plans import catalog, pipeline
from blockloom.sources.files import read_directory, read_files
from blockloom.streaming.ingest import watch


def one(spark, value, use, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(use(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("#a/b", ("a", "b", "#a/b")), ("#x", ("topic", "x", "#x")), ("#?p/q", ("seed", "p/q", "#seed/p/q")), ("#temp", None), ("#ignore/z", None), ("#temp2", ("topic", "temp2", "#temp2")), ("#a/", ("a", "", "#a/")), ("#/x", ("", "x", "#/x")), ("#?", ("seed", "", "#seed/")), ("x", None)],
)
def test_tags(spark, text, expected):
    got = one(spark, text, lambda c: tags.parse_tag(c, ParserOptions(exclude=("#ignore/.*", "#temp$"))))
    assert (tuple(got) if got else None) == expected


@pytest.mark.parametrize(("text", "n"), [("中文abcd", 3), ("", 1), ("abc", 1), ("x" * 400, 100)])
def test_token_estimate(spark, text, n):
    assert one(spark, text, T.token_estimate) == n


def test_strip_is_unicode(spark):
    assert one(spark, "　\x1c a  \n", T.strip) == "a"


def test_generic_chunks(spark):
    assert one(spark, "aaaa bbbb cccc", lambda c: folds.generic_chunks(c, 10)) == ["aaaa bbbb", "cccc"]
    assert one(spark, "short", lambda c: folds.generic_chunks(c, 10)) == ["short"]
    assert one(spark, "", lambda c: folds.generic_chunks(c, 10)) == [""]


def test_request_ids(spark):
    assert one(spark, [300, 300, 600, 10, 10], lambda c: folds.request_ids(c, 16, 512), "array<int>") == [0, 1, 2, 3, 3]
    assert one(spark, [1] * 5, lambda c: folds.request_ids(c, 2, 512), "array<int>") == [0, 0, 1, 1, 2]
    assert one(spark, [], lambda c: folds.request_ids(c, 2, 512), "array<int>") == []


def test_augmented_text_and_metadata(spark):
    parsed = pipeline.parse(spark.createDataFrame([("f", "#a/1\n#a/2\n# H\ntext\n```\nc\n```\n")], "file_path string, text string"))
    rows = {r.protected_element_type: r for r in augment.with_text(parsed).collect()}
    assert rows[None].augmented_text == "a: 1 a: 2 file_path: f title: H # H\ntext"
    assert rows["code"].augmented_text == rows["code"].content
    meta = {r.protected_element_type: r for r in augment.metadata(parsed).collect()}
    assert meta[""].tag_map == {"tag_a": "2", "tag_file_path": "f", "tag_title": "H"}


def test_limiter():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s, 3))
        now[0] += s

    lim = embed.Limiter(2, 1000, delay=0.5, clock=lambda: now[0], sleep=sleep)
    assert [round(lim.wait(10), 3) for _ in range(3)][0] == 0.45
    assert slept[2] > 58  # the third request of the minute waits for the first to leave
    tokens = embed.Limiter(100, 100, adaptive=False, delay=0.0, clock=lambda: now[0], sleep=sleep)
    tokens.wait(90)
    assert tokens.wait(20) == pytest.approx(60, abs=0.01)


def test_failures_are_status(spark, tmp_path):
    class Broken:  # local, so that workers get it by value
        def embed(self, texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("no")
            return [[1.0, 0.0]] * len(texts)

    docs = spark.createDataFrame([("a", "# A\ngood\n"), ("b", "# B\nbad\n")], "file_path string, text string")
    options = VectorOptions(dimension=2, store_dir=str(tmp_path), retries=1)
    parsed = pipeline.parse(docs)
    saved = pipeline.save(spark, parsed, options, factory=Broken, limited=False)
    done = saved.summary.first()
    assert (done.success, done.failure, done.wait_seconds, len(done.failed_ids)) == (1, 1, 0.0, 1)
    assert [r.error for r in saved.failed.collect()] == ["no"]
    again = pipeline.save(spark, parsed, options, factory=Broken, limited=False)
    assert (again.summary.first().success, again.summary.first().failure) == (1, 1)
    again.discard()
    assert not os.path.exists(again.folder) and os.path.exists(saved.folder)
    assert pipeline.stats(spark, options).first().record_count == 1
    wrong = pipeline.save(spark, parsed, VectorOptions(dimension=3, store_dir=str(tmp_path / "x"), retries=1), factory=Broken, limited=False).summary.first()
    assert wrong.success == 0


def test_one_call_a_request_all_failed_ids_and_the_wait(spark, tmp_path):
    calls = str(tmp_path / "calls")

    class Counting:
        def embed(self, texts):
            with open(calls, "a") as f:
                f.write("x\n")
            raise RuntimeError("down")

    docs = spark.createDataFrame([("f", "".join(f"# h{i}\nword {i}\n" for i in range(30)))], "file_path string, text string")
    options = VectorOptions(dimension=2, store_dir=str(tmp_path / "s"), retries=1, delay=0.01, delay_bounds=(0.01, 0.01), request_texts=16)
    saved = pipeline.save(spark, pipeline.parse(docs), options, factory=Counting)
    done = saved.summary.first()
    assert (done.success, done.failure, len(done.failed_ids)) == (0, 30, 10) and saved.failed.count() == 30
    with open(calls) as f:
        assert len(f.readlines()) == 2  # 16 texts and 14
    assert done.wait_seconds == pytest.approx(0.02)


def test_preview(spark):
    docs = spark.createDataFrame([("b", "# B\nx\n"), ("a", "# A\n" + "long " * 60 + "\n\n## C\ny\n")], "file_path string, text string")
    rows = pipeline.preview(pipeline.parse(docs)).collect()
    assert [r.content[:3] for r in rows] == ["# A", "## "] and len(rows[0].content) == 103 and rows[0].content.endswith("...") and len(rows[0].augmented_text) == 153
    assert rows[1].augmented_text == "file_path: a title: A/C ## C\ny" and rows[1].n_tags == 2


def test_search(spark):
    table = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 1.0])], "block_id string, embedding array<float>")
    asked = spark.createDataFrame([(1, [1.0, 0.1])], "query_id int, query array<float>")
    assert [r.id for r in store.cosine_topk(table, asked, 2).orderBy("rank").collect()] == ["a", "c"]


def test_cosine_in_blocks_of_queries(spark):
    rows = [(i, [float((i * 7) % 11), float((i * 3) % 5), 1.0]) for i in range(40)]
    table = spark.createDataFrame(rows, "block_id int, embedding array<float>")
    asked = table.selectExpr("block_id as query_id", "embedding as query")
    found = lambda **more: sorted(tuple(r) for r in store.cosine_topk(table, asked, 3, **more).collect())
    assert len(found()) == 120 and found(limit=7) == found()


def test_cosine_by_matrices_is_the_exact_order(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.integers(-3, 4, (300, 6)).astype(float).tolist() + [[1.0, 2.0, 3.0, 0.0, 0.0, 1.0]] * 40 + [[0.0] * 6, None, [1.0, 2.0], [float("nan")] * 6, [None, 1.0, 1.0, 1.0, 1.0, 1.0], []]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "block_id bigint, embedding array<float>").repartition(3)
    asked = table.filter("block_id % 7 = 0 or block_id > 338").selectExpr("block_id as query_id", "embedding as query")
    rows = table.selectExpr("block_id as id", "embedding as v")
    every = store._by_expressions(rows, asked).selectExpr("query_id", "id", "score", "row_number() over (partition by query_id order by score desc, id) as rank").filter("rank <= 5")
    got = store.cosine_topk(table, asked, 5)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, every.collect()))
    usual = store.cosine_topk(table.filter("block_id < 340"), asked.filter("query_id < 340"), 5)
    assert "NestedLoop" not in usual._jdf.queryExecution().toString() and "MapInArrow" in usual._jdf.queryExecution().toString()


def test_embed_status_embeds_the_text_of_turns(spark, tmp_path, monkeypatch):
    turns = [(1, 1, "u", "first words"), (1, 2, "a", None), (2, 1, "u", "others")]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    asked, whole = [], embed.embed
    monkeypatch.setattr(embed, "embed", lambda rows, *a, **k: asked.extend(r.text for r in rows.collect()) or whole(rows, *a, **k))
    assert tuple(catalog.embed_status(spark, str(tmp_path)).first()) == (3, 0, 0)
    assert sorted(asked) == ["", "first words", "others"]


def test_encodings_and_directories(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, raw in {"a.md": "﻿# é\n".encode(), "b.markdown": "# é\n".encode("utf-16"), "c.md": "# 中文\n".encode("gbk"), "sub/d.md": b"# \xff\xfe\n", "g.md": b"\xff\xfe\x00\xd8x", "E.MD": b"x", "f.txt": b"x"}.items():
        (tmp_path / name).write_bytes(raw)
    found = {os.path.basename(r.file_path): r.text for r in read_directory(spark, str(tmp_path)).collect()}
    assert found == {"a.md": "# é\n", "b.markdown": "# é\n", "c.md": "# 中文\n", "d.md": b"# \xff\xfe\n".decode("latin-1"), "g.md": b"\xff\xfe\x00\xd8x".decode("latin-1")}
    some = read_files(spark, str(tmp_path / "f.txt"), str(tmp_path / "f.txt"), str(tmp_path / "missing.md"))
    assert [r.text for r in some.collect()] == ["x"]
    assert read_files(spark).count() == read_directory(spark, str(tmp_path / "none")).count() == 0


def test_json_sinks(spark, tmp_path):
    parsed = pipeline.parse(spark.createDataFrame([("f", "# Ä\nx\n")], "file_path string, text string"))
    with open(pipeline.write_json_array(parsed, str(tmp_path / "one")), encoding="utf-8") as f:
        rows = json.load(f)
    assert rows[0]["content"] == "# Ä\nx" and rows[0]["protected_element_type"] is None
    pipeline.write_json(parsed, str(tmp_path / "many"))
    assert spark.read.json(str(tmp_path / "many")).count() == 1


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("# A\nx\n")
    seen = []
    watch(spark, str(tmp_path / "in"), lambda b, n: seen.extend(r.content for r in b.collect()), str(tmp_path / "cp"), once=True).awaitTermination(120)
    (tmp_path / "in" / "b.md").write_text("# B\ny\n")
    watch(spark, str(tmp_path / "in"), lambda b, n: seen.extend(r.content for r in b.collect()), str(tmp_path / "cp"), once=True).awaitTermination(120)
    assert seen == ["# A\nx", "# B\ny"]


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("""
parser: {chunk_strategy: {max_chars: 9}, file_extensions: [".md"]}
tags: {exclude_regex: ["^#a"]}
vector_store:
  dimension: 8
  batch_size: 4
  embedding:
    api_base: "http://service"
    model: "m"
    api_key: "k"
    rate_limit: {rpm: 7, tpm: 70, enable_adaptive_delay: false, request_delay: 0.1}
  chromadb: {persist_directory: "./v", collection_name: "mine"}
""")
    parser, vector = config.load(str(tmp_path / "c.yaml"))
    assert (parser.max_chars, parser.exclude, parser.extensions) == (9, ("^#a",), (".md",))
    assert (vector.dimension, vector.batch_size, vector.request_texts, vector.rpm, vector.tpm, vector.adaptive, vector.delay) == (8, 4, 4, 7, 70, False, 0.1)
    assert (vector.api_base, vector.model, vector.api_key, vector.store_dir, vector.collection) == ("http://service", "m", "k", "./v", "mine")
    assert config.from_mapping({}) == (ParserOptions(), VectorOptions())


def test_outer_batches(spark):
    rows = spark.createDataFrame([("f", i, str(i), 1) for i in range(1, 6)], "file_path string, block_seq int, block_id string, tokens int")
    assert [r.batch for r in requests.outer_batches(rows, 2).orderBy("block_seq").collect()] == [0, 0, 1, 1, 2]
