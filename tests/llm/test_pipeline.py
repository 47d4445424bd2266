"""The pipeline's stages on planted rows, and the registered queries against SQL."""

import os
import random

import duckdb
import pytest

import corpus_pipeline
from blockloom.llm.common import store
from blockloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
HERE = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bench = [text(30) for _ in range(5)]
    clean = [text(rng.randint(60, 200)) for _ in range(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean)]
    near = clean[0].split()
    near[-1] = "altered"
    odd = [(100, "123 456 789 000", "en"), (101, clean[1], "en"), (102, " ".join(near), "en"), (103, text(50) + " " + bench[2] + " " + text(50), "en"), (104, text(80) + ' password = "hunter2hunter2" ' + text(80), "en"), (105, None, "en")]
    rows += [(i, t, lang, "s", 0 if t is None else len(t)) for i, t, lang in odd]
    at = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(bench)], "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_stages(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    gone, text = {}, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        out = store(stage(spark, docs, planted), name)
        assert out.dtypes == docs.dtypes
        docs, text = out, {r.doc_id: r for r in out.collect()}
        gone[name] = before - set(text)
    assert gone == {"language_id": {100, 105}, "jaccard_join": {101, 102}, "decontamination": {103}, "secret_scan": set()}
    assert "hunter2" not in text[104].text and "[SECRET]" in text[104].text and text[104].n_chars == len(text[104].text)
    pieces = corpus_pipeline.run(spark, planted).collect()
    assert {r.doc_id for r in pieces} == set(text)


def test_near_copies_go_without_moving_texts(spark, planted, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the table of keys were large
    try:
        docs = spark.read.parquet(f"{planted}/documents.parquet")
        out = corpus_pipeline.drop_near_copies(spark, docs, planted)
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(corpus_pipeline, "MOST_KEYS", -1)
        moved = corpus_pipeline.drop_near_copies(spark, docs, planted)
        assert "SortMergeJoin" in moved._jdf.queryExecution().executedPlan().toString()
        ids = sorted(r.doc_id for r in out.collect())
        assert ids == sorted(r.doc_id for r in moved.collect()) and not {101, 102} & set(ids) and len(ids) == 44
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_share_an_id_or_have_none(spark, tmp_path):
    """Copies and contaminated rows go by row: others with their doc_id, or without one, stay."""
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{rng.randrange(10**5)}" for _ in range(n))
    bench = text(30)
    spark.createDataFrame([(1, bench)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(i, text(80)) for i in (None, None, None, 5, 5, 6, 9)]
    near = clean[5][1].rsplit(" ", 1)[0] + " altered"  # of the text of document 6
    rows = [*clean, (None, near), (9, near), clean[0], (None, clean[4][1]), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS).repartition(3)
    kept = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    order = lambda rows: sorted(rows, key=repr)
    assert order((r.doc_id, r.text) for r in kept.collect()) == order([*clean, (None, None), (None, None)])
    dirty = [(None, text(20) + " " + bench), (5, bench + " " + text(20))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in clean + dirty], COLUMNS).repartition(3)
    assert order((r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()) == order(clean)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@HERE
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rows = lambda f: sorted(repr(tuple(str(x) for x in r)) for r in f[sorted(f)].itertuples(index=False))
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.sql(ORACLE[name]).df())


@HERE
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()} == docs
