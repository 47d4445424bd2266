"""The vector store: a Parquet table of records, appended to without repeating an id; cosine search over it."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blockloom import runtime

SCHEMA = "block_id string, embedding array<float>, document string, start_line int, end_line int, is_splited boolean, protected_element_type string, protected_element_overlength boolean, tag_map map<string,string>"


class VectorTable:
    """A collection in a directory; metric: cosine."""

    def __init__(self, spark: SparkSession, directory: str, collection: str = "vectors"):
        self.spark, self.path = spark, f"{directory.rstrip('/')}/{collection}"
        p = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def append(self, records: DataFrame) -> None:
        """Add records whose block_id is new; of several with one id, one is added. Rows without a vector are left out."""
        new_records(records, self.read()).write.mode("append").parquet(self.path)

    def count(self) -> int:
        return self.read().count()


def new_records(records: DataFrame, existing: DataFrame) -> DataFrame:
    return records.filter(F.col("embedding").isNotNull()).dropDuplicates(["block_id"]).join(existing.select("block_id"), "block_id", "left_anti")


#: Stored rows that are held against the queries at once, and products in one step.
ROWS, STEP = 4096, 1 << 21


def cosine_topk(table: DataFrame, queries: DataFrame, k: int, id_col: str = "block_id", vec_col: str = "embedding", limit: int = 100_000) -> DataFrame:
    """query_id, id, score, rank: the k most similar rows of each query (query_id, query), ties by id. The queries are
    broadcast in blocks of about `limit` rows, drawn by hash of query_id. Each task multiplies its rows, as matrices, with
    a block's queries; what may be among the k best by that is scored exactly, summed in order of the dimensions, and the task
    keeps each query's k best. Null vectors score 0, vectors of differing length null; these and vectors with null or
    infinite numbers are scored by expressions instead."""
    blocks = max(1, math.ceil(queries.count() / limit))
    own = F.coalesce(F.pmod(F.xxhash64("query_id"), F.lit(blocks)), F.lit(0))
    parts = [queries.filter(own == i) for i in range(blocks)] if blocks > 1 else [queries]
    return functools.reduce(DataFrame.union, (_topk(table, part, k, id_col, vec_col) for part in parts))


def _matrix(vectors: pa.Array, d: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), d)


def _in_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Each row's dot product, summed from the first dimension on."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * y[:, j]
    return out


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt(_in_order(x, x))
    return norm, (x / np.where(norm > 0, norm, 1.0)[:, None]).astype(np.float32)


def _best(query: np.ndarray, key: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best, by score and then by key."""
    order = np.lexsort((key, -score, query))
    first = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - first < k]


def _by_expressions(rows: DataFrame, queries: DataFrame) -> DataFrame:
    dot = F.aggregate(F.zip_with("v", "query", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    rows = rows.select("id", "v", norm(F.col("v")).alias("nx"))
    asked = queries.select("query_id", "query", norm(F.col("query")).alias("nq"))
    return rows.join(F.broadcast(asked)).select("query_id", "id", F.when((F.col("nx") > 0) & (F.col("nq") > 0), dot / (F.col("nx") * F.col("nq"))).otherwise(0.0).alias("score"))


def _topk(table: DataFrame, queries: DataFrame, k: int, id_col: str, vec_col: str) -> DataFrame:
    spark = table.sparkSession
    runtime.ship(spark)
    rows = table.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    usual = queries.filter("size(query) > 0").groupBy(F.size("query").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = usual.d if usual else 1
    odd = lambda c: ~F.coalesce(F.size(c) == d, F.lit(False)) | F.exists(c, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x) == float("inf")))
    fits = lambda c: ~F.coalesce(odd(c), F.lit(True))
    found = queries.filter(fits("query")).select("query_id", "query").toArrow()  # at most about `limit` rows
    shared = spark.sparkContext.broadcast((found.column("query_id").combine_chunks(), _matrix(found.column("query").combine_chunks(), d)) if len(found) else None)

    def run(batches):
        names, q = shared.value
        qn, qu = _unit(q)
        held = None  # each query's least score that still counts, and the best so far
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                held = _scan(held, part.column("id"), _matrix(part.column("v"), d), q, qn, qu, k)
        if held:
            _, query, ids, score = held
            yield pa.RecordBatch.from_arrays([names.take(pa.array(query)), ids, pa.array(score)], names=["query_id", "id", "score"])

    kind, wide = queries.schema["query_id"].dataType.simpleString(), rows.schema["id"].dataType.simpleString()
    scored = [rows.filter(fits("v")).mapInArrow(run, f"query_id {kind}, id {wide}, score double")] if len(found) else []
    left = rows.filter(~fits("v"))
    if not left.isEmpty():
        scored.append(_by_expressions(left, queries.filter(fits("query"))))
    left = queries.filter(~fits("query"))
    if not scored or not left.isEmpty():
        scored.append(_by_expressions(rows, left))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return functools.reduce(DataFrame.union, scored).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _scan(held, ids: pa.Array, x: np.ndarray, q: np.ndarray, qn: np.ndarray, qu: np.ndarray, k: int) -> tuple:
    """The k best of each query (least score that counts, query, ids, score) after these rows."""
    least, query, before, score = held or (np.full(len(q), -np.inf), np.zeros(0, np.int64), ids.slice(0, 0), np.zeros(0))
    # of equal vectors only the k smallest ids can be among the k best
    rank = np.empty(len(x), np.int64)
    rank[pc.array_sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(x))
    same = np.unique(x + 0.0, axis=0, return_inverse=True)[1].reshape(-1)
    mine = np.sort(_best(same, rank, np.zeros(len(x)), k))
    ids, x = ids.take(pa.array(mine)), x[mine]
    xn, xu = _unit(x)
    slack = 1.2e-7 * (x.shape[1] + 8)  # more than rounding of single-precision products of unit vectors can amount to
    hit_q, hit_x = [], []
    step = max(1, STEP // max(len(x), 1))
    for a in range(0, len(q), step):
        near = qu[a : a + step] @ xu.T
        bar = least[a : a + step]
        if held is None and len(x) > k:  # later, what has been found is bar enough
            bar = np.partition(near, len(x) - k, axis=1)[:, len(x) - k]
        at, other = np.nonzero(near >= (bar - 2 * slack).astype(np.float32)[:, None])
        hit_q.append(at + a)
        hit_x.append(other)
    at, other = np.concatenate(hit_q), np.concatenate(hit_x)
    if not len(at):
        return least, query, before, score
    exact = np.zeros(len(at))
    for a in range(0, len(at), 1 << 18):
        i, j = at[a : a + (1 << 18)], other[a : a + (1 << 18)]
        size = xn[j] * qn[i]
        exact[a : a + (1 << 18)] = np.where(size > 0, _in_order(x[j], q[i]) / np.where(size > 0, size, 1.0), 0.0)
    query, ids, score = np.concatenate([query, at]), pa.concat_arrays([before, ids.take(pa.array(other))]), np.concatenate([score, exact])
    rank = np.empty(len(ids), np.int64)
    rank[pc.array_sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
    kept = _best(query, rank, score, k)
    query, ids, score = query[kept], ids.take(pa.array(kept)), score[kept]
    full = np.bincount(query, minlength=len(q)) == k
    least = np.full(len(q), -np.inf)
    np.minimum.at(low := np.full(len(q), np.inf), query, score)
    least[full] = low[full]
    return least, query, ids, score
