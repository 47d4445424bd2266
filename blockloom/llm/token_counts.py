"""Token counts by a map-side two-tier lookup, without any pre-token shuffle.

Tier one is a compact table (pre-token -> number of tokens) of the most frequent pre-tokens of a profile sample,
at most `table_size` entries, broadcast. Tier two is a bounded cache in each Python worker, filled by encoding the
pre-token that is missing. Both tiers hold exact lengths, so the profile changes the speed and never the result.

Null and empty texts have 0 bytes and 0 tokens; repeated rows get a row each; an empty table gives no rows; other
columns are ignored. Very long texts are handled whole.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import emit, ship, slices
from blockloom.llm.tokenizing import WordLengths


def frequent_lengths(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", table_size: int = 50_000, profile_docs: int = 4000, profile_tasks: int = 8) -> dict[str, int]:
    """Lengths of the `table_size` most frequent pre-tokens of about `profile_docs` documents drawn by a hash of their ids."""

    ship(docs.sparkSession)

    def count(batches):
        lengths, seen = WordLengths(path), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(lengths.split(text or "") or ())
        top = seen.most_common(table_size)
        yield emit(token=pa.array([t for t, _ in top], pa.string()), n=pa.array([n for _, n in top], pa.int64()))

    share = min(1.0, profile_docs / max(docs.count(), 1))
    drawn = docs.filter(F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(1 << 20)) < int((1 << 20) * share)).select(F.col(text_col).cast("string").alias("text"))
    total: Counter = Counter()
    for row in drawn.repartition(profile_tasks).mapInArrow(count, "token string, n bigint").toLocalIterator():  # profile_tasks * table_size rows at most
        total[row.token] += row.n
    lengths = WordLengths(path)
    return {t: lengths.cache[t] for t, _ in total.most_common(table_size)}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, table_size: int = 50_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of docs."""
    spark = docs.sparkSession
    ship(spark)
    base = spark.sparkContext.broadcast(frequent_lengths(docs, path, id_col, text_col, table_size))

    def run(batches):
        lengths = WordLengths(path, base.value)
        for batch in batches:
            for part in slices(batch):
                text = pc.fill_null(part.column("text"), "")
                n = [lengths.count(t.as_py()) for t in text]
                yield emit(doc_id=part.column("doc_id"), n_bytes=pc.cast(pc.binary_length(text), pa.int64()), n_tokens=pa.array(n, pa.int64()), over_limit=pa.array([x > limit for x in n], pa.bool_()))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
