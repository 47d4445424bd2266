"""What the operators of this subpackage share: shared-folder tables, sizes, word splitting and hashing.

Words are maximal runs of bytes other than U+0020 and U+0009..U+000D; a null text has none.
A row with a null doc_id is an ordinary document that belongs to no held-out fold.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import itertools
import math
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom import runtime

#: Text handled at once inside a Python worker; bounds the worker's memory for texts of ordinary length.
SLICE_BYTES = 2 << 20
_count = itertools.count()


#: The setting that bounds an Arrow batch on its way to a Python worker, Spark's default, and what the operators ask for.
BATCH_BYTES, BATCH_DEFAULT, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, "4m"


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers; where the session has Spark's default there, bound Arrow batches to 4 MB."""
    runtime.ship(spark)
    if spark.conf.get(BATCH_BYTES).removesuffix("b") == str(BATCH_DEFAULT):
        spark.conf.set(BATCH_BYTES, BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: spark.checkpoint.dir. Where that is unset, a local session gets a folder of its own; a
    cluster's executors could not see one, so there it is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="blockloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def store(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write df as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:10]}-{next(_count)}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop(*tables: DataFrame, shuffles: bool = False) -> None:
    """Delete tables made by store() that nothing reads any more; shuffles: and free() (a pause of the driver, for the ends
    of large steps)."""
    for t in tables:
        path = getattr(t, "_stored_at", None)
        if path:
            spark = t.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if shuffles:
        free(tables[0].sparkSession)


def free(spark: SparkSession) -> None:
    """Have the driver look for finished plans, whose shuffle files Spark's cleaner then removes."""
    gc.collect()
    spark._jvm.System.gc()


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What tells rows apart that share an id or have none: a hash of id and text. Rows with one key are copies of each other."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def partitions(df: DataFrame, bytes_each: int = 24 << 20) -> int:
    """Shuffle partitions for df: the session's number, more where its input is large."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(runtime.input_bytes(df) / bytes_each))


def fold(doc_id: str | Column, mod: int) -> Column:
    """crc32 of doc_id as text, modulo mod; null for a null doc_id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % mod


def held_out(doc_id: str | Column, mod: int, rest: int) -> Column:
    return F.coalesce(fold(doc_id, mod) == rest, F.lit(False))


def release() -> None:
    """Give back what a Python worker has freed but still holds, as it shares its machine with the JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str | int = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most about `most` bytes of text each (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, start = np.cumsum(size), 0
    while start < n:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    release()


def whole(text: pa.Array) -> pa.Array:
    """Texts as an array of their own, nulls as empty ones. (A slice that is cast and then lowered has its offsets read wrongly.)"""
    if text.offset:
        text = text.take(pa.array(np.arange(len(text))))
    return pc.fill_null(text.cast(pa.large_string()), "")


def split_words(text: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and each text's first word (one more offset than texts)."""
    text = whole(text)
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(text)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))])
    flat = lists.flatten()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        flat = flat.filter(pa.array(full))
        ends = np.concatenate([[0], np.cumsum(full)])[ends]
    return flat, ends.astype(np.int64)


#: Words of at most this many bytes are hashed by array operations.
SHORT = 64


def hash_words(flat: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word as uint64; each distinct word of the batch is hashed once, eight bytes at a time."""
    if not len(flat):
        return np.zeros(0, np.uint64)
    coded = flat.dictionary_encode()
    own = coded.dictionary.cast(pa.large_binary())
    cuts = np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1]
    raw = np.frombuffer(own.buffers()[2] or b"", np.uint8)[: cuts[-1]]
    at, size = cuts[:-1], np.diff(cuts)
    raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    h = mix(size.astype(np.uint64) + np.uint64(seed))
    live = np.flatnonzero((size > 0) & (size <= SHORT))
    done = 0
    while len(live):
        block = np.zeros(len(live), np.uint64)
        for j in range(8):
            inside = size[live] > done + j
            block |= np.where(inside, raw[np.where(inside, at[live] + done + j, 0)], 0).astype(np.uint64) << np.uint64(8 * j)
        h[live] = mix(h[live] * np.uint64(0x9E3779B97F4A7C15) + block)
        done += 8
        live = live[size[live] > done]
    for i in np.flatnonzero(size > SHORT).tolist():
        h[i] = xxhash.xxh3_64_intdigest(raw[cuts[i] : cuts[i + 1]].tobytes(), seed)
    return h[coded.indices.to_numpy(zero_copy_only=False)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise (wraps)."""
    x = np.asarray(x, np.uint64)
    y = x ^ (x >> np.uint64(30))
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(27)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


def doc_index(ends: np.ndarray) -> np.ndarray:
    """For each word, the position of its text in the batch."""
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends))


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of each text's values."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends[1:]] - total[ends[:-1]]


def emit(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def dealt(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that brings equal buckets together (and keeps the order inside them), and (bucket, from, to) of each in it."""
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)] if len(own) else [0]
    return order, [(int(own[a]), a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def share(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of the 64-bit range, cut into `parts` equal ones, that each key lies in."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
