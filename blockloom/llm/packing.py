"""Packing along a space-filling curve.

Each document's words are hashed and projected to `DIMS` sign sums, divided by the root of their number (its position, whose
spread so does not depend on the length), and the position's Hilbert key orders the documents. Documents are moved in parts
of at most `length` ids, so that the ranges of the sort by (key, row, part) have about as many bytes as each other, and
each partition cuts its stream of ids into sequences of `length`. What is left at a partition's end is cut at powers of
two, which need no padding.

A null or empty text is one end id. Repeated rows are packed each, as are rows that share a doc_id or have none. An empty
table gives no rows. Very long texts are parts like others. Equal keys are separated by a hash of id and text, so that a
large group of copies spreads over partitions; rows that repeat both may meet in any order. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import emit, mix, partitions, row_key, ship, slices, split_words, store, sums
from blockloom.llm.tokenizing import ByteIds

DIMS, BITS = 3, 16
ODD = 0x9E3779B97F4A7C15
#: Bytes of words that are coded at once (a code needs some eighty bytes of memory for each), and of text that is encoded at once.
CODED_BYTES, ENCODED_BYTES = 1 << 17, 1 << 19


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of rows of integer coordinates below 2**bits (the transposed-axes rule)."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        low = np.uint64(q - np.uint64(1))
        for i in range(dims):
            up = (x[i] & q) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), np.uint64(1 << (bits - 1))
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - np.uint64(1), np.uint64(0))
        q >>= np.uint64(1)
    x ^= turn
    key = np.zeros_like(turn)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key


def word_codes(flat: pa.Array) -> np.ndarray:
    """A number for each word from all of its bytes, by array operations alone: good enough to draw signs from. It does not
    depend on the words around it, so words are taken some CODED_BYTES at a time."""
    if not len(flat):
        return np.zeros(0, np.uint64)
    cuts = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    raw, out, a = np.frombuffer(flat.buffers()[2], np.uint8), np.empty(len(flat), np.uint64), 0
    while a < len(flat):
        b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + CODED_BYTES, side="right")) - 1)
        out[a:b] = _codes(raw[cuts[a] : cuts[b]].astype(np.uint64), cuts[a : b + 1] - cuts[a])
        a = b
    return out


def _codes(raw: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw + np.uint64(1)) * np.multiply.accumulate(np.full(len(raw), ODD, np.uint64)), dtype=np.uint64)])
    back = np.multiply.accumulate(np.full(len(raw), pow(ODD, -1, 1 << 64), np.uint64))
    return mix((total[cuts[1:]] - total[cuts[:-1]]) * back[cuts[:-1]])


def positions(text: pa.Array) -> np.ndarray:
    """Coordinates of each text: DIMS random sign sums over its words' hashes, scaled to the cell grid."""
    flat, ends = split_words(text, lower=True)
    h, n = word_codes(flat), np.sqrt(np.maximum(np.diff(ends), 1))
    at = np.empty((len(ends) - 1, DIMS), np.int64)
    for j in range(DIMS):
        sign = ((h >> np.uint64(7 * j)) & np.uint64(1)).astype(np.int64) * 2 - 1
        at[:, j] = (np.tanh(sums(sign, ends) / n * 0.8) + 1) / 2 * ((1 << BITS) - 1)
    return at


def cut(parts: list[tuple], length: int):
    """Deal an open sequence's parts (doc_id, start, ids bytes, doc_tokens) out to sequences of powers of two."""
    left, total = list(parts), sum(len(p[2]) // 4 for p in parts)
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        took, room = [], size
        while room:
            doc, start, ids, n = left.pop(0)
            k = len(ids) // 4
            if k > room:
                left.insert(0, (doc, start + room, ids[4 * room :], n))
                ids, k = ids[: 4 * room], room
            took.append((doc, start, ids, n))
            room -= k
        yield took


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, hilbert_key."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    wide = 2 if ByteIds(path).tok.get_vocab_size() <= 65536 else 4

    def encode(batches):
        ids = ByteIds(path)
        end = np.array([end_id], f"<u{wide}").tobytes()
        for batch in batches:
            for part in slices(batch, most=ENCODED_BYTES):
                key = hilbert_key(positions(part.column("text"))).astype(np.int64)
                coded = [ids.encode(t or "") for t in part.column("text").to_pylist()]
                if wide == 2:  # the end ids join all texts' ids to one array, of which each text has its share
                    size = [len(c) // 4 for c in coded]
                    narrow = np.frombuffer(b"".join(coded), "<u4").astype("<u2").tobytes()
                    cuts = np.concatenate([[0], np.cumsum(size)]) * 2
                    coded = [narrow[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                coded = [c + end for c in coded]
                cut = [(i, at) for i, c in enumerate(coded) for at in range(0, len(c), wide * length)]
                who = pa.array([i for i, _ in cut], pa.int64())
                yield emit(
                    doc_id=part.column("doc_id").take(who), row=part.column("row").take(who), key=pa.array(key).take(who), start=pa.array([at // wide for _, at in cut], pa.int64()),
                    n=pa.array([len(coded[i]) // wide for i, _ in cut], pa.int64()), ids=pa.array([coded[i][at : at + wide * length] for i, at in cut], pa.binary()),
                )

    coded = store(rows.mapInArrow(encode, "doc_id bigint, row bigint, key bigint, start bigint, n bigint, ids binary"), "pack-ids")
    ordered = coded.repartitionByRange(partitions(coded, 16 << 20), "key", "row", "start").sortWithinPartitions("key", "row", "start")

    def lay(batches):
        ctx = TaskContext.get()
        sequence = (ctx.partitionId() if ctx else 0) << 40
        open_parts: list[tuple] = []
        fill = 0
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "hilbert_key")
        types = [pa.int64()] * len(names)

        def close(parts, out):
            nonlocal sequence
            at = 0
            for (doc, key), start, ids, n in parts:
                k = len(ids) // 4
                out.append((doc, start, k, zlib.crc32(ids), n, sequence, at, key))
                at += k
            sequence += 1

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=list(names))

        for batch in batches:
            out: list[tuple] = []
            ids = batch.column("ids")
            size = pc.binary_length(ids).to_numpy() // wide
            raw = np.frombuffer(b"".join(x.as_buffer() for x in ids), f"<u{wide}").astype("<u4").tobytes()
            at = 0
            for doc, key, first, n, many in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "start", "n")), size.tolist(), strict=True):
                taken = 0
                while taken < many:
                    k = min(length - fill, many - taken)
                    open_parts.append(((doc, key), first + taken, raw[at : at + 4 * k], n))
                    taken, fill, at = taken + k, fill + k, at + 4 * k
                    if fill == length:
                        close(open_parts, out)
                        open_parts, fill = [], 0
            if out:
                yield batch_of(out)
        out = []
        for parts in cut(open_parts, length):
            close(parts, out)
        if out:
            yield batch_of(out)

    return ordered.mapInArrow(lay, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, hilbert_key bigint")
