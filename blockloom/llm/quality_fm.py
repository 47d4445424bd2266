"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]), in time linear in the
non-zero features. Words are lower-cased (A-Z) and hashed to `2**WORD_BITS` buckets (weights normalised by the text's
length); structure statistics (symbol, capital, digit, bar, punctuation and repeated-line shares, mean word length) and
the length metadata are one-hot bins. Labels, lang, source and doc_id are never features.

The model is fitted on at most about `train_rows` labelled rows drawn by a hash of doc_id (the documented bound).
Null and empty texts are scored from their structure bins. Rows with null labels are not learnt from; a doc_id with
several labels counts once each. Without any labelled row every score is 0.5. Repeated rows get a row each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import doc_index, emit, hash_words, ship, slices, split_words, sums, whole

WORD_BITS, RANK, BINS, STATS = 14, 8, 16, 9
WORDS = 1 << WORD_BITS
SIZE = WORDS + STATS * BINS


def features(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature index and value of every non-zero feature, and each text's first (one more)."""
    text = whole(text)
    flat, ends = split_words(text, lower=True)
    docs, n = len(ends) - 1, np.diff(ends)
    bucket = (hash_words(flat) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    pair, tf = np.unique(doc_index(ends) * WORDS + bucket, return_counts=True)
    who, index = pair // WORDS, pair % WORDS
    norm = np.sqrt(np.bincount(who, weights=tf.astype(float) ** 2, minlength=docs))
    value = tf / np.maximum(norm[who], 1e-9)

    raw = np.frombuffer(b"".join(t.as_buffer() for t in text) if docs else b"", np.uint8)
    cut = np.concatenate([[0], np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))])
    size = np.maximum(np.diff(cut), 1)

    def share(lookup: str) -> np.ndarray:
        table = np.zeros(256, np.uint8)
        table[[ord(c) for c in lookup]] = 1
        return sums(table[raw], cut) / size

    lines = [t.split("\n") for t in text.to_pylist()]
    repeated = np.array([1 - len(set(x)) / len(x) for x in lines]) if docs else np.zeros(0)
    stats = [
        np.log1p(n) / 10, (size / np.maximum(n, 1)) / 16, share("#*$%&<>") * 8, share("ABCDEFGHIJKLMNOPQRSTUVWXYZ") * 2, share("0123456789") * 8,
        share("|!") * 8, share(".,;:?") * 8, repeated * 2, np.log1p(size) / 14,
    ]
    binned = np.stack([np.clip((s * BINS).astype(np.int64), 0, BINS - 1) + WORDS + k * BINS for k, s in enumerate(stats)], axis=1) if docs else np.zeros((0, STATS), np.int64)
    who = np.concatenate([who, np.repeat(np.arange(docs), STATS)])
    index, value = np.concatenate([index, binned.ravel()]), np.concatenate([value, np.full(docs * STATS, 0.5)])
    order = np.argsort(who, kind="stable")
    return index[order].astype(np.int32), value[order].astype(np.float32), np.searchsorted(who[order], np.arange(docs + 1))


class Machine:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.w = np.zeros(SIZE, np.float32)
        self.v = rng.normal(0, 0.05, (SIZE, RANK)).astype(np.float32)

    def raw(self, index, value, ends):
        """Linear part plus half the difference between the squared sum and the sum of squares, per text."""
        vx = self.v[index] * value[:, None]
        total = np.concatenate([np.zeros((1, RANK)), np.cumsum(vx, axis=0, dtype=np.float64)])
        s = total[ends[1:]] - total[ends[:-1]]
        square = sums((vx.astype(np.float64) ** 2).sum(axis=1), ends)
        return self.bias + sums(self.w[index] * value.astype(np.float64), ends) + 0.5 * ((s**2).sum(axis=1) - square), s

    def score(self, index, value, ends):
        return 1 / (1 + np.exp(-np.clip(self.raw(index, value, ends)[0], -30, 30)))

    def fit(self, index, value, ends, label, steps: int = 1200, rate: float = 0.1, batch: int = 64, decay: float = 1e-4, seed: int = 3):
        rng, n = np.random.default_rng(seed), len(label)
        p = np.clip(label.mean(), 0.01, 0.99) if n else 0.5
        self.bias = float(np.log(p / (1 - p)))
        gw, gv, gb = np.full(SIZE, 1e-6, np.float32), np.full((SIZE, RANK), 1e-6, np.float32), 1e-6
        for _ in range(max(3, -(-steps * batch // max(n, 1))) if n else 0):
            for rows in np.array_split(rng.permutation(n), max(1, n // batch)):
                size = ends[rows + 1] - ends[rows]
                own = np.concatenate([[0], np.cumsum(size)])
                pick = np.repeat(ends[rows] - own[:-1], size) + np.arange(own[-1])
                i, x = index[pick], value[pick]
                z, s = self.raw(i, x, own)
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[rows]).astype(np.float32)
                e = np.repeat(err, size)
                ids, at = np.unique(i, return_inverse=True)
                dw = np.bincount(at, weights=e * x, minlength=len(ids)).astype(np.float32) / len(rows) + decay * self.w[ids]
                gw[ids] += dw**2
                self.w[ids] -= rate * dw / np.sqrt(gw[ids])
                full = (np.repeat(s, size, axis=0) - self.v[i] * x[:, None]) * (e * x)[:, None]
                dv = np.stack([np.bincount(at, weights=full[:, f], minlength=len(ids)) for f in range(RANK)], axis=1).astype(np.float32) / len(rows) + decay * self.v[ids]
                gv[ids] += dv**2
                self.v[ids] -= 0.2 * rate * dv / np.sqrt(gv[ids])
                db = float(err.mean())
                gb += db**2
                self.bias -= 0.2 * rate * db / gb**0.5
        return self


def fit(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", train_rows: int = 12_000) -> Machine:
    """Learn from labelled rows where `train` (over labels' id column) holds."""
    spark = docs.sparkSession
    ship(spark)
    own = labels.filter(train & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label"))
    n = own.count()
    drawn = own.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, train_rows / max(n, 1))))
    # the sample has a documented bound, so its side of the join may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(drawn), "id").select("id", "label", "text")

    def extract(batches):
        for batch in batches:
            for part in slices(batch):
                index, value, ends = features(part.column("text"))
                raw_i, raw_v = index.tobytes(), value.tobytes()
                yield emit(id=part.column("id"), label=part.column("label"), i=pa.array([raw_i[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary()), v=pa.array([raw_v[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary()))

    found = sorted(rows.mapInArrow(extract, "id bigint, label double, i binary, v binary").toLocalIterator(), key=lambda r: (r.id, r.label, r.i))
    index = np.concatenate([np.frombuffer(r.i, np.int32) for r in found] or [np.zeros(0, np.int32)])
    value = np.concatenate([np.frombuffer(r.v, np.float32) for r in found] or [np.zeros(0, np.float32)])
    ends = np.concatenate([[0], np.cumsum([len(r.i) // 4 for r in found])]).astype(np.int64)
    return Machine().fit(index, value, ends, np.array([r.label for r in found], np.float32))


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, most=4 << 20):
                yield emit(doc_id=part.column("doc_id"), score=pa.array(shared.value.score(*features(part.column("text")))))

    return rows.mapInArrow(run, "doc_id bigint, score double")
