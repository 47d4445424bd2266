"""Secret scans: fixed patterns, and probabilistic automata learnt from the credentials these find.

Labelled credentials are the values that the fixed patterns match in all documents, of which a bounded number of distinct
ones (`examples` of each kind) is drawn by hash. For each kind a frequency prefix tree over character classes is built and its statistically compatible states
are merged (red-blue order, Hoeffding bound on stop and step frequencies). Every candidate (what the base spans leave of
a maximal run of [A-Za-z0-9+/_.=-], and its parts between separators, of LEAST characters or more) is scored by its
likelihood under the best automaton against a background model of ordinary runs; one that is `bits` more likely is a
span of kind `learned`.
Spans of the fixed patterns always stay; a learned span never overlaps one.

Null and empty texts have no spans; repeated rows get a row each; an empty table gives no rows; other columns are
ignored. Spans are code-point offsets, end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blockloom.llm.common import emit, ship, slices

# The base patterns.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
KEYWORDS = ("passw", "secret", "token", "api_key", "apikey")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Candidates: the shortest is that of the assign pattern.
LEAST = 6
ANY_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
SEPARATES = re.compile(r"[=/._-]")
PARTS = [re.compile(p) for p in (r"[A-Za-z0-9+/_.=-]+", r"[A-Za-z0-9+/_.-]+", r"[A-Za-z0-9+_.-]+", r"[A-Za-z0-9+_-]+", r"[A-Za-z0-9+-]+")]
KINDS = ("assign", "access", "hex", "learned")
CLASSES = ("abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/", "=", "_", ".", "-")
SYMBOL = {c: chr(97 + i) for i, cls in enumerate(CLASSES) for c in cls}
WIDTH = {chr(97 + i): math.log2(len(cls)) for i, cls in enumerate(CLASSES)}
TO_CLASS = {ord(c): s for c, s in SYMBOL.items()}


class Automaton:
    """States as {symbol: (next state, count)} with stop counts; state 0 starts."""

    def __init__(self, words, alpha: float = 0.05):
        self.step: list[dict[str, list[int]]] = [{}]
        self.stop = [0]
        for w, n in Counter(words).items():
            at = 0
            for c in w:
                nxt = self.step[at].get(c)
                if nxt is None:
                    nxt = self.step[at][c] = [len(self.step), 0]
                    self.step.append({})
                    self.stop.append(0)
                nxt[1] += n
                at = nxt[0]
            self.stop[at] += n
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()

    def total(self, q: int) -> int:
        return self.stop[q] + sum(n for _, n in self.step[q].values())

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            n, m = self.total(p), self.total(q)
            if self._differ(self.stop[p], n, self.stop[q], m):
                return False
            for c in {*self.step[p], *self.step[q]}:
                x, y = self.step[p].get(c), self.step[q].get(c)
                if self._differ(x[1] if x else 0, n, y[1] if y else 0, m):
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to a."""
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            self.stop[p] += self.stop[q]
            for c, (nxt, n) in self.step[q].items():
                own = self.step[p].get(c)
                if own is None:
                    self.step[p][c] = [nxt, n]
                else:
                    own[1] += n
                    todo.append((own[0], nxt))

    def _merge_all(self) -> None:
        red = [0]
        while True:
            known = set(red)
            blue = [(q, c, nxt) for q in red for c, (nxt, _) in sorted(self.step[q].items()) if nxt not in known]
            if not blue:
                return
            q, c, b = max(blue, key=lambda x: self.total(x[2]))
            for r in red:
                if self._compatible(r, b):
                    self.step[q][c][0] = r
                    self._fold(r, b)
                    break
            else:
                red.append(b)

    def bits(self, word: str) -> float:
        """log2 probability of a class string; -inf if the automaton can't produce it."""
        at, out = 0, 0.0
        for c in word:
            nxt = self.step[at].get(c)
            if nxt is None:
                return -math.inf
            out += math.log2(nxt[1] / self.total(at))
            at = nxt[0]
        return out + math.log2((self.stop[at] + 0.5) / (self.total(at) + 1))


class Background:
    """Class bigrams of ordinary runs, add-one smoothed."""

    def __init__(self, runs):
        self.n, self.of = defaultdict(lambda: 1.0), defaultdict(lambda: float(len(CLASSES) + 1))
        for w, k in Counter(runs).items():
            for a, b in zip("^" + w, w + "$", strict=True):
                self.n[a + b] += k
                self.of[a] += k
        self.n, self.of = dict(self.n), dict(self.of)

    def bits(self, word: str) -> float:
        return sum(math.log2(self.n.get(a + b, 1.0) / self.of.get(a, len(CLASSES) + 1.0)) for a, b in zip("^" + word, word + "$", strict=True))


class Model:
    def __init__(self, labelled: dict[str, list[str]], ordinary: list[str], bits: float = 16.0):
        self.automata = {k: Automaton(v) for k, v in sorted(labelled.items()) if len(v) >= 10}
        self.background, self.bits = Background(ordinary), bits
        self.seen: dict[str, float] = {}

    def score(self, run: str) -> float:
        """Bits by which the best automaton prefers a run to the background."""
        word = run.translate(TO_CLASS)
        best = max((a.bits(word) for a in self.automata.values()), default=-math.inf)
        return best - self.background.bits(word) if best > -math.inf else -math.inf

    def known(self, run: str) -> float:
        """score(run); those of the first runs met are remembered."""
        out = self.seen.get(run)
        if out is None:
            out = self.score(run)
            if len(self.seen) < 100_000:
                self.seen[run] = out
        return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' matches, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for run in RUN.finditer(text):
        at, s = run.start(), run[0]
        if "AKIA" in s:
            out += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(s) if m.end() - m.start() >= 20]
        if len(s) >= 24:
            out += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(s)]
    return sorted(out)


def pieces(text: str, base: list[tuple[int, int, int]]):
    """(start, end) of what the base spans leave of each run, LEAST characters or more."""
    for run in ANY_RUN.finditer(text):
        at, end = run.span()
        for a, _, e in base:
            if a < end and e > at:
                if a - at >= LEAST:
                    yield at, a
                at = max(at, e)
        if end - at >= LEAST:
            yield at, end


def candidates(text: str, a: int, b: int) -> set[tuple[int, int]]:
    """A piece and its parts between more and more of the separators, without what separates at their ends."""
    found, s = set(), text[a:b]
    for cut in PARTS:
        for m in cut.finditer(s):
            x = m[0].lstrip("=.-_")
            at, n = m.end() - len(x), len(x.rstrip("=.-_"))
            if n >= LEAST:
                found.add((a + at, a + at + n))
    return found


def learned_spans(text: str, base: list[tuple[int, int, int]], model: Model) -> list[tuple[int, int, int]]:
    """The candidates that reach the model's bits; of overlapping ones the best."""
    out = []
    for a, b in pieces(text, base):
        s = text[a:b]
        spans = candidates(text, a, b) if SEPARATES.search(s) else ((a, b),)
        good = [(model.known(text[x:y]), x, y) for x, y in spans]
        kept: list[tuple[int, int]] = []
        for bits, x, y in sorted(good, key=lambda g: (-g[0], g[1], -g[2])) if len(good) > 1 else good:
            if bits >= model.bits and all(y <= u or v <= x for u, v in kept):
                kept.append((x, y))
        out += [(x, 3, y) for x, y in sorted(kept)]
    return out


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample_docs: int = 20_000, examples: int = 400) -> Model:
    """Learn the automata from the credentials in all documents: of each kind the `examples` distinct values with the
    smallest hashes. The background is learned from runs in about `sample_docs` documents, four times as many."""
    ship(docs.sparkSession)
    n = docs.count()
    sampled = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample_docs / max(n, 1)))
    rows = docs.select(F.col(text_col).cast("string").alias("text"), sampled.alias("sampled"))
    most = [examples] * 3 + [4 * examples]

    def label(batches):
        held: list[dict[str, int]] = [{} for _ in range(4)]  # value and hash, at most twice as many as are wanted

        def add(kind, value):
            own = held[kind]
            if value not in own:
                own[value] = xxhash.xxh3_64_intdigest(value, seed=kind) - (1 << 63)
                if len(own) >= 2 * most[kind]:
                    held[kind] = dict(sorted(own.items(), key=lambda x: (x[1], x[0]))[: most[kind]])

        for batch in batches:
            for text, ordinary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                spans = base_spans(text)
                for a, k, e in spans:
                    add(k, ASSIGN.match(text, a)[2] if k == 0 else text[a:e])
                if ordinary:
                    for a, b in pieces(text, spans):
                        add(3, text[a:b].strip("=.-_") or text[a:b])
        for k, own in enumerate(held):
            yield emit(kind=pa.array([k] * len(own), pa.int32()), value=pa.array(list(own), pa.string()), h=pa.array(list(own.values()), pa.int64()))

    found = rows.mapInArrow(label, "kind int, value string, h bigint").distinct()
    place = F.row_number().over(Window.partitionBy("kind").orderBy("h", "value"))
    limit = F.when(F.col("kind") == 3, most[3]).otherwise(examples)
    by: dict[int, list[str]] = {k: [] for k in range(4)}
    for r in found.withColumn("place", place).filter(F.col("place") <= 4 * examples).filter(F.col("place") <= limit).orderBy("kind", "place").collect():  # 7 * examples at most
        by[r.kind].append(r.value.translate(TO_CLASS))
    return Model({KINDS[k]: by[k] for k in range(3)}, by[3])


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in sorted(spans))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_learned, base_sha256, spans for every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                n, sha, spans = [[], [], [], []], [], []
                for text in part.column("text").to_pylist():
                    base = base_spans(text or "")
                    more = learned_spans(text or "", base, shared.value)
                    for k in range(4):
                        n[k].append(sum(x[1] == k for x in base) if k < 3 else len(more))
                    sha.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    spans.append(joined(base + more))
                yield emit(doc_id=part.column("doc_id"), **{f"n_{KINDS[k]}": pa.array(n[k], pa.int64()) for k in range(4)}, base_sha256=pa.array(sha, pa.string()), spans=pa.array(spans, pa.string()))

    return rows.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_learned bigint, base_sha256 string, spans string")


def redact(docs: DataFrame, model: Model, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every found span replaced by `mark`; all rows and columns stay."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        base = base_spans(text)
        out, last = [], 0
        for a, _, e in sorted(base + learned_spans(text, base, shared.value)):
            if e > last:
                out += [text[last:a], mark] if a >= last else []
                last = e
        return "".join(out) + text[last:] if out else text

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                cols = list(part.columns)
                cols[at] = pa.array([clean(t) for t in cols[at].to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays(cols, names=part.schema.names)

    return docs.mapInArrow(run, docs.schema)
