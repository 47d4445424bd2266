"""Embedding through a provider, request by request, under a rate limit; failures are row status, not exceptions.

A provider is any object with embed(texts) -> list of vectors (or an exception); a factory makes it on the executor.
"""

from __future__ import annotations

import hashlib
import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.config import VectorOptions
from blockloom.runtime import ship


class Provider(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class HashedWords:
    """A deterministic local provider: signed hashed bag of words, normalised."""

    def __init__(self, dimension: int):
        self.dimension = dimension

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = np.zeros(self.dimension, np.float32)
            for w in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                v[(h >> 1) % self.dimension] += 1.0 if h & 1 else -1.0
            norm = float(np.linalg.norm(v))
            out.append((v / norm if norm else v).tolist())
        return out


class RemoteProvider:
    """An HTTP service with an `embeddings` end point; needs the openai client where it runs, and a key."""

    def __init__(self, options: VectorOptions):
        import os

        from openai import OpenAI

        key = options.api_key or os.environ.get("OPENAI_API_KEY", "")
        if not key:
            raise ValueError("no API key: set embedding.api_key or the environment variable")
        self.client, self.options = OpenAI(api_key=key, base_url=options.api_base or None), options

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = self.client.embeddings.create(model=self.options.model, input=texts, encoding_format="float", dimensions=self.options.dimension)
        return [x.embedding for x in out.data]


@dataclass
class Limiter:
    """Requests and tokens of the trailing minute, for one task; clock and sleep can be replaced in tests."""

    rpm: int
    tpm: int
    adaptive: bool = True
    delay: float = 0.5
    bounds: tuple[float, float] = (0.1, 5.0)
    factors: tuple[float, float] = (1.5, 0.9)
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    seen: deque = field(default_factory=deque)

    def wait(self, tokens: int) -> float:
        """Sleep as long as the limits and the delay ask for; the seconds slept."""
        now = self.clock()
        while self.seen and now - self.seen[0][0] >= 60:
            self.seen.popleft()
        used = sum(n for _, n in self.seen)
        load = (len(self.seen) / max(self.rpm, 1), used / max(self.tpm, 1))
        if self.adaptive:
            if max(load) > 0.8:
                self.delay = min(self.delay * self.factors[0], self.bounds[1])
            elif max(load) < 0.5:
                self.delay = max(self.delay * self.factors[1], self.bounds[0])
        full = self.seen and (len(self.seen) >= self.rpm or used + tokens > self.tpm)
        pause = (max(0.0, 60 - (now - self.seen[0][0])) if full else 0.0) + self.delay
        if pause > 0:
            self.sleep(pause)
        self.seen.append((self.clock(), tokens))
        return pause


def embed(requests: DataFrame, factory: Callable[[], Provider], options: VectorOptions, tasks: int = 1, limited: bool = True) -> DataFrame:
    """file_path, block_id, embedding (null after a failure), error, wait (seconds that the limiter held the row's request back,
    on its first row) of rows (file_path, request, batch, block_seq, block_id, text, tokens). The minute's budget is divided among `tasks` partitions; a request's rows are handled together."""
    ship(requests.sparkSession)
    dim, retries = options.dimension, options.retries
    schema = "file_path string, block_id string, embedding array<float>, error string, wait double"

    def call(provider: Provider, texts: list[str]):
        for attempt in range(retries):
            try:
                vectors = provider.embed(texts)
                bad = next((i for i, v in enumerate(vectors) if len(v) != dim), None)
                if bad is not None:
                    return None, f"text {bad}: {len(vectors[bad])} dimensions instead of {dim}"
                return vectors, None
            except Exception as e:  # noqa: BLE001  a failed request is a status
                if attempt == retries - 1:
                    return None, str(e)[:500]
                time.sleep(2**attempt if limited else 0)
        return None, "not tried"

    def run(batches):
        provider = None
        limiter = Limiter(max(1, options.rpm // tasks), max(1, options.tpm // tasks), options.adaptive, options.delay, options.delay_bounds, options.delay_factors)
        held: list[tuple] = []
        at = None

        def flush():
            nonlocal provider, held
            if not held:
                return None
            provider = provider or factory()
            wait = limiter.wait(sum(r[4] for r in held)) if limited else 0.0
            vectors, error = call(provider, [r[3] for r in held])
            out = pa.RecordBatch.from_arrays([pa.array([r[1] for r in held], pa.string()), pa.array([r[2] for r in held], pa.string()), pa.array(vectors or [None] * len(held), pa.list_(pa.float32())), pa.array([error] * len(held), pa.string()), pa.array([wait] + [0.0] * (len(held) - 1))], names=["file_path", "block_id", "embedding", "error", "wait"])
            held = []
            return out

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("batch", "request", "file_path", "block_id", "text", "tokens")), strict=True):
                if at != (r[2], r[0], r[1]):
                    done = flush()
                    if done is not None:
                        yield done
                    at = (r[2], r[0], r[1])
                held.append((r[1], r[2], r[3], r[4], r[5]))
        done = flush()
        if done is not None:
            yield done

    ordered = requests.repartition(tasks, "file_path", "batch", "request").sortWithinPartitions("file_path", "batch", "request", "block_seq")
    return ordered.mapInArrow(run, schema)


def _done(options: VectorOptions):
    return F.col("embedding").isNotNull() & (F.size("embedding") == options.dimension)


def failed(embedded: DataFrame, options: VectorOptions) -> DataFrame:
    """block_id and error of every row without a vector of the right size."""
    return embedded.filter(~_done(options)).select("block_id", "error")


def status(embedded: DataFrame, options: VectorOptions) -> DataFrame:
    """One row: success, failure, wait_seconds, failed_ids (the first ten, for display; failed() has all)."""
    ok = _done(options)
    first = failed(embedded, options).orderBy("block_id").limit(10).agg(F.sort_array(F.collect_list("block_id")).alias("failed_ids"))
    return embedded.agg(F.count_if(ok).alias("success"), F.count_if(~ok).alias("failure"), F.coalesce(F.sum("wait"), F.lit(0.0)).alias("wait_seconds")).join(F.broadcast(first))  # one row each
