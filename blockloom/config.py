"""Options as frozen values; they are inlined as literals, so Catalyst can fold them."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ParserOptions:
    max_chars: int = 450
    #: Kept for configuration parity; pieces always share exactly the one row that overflowed.
    overlap_rows: int = 1
    tag_prefix: str = "?"
    exclude: tuple[str, ...] = ()
    extensions: tuple[str, ...] = (".md", ".markdown")
    input_dir: str = "./data"
    output_dir: str = "./output"
    #: compat: headers, tags and table rows count inside code; strict: a fence protects all lines inside it.
    mode: str = "compat"


@dataclass(frozen=True)
class VectorOptions:
    dimension: int = 1024
    batch_size: int = 512
    request_texts: int = 16
    request_tokens: int = 512
    retries: int = 3
    rpm: int = 1800
    tpm: int = 450_000
    adaptive: bool = True
    delay: float = 0.5
    delay_bounds: tuple[float, float] = (0.1, 5.0)
    delay_factors: tuple[float, float] = (1.5, 0.9)
    store_dir: str = "./vector_store"
    collection: str = "vectors"
    api_base: str = ""
    model: str = ""
    api_key: str = field(default="", repr=False)


def load(path: str = "config.yaml") -> tuple[ParserOptions, VectorOptions]:
    """Options from a YAML file: at `path`, or under the project's root; missing keys keep their defaults. The service's and
    the store's sections lie inside `vector_store`."""
    import yaml  # only needed for files

    here = path if os.path.exists(path) else os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), path)
    with open(here, encoding="utf-8") as f:
        raw = yaml.safe_load(f) or {}
    return from_mapping(raw)


def from_mapping(raw: dict) -> tuple[ParserOptions, VectorOptions]:
    at = lambda *keys: _dig(raw, keys)
    parser, vector = ParserOptions(), VectorOptions()
    pick = lambda value, default: default if value is None else value
    parser = ParserOptions(
        max_chars=pick(at("parser", "chunk_strategy", "max_chars"), parser.max_chars), overlap_rows=pick(at("parser", "chunk_strategy", "overlap_rows"), parser.overlap_rows),
        tag_prefix=pick(at("tags", "prefix"), parser.tag_prefix), exclude=tuple(pick(at("tags", "exclude_regex"), parser.exclude)),
        extensions=tuple(pick(at("parser", "file_extensions"), parser.extensions)), input_dir=pick(at("parser", "input_dir"), parser.input_dir), output_dir=pick(at("parser", "output_dir"), parser.output_dir),
    )
    vector = VectorOptions(
        dimension=pick(at("vector_store", "dimension"), vector.dimension), batch_size=pick(at("vector_store", "batch_size"), vector.batch_size),
        request_texts=min(pick(at("vector_store", "batch_size"), vector.batch_size), vector.request_texts),
        rpm=pick(at("vector_store", "embedding", "rate_limit", "rpm"), vector.rpm), tpm=pick(at("vector_store", "embedding", "rate_limit", "tpm"), vector.tpm),
        adaptive=pick(at("vector_store", "embedding", "rate_limit", "enable_adaptive_delay"), vector.adaptive), delay=pick(at("vector_store", "embedding", "rate_limit", "request_delay"), vector.delay),
        api_base=pick(at("vector_store", "embedding", "api_base"), vector.api_base), model=pick(at("vector_store", "embedding", "model"), vector.model), api_key=pick(at("vector_store", "embedding", "api_key"), vector.api_key),
        store_dir=pick(at("vector_store", "chromadb", "persist_directory"), vector.store_dir), collection=pick(at("vector_store", "chromadb", "collection_name"), vector.collection),
    )
    return parser, vector


def _dig(raw: dict, keys: tuple[str, ...]):
    for k in keys:
        raw = raw.get(k) if isinstance(raw, dict) else None
    return raw
