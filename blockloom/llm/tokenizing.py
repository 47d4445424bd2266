"""Fast exact pre-token paths for the two public tokenizers, with a fall-back to the library.

The splitting rules below are for texts whose characters all lie below U+0250; any other text, and any text that
holds one of the tokenizer's special strings, goes whole to the tokenizers library.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

UNSIGNED_32 = next(c for c in "IL" if array(c).itemsize == 4)

# Letters, numbers and white space below U+0250, as character-class bodies.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "

BEYOND = re.compile("[^\u0000-ɏ]")


def _byte_level(letters: str, numbers: str, spaces: str) -> re.Pattern:
    return re.compile(f" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?[^{spaces}{letters}{numbers}]+| ?[{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


def _word_level(letters: str, numbers: str, spaces: str) -> re.Pattern:
    return re.compile(f"[{letters}]+|'(?:[stmd]|re|ve|ll)|[{numbers}]|[^{spaces}{letters}{numbers}]+")


BYTE_LEVEL, WORD_LEVEL = _byte_level(LETTERS, NUMBERS, SPACES), _word_level(LETTERS, NUMBERS, SPACES)
ASCII_BYTE_LEVEL, ASCII_WORD_LEVEL = _byte_level("A-Za-z", "0-9", "\t-\r "), _word_level("a-z", "0-9", "\t-\r ")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def special_strings(tok) -> list[str]:
    return [t.content for t in tok.get_added_tokens_decoder().values()]


class Bounded(dict):
    """A cache over a fixed base table; at `most` entries it starts again from the base."""

    def __init__(self, make, base=(), most=400_000):
        super().__init__(base)
        self.make, self.base, self.most = make, base, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
            self.update(self.base)
        value = self[key] = self.make(key)
        return value


class WordLengths:
    """Token counts under the lower-casing word tokenizer."""

    def __init__(self, path: str, base=()):
        self.tok = load(path)
        self.special = special_strings(self.tok)
        self.model, self.table = self.tok.model, dict(enumerate(byte_alphabet()))
        self.cache = Bounded(self.length, base)

    def length(self, token: str) -> int:
        return len(self.model.tokenize(token.encode().decode("latin-1").translate(self.table)))

    def split(self, text: str) -> list[str] | None:
        """Pre-tokens, or None if the text must go to the library."""
        if any(s in text for s in self.special):
            return None
        if text.isascii():
            return ASCII_WORD_LEVEL.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        if BEYOND.search(text) or "İ" in text:
            return None
        text = text.lower()
        return None if BEYOND.search(text) else WORD_LEVEL.findall(text)

    def count(self, text: str) -> int:
        parts = self.split(text)
        if parts is None:
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        return sum(map(self.cache.__getitem__, parts))


class ByteIds:
    """Ids under the byte-level tokenizer as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken

        self.tok = load(path)
        self.special = special_strings(self.tok)
        back = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(back[c] for c in t): i for t, i in self.tok.get_vocab(with_added_tokens=False).items() if t not in self.special}
        # a byte-level vocabulary's ids are its merge ranks, so one pre-token's merges can be had from the rank table
        self.piece = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.cache = Bounded(lambda t: array(UNSIGNED_32, self.piece(t.encode())).tobytes(), most=100_000)

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        if text.isascii():
            parts = ASCII_BYTE_LEVEL.findall(text)
        elif BEYOND.search(text):
            return self.whole(text)
        else:
            parts = BYTE_LEVEL.findall(text)
        return b"".join(map(self.cache.__getitem__, parts))
