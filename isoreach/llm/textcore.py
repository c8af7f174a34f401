"""Words, word hashes and word shingles, as vectorised kernels for Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
#: Entries that a worker's word cache holds before it starts anew (some 40 MB).
CACHE_WORDS = 250_000
SHINGLE = 5
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=U64)


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; a miss is computed and kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = WordHashes()


def raw(column: pa.Array) -> list[bytes | None]:
    """A string column's UTF-8 bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of [^\\x20\\x09-\\x0D]+ after lower-casing A-Z; bytes methods treat ASCII only."""
    return text.lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), dtype=U64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def shingles(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash for each place of five words; a shorter text is one shingle, none has none."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=U64)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], dtype=U64)
    h = word_hashes(words)
    s = h[: n - 4] * _MULT[0]
    for k in range(1, SHINGLE):
        s += h[k : n - 4 + k] * _MULT[k]
    return mix(s)


def batches(it: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller slices, so that a kernel's memory doesn't follow the reader's batch size."""
    for b in it:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
