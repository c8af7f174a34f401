"""Packing token windows: best-fit decreasing over a segment tree of remaining capacity.

Documents are tokenised once.  A document longer than a window is cut into full
windows, which are sequences by themselves; the rest of each document goes to
the tightest open window that still takes it, longest rests first.  Best fit
needs the open windows in one place, so the rests are dealt into groups of a
bounded size and each group is packed alone; with thousands of rests in a group
its windows come out all but full.
"""

from __future__ import annotations

import math
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm.runtime import ship, stash
from isoreach.llm.textcore import batches

WINDOW = 2048
END_ID = 1
#: Rests that are packed together in one task.
GROUP_ROWS = 16_384
#: Words in each of the two generations of a worker's cache.
CACHE_WORDS = 300_000

_LETTERS = "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == "L")
_NUMBERS = "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == "N")
#: Texts of these characters only are split here; they are their own NFC form, and lower-case and class alike everywhere.
_PLAIN = re.compile("[\t-\r -~¡-įı-ſ]*")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")


class WordTokens(dict):
    """word -> its ids' bytes; a word that is missing is taken from an older generation or encoded."""

    def __init__(self, tokenizer, old: dict[str, bytes]) -> None:
        super().__init__()
        self.tokenizer, self.model, self.old = tokenizer, tokenizer.model, old

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:  # ASCII words are their own byte-level form, so the model takes them directly
            ids = [t.id for t in self.model.tokenize(word)] if word.isascii() else self.tokenizer.encode(word, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = found
        return found


class TokenBytes:
    """text -> its ids as little-endian 32-bit bytes, equal to the tokenizer's on the whole text.

    The tokenizer splits a text into words and encodes each by itself, so the
    ids of a word are kept.  Texts outside the plain range, or that may hold a
    special token, go to the tokenizer as a whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = WordTokens(self.tokenizer, {})

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if not _PLAIN.fullmatch(text) or "<|" in text:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes())
                continue
            if len(self.words) > CACHE_WORDS:  # a new generation begins; words still in use come over from the last
                self.words = WordTokens(self.tokenizer, dict(self.words))
            out.append(b"".join(map(self.words.__getitem__, _SPLIT.findall(text.lower()))))
        return out


_encoders: dict[str, TokenBytes] = {}


def _cut(path: str, window: int, with_ids: bool):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _encoders:
            _encoders[path] = TokenBytes(path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for b in batches(it, 128):
            rows: list[tuple] = []
            texts = [t or "" for t in b.column(1).to_pylist()]
            for doc, ids in zip(b.column(0).to_pylist(), _encoders[path](texts), strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), total, *([np.frombuffer(piece, dtype="<u4").astype(np.int32)] * with_ids)))
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return run


class Capacities:
    """Segment tree over remaining capacity 0..size: counts open windows, finds the tightest that fits."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        k = capacity + self.leaves
        while k:
            self.count[k] += 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the least capacity >= need."""
        k = need + self.leaves
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):  # up, until something lies to the right
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        capacity = k - self.leaves
        window = self.windows[capacity].pop()
        while k:
            self.count[k] -= 1
            k >>= 1
        return capacity, window


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """(window number, offset) of each length; lengths are taken in the order given, which should not increase."""
    tree, at, offsets, opened = Capacities(window), [], [], 0
    for n in lengths:
        found = tree.take(n)
        capacity, number = found or (window, opened)
        opened += found is None
        at.append(number)
        offsets.append(window - capacity)
        if capacity > n:
            tree.put(capacity - n, number)
    return at, offsets


def _pack_group(window: int):
    def run(rests: pd.DataFrame) -> pd.DataFrame:
        rests = rests.sort_values(["length", "uid"], ascending=[False, True], kind="stable")
        at, offsets = best_fit(rests["length"].tolist(), window)
        return pd.DataFrame({"uid": rests["uid"], "sequence_id": (rests["grp"].to_numpy() << 32) + np.array(at, dtype=np.int64), "offset": np.array(offsets, dtype=np.int64)})

    return run


def pack(spark: SparkSession, documents: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most `window` tokens.

    tokenizer: path of a tokenizers file (the 49k word BPE by default).  Returns
    a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and with_ids the piece's ids.  A null text counts as empty and is
    the end id alone; a row without an id, or that repeats one, is packed like
    any other.  An empty table gives an empty result; other columns are ignored.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    ship(spark)
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = ", ids array<int>" if with_ids else ""
    pieces = docs.mapInArrow(_cut(tokenizer, window, with_ids), f"doc_id long, start long, length long, ids_crc32 long, doc_tokens long{ids}")
    pieces = stash(spark, pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    rests = pieces.where(F.col("length") < window).select("uid", "length")
    groups = max(1, math.ceil(rests.count() / GROUP_ROWS))
    rests = rests.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("long"))
    packed = rests.groupBy("grp").applyInPandas(_pack_group(window), "uid long, sequence_id long, offset long").withColumnRenamed("uid", "puid")
    full = pieces.where(F.col("length") == window).withColumn("sequence_id", F.col("uid") + F.lit(1 << 61)).withColumn("offset", F.lit(0).cast("long"))
    joined = pieces.where(F.col("length") < window).join(packed, F.col("uid") == F.col("puid")).drop("puid")
    return joined.unionByName(full).drop("uid")


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Pieces with ids -> sequence_id, ids, n_tokens: padded to the window, unless the length is a power of two."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    out = pieces.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
    n = F.size("ids")
    whole = n.bitwiseAND(n - 1) == 0
    return out.select("sequence_id", F.when(whole, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(window) - n))).alias("ids"), n.alias("n_tokens"))
