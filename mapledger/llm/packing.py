"""Tokenised documents packed into sequences by the sum-of-squares rule."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mapledger.llm.batches import slices
from mapledger.llm.token_counts import byte_characters
from mapledger.session import stage

CAPACITY = 4096
# pieces of one group of packing; a task holds one group, of numbers only
GROUP_PIECES = 8192
# words whose ids a task remembers, about 250 bytes each; beyond, they are forgotten and encoded anew
REMEMBERED = 400_000
# of these, a Python worker keeps no more for its next task, which may be of another stage
KEPT = 100_000

# --- fixed value: how the vocabulary cuts a word, for Latin characters in lower case
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^a-z0-9ªµºß-öø-ÿ²³¹¼-¾]+").findall
# -----------------------------------------------------------------------------

# control characters and spaces that need the library's whole way
_ODD = re.compile(r"[\x00-\x20\x7f-\xa0\xad]").search

PIECES = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
PACKED = f"{PIECES}, sequence_id BIGINT, offset BIGINT"


class _Words(dict):
    """Ids of words, as little-endian unsigned 32-bit numbers; a new word is encoded when asked for.

    Words never share a token over white space. A word of the Latin-1
    characters is cut and put in lower case here, and only its parts go to
    the model; any other word takes the library's whole way.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.parts = self.tokenizer.model, {}
        specials = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(specials) or "(?!)").search
        self.as_characters = {byte: ord(c) for byte, c in enumerate(byte_characters())}

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if max(text) > "\u00ff" or _ODD(text) or self.special(text):
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        elif text.isalpha():
            ids = self._part(text.lower())
        else:
            ids = b"".join([self._part(part) for part in _PARTS(text.lower())])
        self[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            characters = part if part.isascii() else part.encode().decode("latin-1").translate(self.as_characters)
            found = [token.id for token in self.model.tokenize(characters)]
            ids = self.parts[part] = struct.pack(f"<{len(found)}I", *found)
        return ids


@lru_cache(maxsize=1)
def _words(path: str) -> _Words:
    """Kept by a Python worker over its tasks."""
    return _Words(path)


def _forget(path: str, most: int) -> None:
    known = _words(path)
    if len(known) + len(known.parts) > most:
        known.clear()
        known.parts.clear()


def encode(path: str, batch: list[bytes]) -> list[bytes]:
    """The ids of each text, as bytes of little-endian unsigned 32-bit numbers."""
    _forget(path, REMEMBERED)
    find = _words(path).__getitem__
    return [b"".join(map(find, text.split())) for text in batch]  # bytes split at ASCII white space


def token_pieces(documents: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut only where longer than `capacity`.

    A null text counts as empty: one piece of the end id alone.
    """
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            whole = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(path, whole), strict=True):
                ids += end
                for n, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
        _forget(path, KEPT)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, by the sum-of-squares rule in the given order.

    With n[g] open bins of gap g, an item goes where the sum of n[g]^2 is
    smallest afterwards: into an open bin, or a new one. Closed bins (gap 0)
    don't count. Ties go to the smallest gap.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = np.zeros(capacity + 1, np.int64)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        # the change of the sum when gap g becomes g - size; a closed bin adds no term
        change = 2 * (n[: capacity - size + 1] - n[size:] + 1)
        change[0] = 1 - 2 * n[size]
        change[n[size:] == 0] = capacity << 32
        best = int(np.argmin(change))
        gap = best + size
        new = 2 * n[capacity - size] + 1 if size < capacity else 0
        if n[gap] and change[best] <= new:
            chosen = open_bins[gap].pop()
            n[gap] -= 1
        else:
            chosen, gap = made, capacity
            made += 1
        bins[i], offsets[i] = chosen, capacity - gap
        if gap > size:
            open_bins[gap - size].append(chosen)
            n[gap - size] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    Pieces are dealt evenly, by a hash of their content, to groups of about
    `group_pieces`, and each group is packed on its own, so no task sees more
    at any size of the input. Longest pieces go first: the small ones then
    fill the gaps, and a group leaves few bins open.
    """
    pieces = stage(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "start"), F.lit(groups)).cast("int")
    # full pieces share no sequence, so they need no group
    full = pieces.where(F.col("length") == capacity).select(
        "*", (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )

    def packed(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=(int(group[0]) << 32) + bins, offset=offsets).drop(columns="pack_group")

    rest = pieces.where(F.col("length") < capacity).withColumn("pack_group", key)
    return rest.groupBy("pack_group").applyInPandas(packed, PACKED).unionByName(full)


def pack_documents(
    documents: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """All documents tokenised, cut where longer than a sequence, and packed.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id
    and offset. A null or empty text is one piece, the end id alone. Repeated
    rows are packed each for itself, rows with a null id likewise; an empty
    table gives no rows; further columns are ignored.
    """
    return pack(token_pieces(documents, path, end_id, capacity), capacity, group_pieces)
