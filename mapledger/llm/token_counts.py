"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.llm.batches import slices, texts

# --- fixed value: how this kind of vocabulary cuts a text before merging ----
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ----------------------------------------------------------------------------

# pieces of texts remembered by a task; beyond, they are forgotten and counted anew
REMEMBERED = 400_000
_NO_RANK = np.int64(1) << 40
# marks the first piece of a text; a lone surrogate, which no text of a table can hold
_FIRST = "\ud800"
_MARKS = frozenset(",.;:!?")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    rest = iter(range(256, 512))
    return [chr(byte if byte in printable else next(rest)) for byte in range(256)]


class RankMerger:
    """Counts what is left of byte sequences when all merges of a vocabulary were applied."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        self.specials = [token["content"] for token in content["added_tokens"]]
        self.byte_ids = np.array([ids[c] for c in byte_characters()], np.int64)
        left, right = (np.array([ids[m[side]] for m in merges], np.int64) for side in (0, 1))
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        self._build_table(left << 20 | right, made)

    def _build_table(self, pairs: np.ndarray, made: np.ndarray) -> None:
        """An open-addressed table from pair to (rank, id of the merged symbol)."""
        self._bits = max(4, int(4 * len(pairs)).bit_length())
        size = 1 << self._bits
        self._keys, self._ranks, self._made = np.full(size, -1), np.full(size, _NO_RANK), np.zeros(size, np.int64)
        todo = np.arange(len(pairs))
        slot = self._slot(pairs)
        while len(todo):
            free = self._keys[slot[todo]] < 0
            taken, first = np.unique(slot[todo[free]], return_index=True)
            winner = todo[free][first]
            self._keys[taken], self._ranks[taken], self._made[taken] = pairs[winner], winner, made[winner]
            todo = np.setdiff1d(todo, winner, assume_unique=True)
            slot[todo] = (slot[todo] + 1) % size

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        spread = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self._bits)).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair; slots of unknown pairs have no rank."""
        pairs = left << 20 | right
        slot = self._slot(pairs)
        todo = np.flatnonzero((self._keys[slot] != pairs) & (self._keys[slot] >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % len(self._keys)
            found = self._keys[slot[todo]]
            todo = todo[(found != pairs[todo]) & (found >= 0)]
        return slot

    def count(self, words: list[bytes]) -> np.ndarray:
        """Symbols of each word after all merges.

        Every round applies to each word still at work its pair of lowest
        rank, at all places at once. A merged symbol only takes part in pairs
        of later rank, so this gives what one merge after the other would.
        """
        result = np.array([len(word) for word in words], np.int64)
        word = np.flatnonzero(result)
        lengths = result[word]
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(lengths) - 1
        slots = self._find(symbols, np.append(symbols[1:], 0))
        ranks = np.where(self._keys[slots] < 0, _NO_RANK, self._ranks[slots])
        ranks[ends] = _NO_RANK
        while len(word):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            at_work = lowest < _NO_RANK
            if not at_work.all():
                stays = np.repeat(at_work, lengths)
                symbols, ranks, slots = symbols[stays], ranks[stays], slots[stays]
                word, lengths, lowest = word[at_work], lengths[at_work], lowest[at_work]
                if not len(word):
                    break
            hits = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            # of places that overlap (x x x) every second one from the left counts
            run = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
            step = np.arange(len(hits)) - np.repeat(run, np.diff(run, append=len(hits)))
            hits = hits[step % 2 == 0]
            owner = np.searchsorted(np.cumsum(lengths), hits, side="right")
            symbols[hits] = self._made[slots[hits]]
            stays = np.ones(len(symbols), bool)
            stays[hits + 1] = False
            merged = np.bincount(owner, minlength=len(word))
            lengths = lengths - merged
            result[word] -= merged
            place = np.cumsum(stays) - 1
            symbols, ranks, slots, hits = symbols[stays], ranks[stays], slots[stays], place[hits]
            ends = np.cumsum(lengths) - 1
            touched = np.zeros(len(symbols), bool)
            touched[hits] = touched[hits - (hits > 0)] = True
            changed = np.flatnonzero(touched)
            slots[changed] = self._find(symbols[changed], symbols[np.minimum(changed + 1, len(symbols) - 1)])
            ranks[changed] = np.where(self._keys[slots[changed]] < 0, _NO_RANK, self._ranks[slots[changed]])
            ranks[ends] = _NO_RANK
        return result


@lru_cache(maxsize=4)
def merger(path: str) -> RankMerger:
    return RankMerger(path)


class TextCounter:
    """Counts tokens of whole texts and remembers the pieces it has met.

    A space before something that is no white space always begins a
    pre-token, so texts are first cut there, which is much faster than the
    whole pattern; only pieces not met before are cut by it.
    """

    def __init__(self, path: str) -> None:
        self.merger, self.known = merger(path), {}
        self.cut = regex.compile(PRE_TOKENS).findall
        self.spaced = re.compile(r" (?=\S)").split
        self.odd_space = re.compile(r" (?:\s|$)").search
        escaped = "|".join(regex.escape(s) for s in sorted(self.merger.specials, key=len, reverse=True))
        self.special = regex.compile(escaped) if escaped else None

    def _pieces(self, text: str) -> list[str]:
        """The pieces of a text, all but the first without the space before them.

        The first gets a mark, so that it isn't taken for one with a space.
        """
        pieces = self.spaced(text) if self.odd_space(text) else text.split(" ")
        pieces[0] = _FIRST + pieces[0]
        return pieces

    def count(self, batch: list[str]) -> list[int]:
        cut, extra = [], []
        for text in batch:
            parts = self.special.split(text) if self.special else [text]
            cut.append([piece for part in parts for piece in self._pieces(part)])
            extra.append(len(parts) - 1)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self._learn(list(set().union(*cut).difference(self.known)))
        known = self.known.__getitem__
        return [sum(map(known, pieces)) + n for pieces, n in zip(cut, extra, strict=True)]

    def _learn(self, pieces: list[str]) -> None:
        # letters, and letters before one mark, need no pattern: the mark is a token of its own
        known, marked, letters, other = self.known, [], set(), []
        for piece in pieces:
            if piece.isalpha():
                letters.add(piece)
            elif piece[-1] in _MARKS and piece[:-1].isalpha():
                marked.append(piece)
                letters.add(piece[:-1])
            else:
                other.append(piece)
        plain = list(letters.difference(known))
        counts = self.merger.count([b" " + word.encode() for word in plain])
        known.update(zip(plain, counts.tolist(), strict=True))
        for piece in marked:
            known[piece] = known[piece[:-1]] + 1
        words = [self.cut(piece[1:] if piece[:1] == _FIRST else " " + piece) for piece in other]
        owner = np.repeat(np.arange(len(other)), [len(w) for w in words])
        counts = self.merger.count([word.encode() for group in words for word in group])
        total = np.bincount(owner, weights=counts, minlength=len(other)).astype(np.int64)
        known.update(zip(other, total.tolist(), strict=True))


def count_tokens(documents: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """Add n_bytes, n_tokens and over_limit (more than `limit` tokens) to the ids of all documents.

    Whole texts are counted; a null text counts as empty, with no tokens.
    Each row is counted on its own: repeated rows, null ids and further
    columns change nothing. A special string inside a text is one token, as
    the vocabulary's own library has it.
    """
    schema = "doc_id BIGINT, n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TextCounter(path)
        for batch in slices(batches, "text"):
            whole = texts(batch, "text")
            n = counter.count(whole)
            columns = [batch.column("doc_id"), [len(t.encode()) for t in whole], n, [k > limit for k in n]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) if isinstance(c, list) else c.cast(k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return documents.select("doc_id", F.col(text).alias("text")).mapInArrow(counted, schema)
