"""Alignment of two tokenizers' tokens over the same bytes of a text.

The libraries' spans are the coarse cuts: characters from a byte-level
vocabulary (A), bytes from a piece vocabulary (B). Where several tokens share a
character (parts of a multibyte character, fallback bytes), the decoded bytes
of the tokens say where each one ends.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapledger.llm.batches import slices, texts
from mapledger.llm.token_counts import byte_characters
from mapledger.session import stage

# bytes of text in one block of documents
BLOCK_BYTES = 3 << 20
# words remembered by a task; beyond, they are forgotten and aligned anew
REMEMBERED = 200_000
# words aligned at once
_BATCH = 20_000
# words encoded as one text
_SIDE_BY_SIDE = 1000
_B_BITS = 20
_SPACE = "▁"
_FALLBACK = re.compile("<0x([0-9A-F]{2})>")
# a space before something that is none and behind something that is none
_PLAIN = re.compile(r" \S(?:.*[^ ])?", re.DOTALL).fullmatch
_CUT = re.compile(r"(?<=[^ ]) (?=\S)")


class Vocabularies:
    """Both tokenizers, and the bytes that each id stands for."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {character: byte for byte, character in enumerate(byte_characters())}
        with open(a_path, encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"]
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.a_bytes[number] = bytes(byte_of[character] for character in entry)
        pieces = [self.b.id_to_piece(n) for n in range(self.b.vocab_size())]
        fallback = [_FALLBACK.fullmatch(piece) if self.b.is_byte(n) else None for n, piece in enumerate(pieces)]
        self.b_bytes = [
            bytes([int(byte.group(1), 16)]) if byte else piece.replace(_SPACE, " ").encode()
            for piece, byte in zip(pieces, fallback, strict=True)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(b) for b in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = _names(len(self.a_bytes), ",|"), _names(len(self.b_bytes), ",;\n")
        # a piece never holds a space behind something else: then no piece reaches over a cut
        self.cuts = not any(" " in piece.lstrip(" ") for piece in (b.decode("utf-8", "replace") for b in self.b_bytes))

    def words(self, text: str) -> list[str]:
        """Pieces of space+text, each beginning with a space, that both tokenizers treat on their own."""
        if not self.cuts:
            return [" " + text]
        parts = _CUT.split(" " + text)
        return [parts[0], *(" " + part for part in parts[1:])]

    def spans(self, words: list[str]) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...]:
        """(ids, ends, tokens of each word) of A and of B; an end counts bytes from the word's first one.

        Where joined bytes differ from the word, its ends mean nothing.
        """
        a = self.a.encode_batch(words, add_special_tokens=False)
        b = self.b.encode([word[1:] for word in words], return_type="offset_mapping", return_bytes=True, num_threads=1)
        found = []
        for ids, offsets, sizes, shift in (
            ([one.ids for one in a], [one.offsets for one in a], self.a_sizes, 0),
            # B's spans leave out the space that it adds
            ([one["ids"] for one in b], [one["offsets"] for one in b], self.b_sizes, 1),
        ):
            lengths = np.array([len(one) for one in ids], np.int64)
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(lengths.sum()))
            places = np.fromiter(chain.from_iterable(chain.from_iterable(offsets)), np.int64, 2 * len(flat)).reshape(-1, 2) + shift
            if shift == 0:
                places = _as_bytes(words, places, lengths)
            found.append((flat, _ends(places, sizes[flat], lengths), lengths))
        return tuple(found)

    def sound(self, words: list[str], a: tuple, b: tuple) -> np.ndarray:
        """Whether the joined bytes of both tokenizations are those of each word."""
        whole = [word.encode("utf-8", "surrogatepass") for word in words]
        sizes = np.array([len(one) for one in whole], np.int64)
        good = np.ones(len(words), bool)
        for (ids, _, lengths), table, widths in ((a, self.a_bytes, self.a_sizes), (b, self.b_bytes, self.b_sizes)):
            joined = b"".join(map(table.__getitem__, ids.tolist()))
            if joined == b"".join(whole) and (_summed(widths[ids], lengths) == sizes).all():
                continue
            stops = np.cumsum(lengths)
            for n, (start, stop) in enumerate(zip(stops - lengths, stops, strict=True)):
                good[n] &= b"".join(table[i] for i in ids[start:stop].tolist()) == whole[n]
        return good


def _as_bytes(words: list[str], places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Character places as byte places within each word."""
    if all(map(str.isascii, words)):
        return places
    characters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    width = 1 + (characters > 0x7F) + (characters > 0x7FF) + (characters > 0xFFFF)
    before = np.concatenate([[0], np.cumsum(width)])
    starts = np.cumsum([0, *(len(word) for word in words)])[:-1]
    first = np.repeat(starts, lengths)[:, None]
    return before[places + first] - before[first]


def _summed(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    stops = np.cumsum(lengths)
    return total[stops] - total[stops - lengths]


def _ends(places: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each token ends: at the end of its span, or, if it shares a character with its neighbour, by decoded bytes."""
    if not len(places):
        return np.zeros(0, np.int64)
    n = np.arange(len(places))
    last = np.cumsum(lengths) - 1
    filled = lengths > 0
    # bytes from the word's start, if all tokens are what they decode to
    total = np.cumsum(sizes)
    decoded = total - np.repeat((total - sizes)[(last - lengths + 1)[filled]], lengths[filled])
    following = np.append(places[1:, 0], 0)
    certain = (places[:, 1] > places[:, 0]) & (following >= places[:, 1])
    certain[1:] &= places[1:, 0] >= places[:-1, 1]
    # a token whose neighbour before it ends at the same place holds only part of its character
    certain[1:] &= places[1:, 1] != places[:-1, 1]
    certain[last[filled]] = True
    first = np.zeros(len(places), bool)
    first[(last - lengths + 1)[filled]] = True
    anchor = np.maximum.accumulate(np.where(certain | first, n, 0))
    # from the last certain cut on, decoded bytes count; before any, from the word's start
    drift = np.where(certain, places[:, 1] - decoded, 0)
    return decoded + drift[anchor]


class Aligner:
    """Aligns texts word by word and remembers the words it has met."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.vocabularies = _vocabularies(a_path, b_path)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.groups: list[str] = []
        # n_a, n_b, n_groups, n_links of each word; a word whose bytes differ has n_a of -1
        self.sizes = np.zeros((0, 4), np.int64)
        # the links of all words one after the other, pairs of ids in one number, and where those of each word begin
        self.links, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, words: list[str]) -> None:
        """Align new words."""
        sizes, links = [self.sizes], [self.links]
        words = sorted(words, key=lambda word: _PLAIN(word) is None)
        for start in range(0, len(words), _BATCH):
            some = words[start : start + _BATCH]
            of_words, groups, found = align(self.vocabularies, some)
            self.numbers.update(zip(some, range(len(self.groups), len(self.groups) + len(some)), strict=True))
            self.groups += groups
            sizes.append(of_words)
            links.append(found)
        self.sizes, self.links = np.concatenate(sizes), np.concatenate(links)
        self.starts = np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3]

    def links_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links of some words one after the other, and how many each has."""
        n = self.sizes[numbers, 3]
        first = np.repeat(self.starts[numbers] - (np.cumsum(n) - n), n)
        return self.links[first + np.arange(len(first))], n

    def documents(self, batch: list[str]) -> list[np.ndarray]:
        """Numbers of the words of each text; none where the text has no tokens."""
        if len(self.numbers) > REMEMBERED:
            self.forget()
        cut = [self.vocabularies.words(text) if text else [] for text in batch]
        self.learn(list(set().union(*cut).difference(self.numbers)))
        found = [np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)) for words in cut]
        for n, numbers in enumerate(found):
            if (self.sizes[numbers, 0] < 0).any():
                # differences of words might make up for each other: the whole text decides
                whole = " " + batch[n]
                if whole not in self.numbers:
                    self.learn([whole])
                number = self.numbers[whole]
                found[n] = np.array([number] if self.sizes[number, 0] >= 0 else [], np.int64)
        return found


@lru_cache(maxsize=2)
def _vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def align(vocabularies: Vocabularies, words: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(n_a, n_b, n_groups, n_links) and groups of each word, and the links of all words one after the other.

    Between two neighbouring cuts of either tokenizer lies one pair of
    tokens that overlap, so the links are read at the union of the cuts.
    """
    widths = np.array([len(word.encode("utf-8", "surrogatepass")) for word in words], np.int64)
    side_by_side = _joined(vocabularies, words, np.cumsum(widths))
    if side_by_side:
        good = np.ones(len(words), bool)
        (a_ids, a_at, a_n), (b_ids, b_at, b_n) = side_by_side
    else:
        a, b = vocabularies.spans(words)
        good = vocabularies.sound(words, a, b)
        widths = widths * good
        (a_ids, a_ends, a_n), (b_ids, b_ends, b_n) = (_only(side, good) for side in (a, b))
        base = np.cumsum(widths) - widths
        a_at, b_at = a_ends + np.repeat(base, a_n), b_ends + np.repeat(base, b_n)
    cuts, common = np.union1d(a_at, b_at), np.intersect1d(a_at, b_at, assume_unique=True)
    links = a_ids[np.searchsorted(a_at, cuts)] << _B_BITS | b_ids[np.searchsorted(b_at, cuts)]
    stops = np.cumsum(widths)
    n_links, n_groups = (np.diff(np.searchsorted(at, stops, side="right"), prepend=0) for at in (cuts, common))
    sizes = np.stack([np.where(good, a_n, -1), b_n, n_groups, n_links], axis=1)
    return sizes, _written(vocabularies, (a_ids, a_at), (b_ids, b_at), common, stops, n_groups), links


def _joined(vocabularies: Vocabularies, words: list[str], stops: np.ndarray) -> list[tuple] | None:
    """(ids, ends in bytes from the first word on, tokens of each word) of A and B from words encoded side by side.

    Words that begin with one space and don't end with any are cut apart by
    both tokenizers, so many are encoded as one text. None if some word isn't
    like that, or the tokens don't stop at each word or hold other bytes.
    """
    if not vocabularies.cuts or not all(_PLAIN(word) for word in words):
        return None
    parts = ["".join(words[start : start + _SIDE_BY_SIDE]) for start in range(0, len(words), _SIDE_BY_SIDE)]
    sides = vocabularies.spans(parts)
    if not vocabularies.sound(parts, *sides).all():
        return None
    base = np.concatenate([[0], stops[_SIDE_BY_SIDE - 1 :: _SIDE_BY_SIDE]])[: len(parts)]
    found = []
    for ids, ends, lengths in sides:
        at = ends + np.repeat(base, lengths)
        place = np.searchsorted(at, stops)
        if place.max(initial=-1) >= len(at) or (at[place] != stops).any():
            return None
        found.append((ids, at, np.diff(place + 1, prepend=0)))
    return found


def _only(side: tuple, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, ends, lengths = side
    if good.all():
        return side
    kept = np.repeat(good, lengths)
    return ids[kept], ends[kept], lengths * good


def _written(vocabularies: Vocabularies, a: tuple, b: tuple, common: np.ndarray, stops: np.ndarray, n_groups: np.ndarray) -> list[str]:
    """The groups of each word as `a1,a2|b1;a3|b2,b3`."""
    of_group, names = [], []
    for (ids, ends), table in ((a, vocabularies.a_names), (b, vocabularies.b_names)):
        group = np.searchsorted(common, ends)
        closes = common[group] == ends if len(ids) else np.zeros(0, bool)
        # a name with what follows it: another one of its group, the other side, a group, or a word
        kind = closes.astype(np.int64)
        if table is vocabularies.b_names:
            kind += closes & np.isin(ends, stops)
        of_group.append(group)
        names.append(table[ids, kind])
    sides = np.repeat([0, 1], [len(one) for one in names])
    order = np.argsort(np.concatenate(of_group) * 2 + sides, kind="stable")
    written = iter("".join(np.concatenate(names)[order].tolist()).split("\n"))
    return [next(written) if n else "" for n in n_groups.tolist()]


def _names(n: int, marks: str) -> np.ndarray:
    """Each number as text, followed by each of the marks."""
    return np.array([[f"{number}{mark}" for mark in marks] for number in range(n)], object)


# --- operators ------------------------------------------------------------

_BLOCKS = (
    "block STRING, doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, groups_sha256 STRING,"
    " words BINARY, word_links BINARY, links ARRAY<BIGINT>, n ARRAY<BIGINT>"
)
_COUNTS = (
    "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, count_sum BIGINT, groups_sha256 STRING"
)
_DIGEST = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[field.name], field.type) for field in schema], schema=schema)


_BLOCK_SCHEMA = pa.schema(
    [("block", pa.string()), ("doc_id", pa.int64()), *((name, pa.int64()) for name in _DIGEST[1:5]), ("groups_sha256", pa.string()),
     ("words", pa.binary()), ("word_links", pa.binary()), ("links", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))]
)
_COUNT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), *((name, pa.int64()) for name in _DIGEST[1:5]), ("n_best", pa.int64()), ("count_sum", pa.int64()),
     ("groups_sha256", pa.string())]
)


def _aligned_blocks(a_path: str, b_path: str, block_bytes: int):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in slices(batches, "text", block_bytes):
            found = aligner.documents(texts(batch, "text"))
            block = uuid.uuid4().hex
            lengths = np.array([len(numbers) for numbers in found], np.int64)
            used, at, times = np.unique(
                np.concatenate([*found, np.zeros(0, np.int64)]), return_inverse=True, return_counts=True
            )
            totals = np.stack([_summed(column[used][at], lengths) for column in aligner.sizes.T], axis=1)
            stops = np.cumsum(lengths)
            at = at.astype("<u4")
            text_of = aligner.groups.__getitem__
            digests = [
                hashlib.sha256(";".join(map(text_of, numbers.tolist())).encode()).hexdigest() if len(numbers) else "" for numbers in found
            ]
            empty = [None] * batch.num_rows
            yield _batch(
                {
                    "block": [block] * batch.num_rows, "doc_id": batch.column("doc_id").to_pylist(),
                    **dict(zip(_DIGEST[1:5], totals.T, strict=True)), "groups_sha256": digests,
                    "words": [at[start:stop].tobytes() for start, stop in zip(stops - lengths, stops, strict=True)],
                    "word_links": empty, "links": empty, "n": empty,
                },
                _BLOCK_SCHEMA,
            )
            # what the block's words are made of: each word's links by their place among the block's distinct ones
            of_words, n = aligner.links_of(used)
            links, place = np.unique(of_words, return_inverse=True)
            counts = np.bincount(place, np.repeat(times, n), len(links)).astype(np.int64)
            row = dict.fromkeys(_BLOCK_SCHEMA.names)
            row |= {
                "block": block, "words": n.astype("<u4").tobytes(), "word_links": place.astype("<u4").tobytes(), "links": links, "n": counts,
            }
            yield _batch({name: [value] for name, value in row.items()}, _BLOCK_SCHEMA)

    return aligned


def _counted(key: tuple, blocks: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block, from the corpus-wide counts of its distinct links."""
    is_table = np.array(blocks.column("word_links").is_valid())
    documents, table = blocks.filter(pa.array(~is_table)), blocks.filter(pa.array(is_table))
    place = pairs.column("place").to_numpy()
    values = np.zeros((2, len(place)), np.int64)
    values[0, place], values[1, place] = pairs.column("count").to_numpy(), pairs.column("best").to_numpy()
    n = np.frombuffer(table.column("words")[0].as_py(), "<u4").astype(np.int64)
    link = np.frombuffer(table.column("word_links")[0].as_py(), "<u4")
    of_word = np.stack([_summed(one[link], n) for one in values])
    words = documents.column("words").to_pylist()
    lengths = np.array([len(one) // 4 for one in words], np.int64)
    at = np.frombuffer(b"".join(words), "<u4")
    count_sum, n_best = (_summed(one[at], lengths) for one in of_word)
    columns = {name: documents.column(name).combine_chunks() for name in _DIGEST}
    columns |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
    return pa.Table.from_arrays([columns[field.name] for field in _COUNT_SCHEMA], schema=_COUNT_SCHEMA)


def count_links(documents: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row of (doc_id, text).

    A block of documents is aligned once and written with its distinct links
    and their counts; only these are summed over the corpus and come back to
    the block, so what is shuffled grows with the distinct links of a block
    and a frequent link costs one row for each. Null and empty texts, and
    those whose tokens' joined bytes differ from space+text, have no tokens:
    zeros and an empty digest. Texts are aligned whole; a repeated row counts
    again in the corpus; of links counted alike all are the highest; null ids
    and further columns change nothing; an empty table gives no rows.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = stage(rows.mapInArrow(_aligned_blocks(a_path, b_path, block_bytes), _BLOCKS), "blocks")
    tables = blocks.where(F.col("links").isNotNull()).select("block", F.posexplode(F.arrays_zip("links", "n")).alias("place", "one"))
    pairs = tables.select("block", "place", F.col("one.links").alias("link"), F.col("one.n").alias("n"))
    counts = pairs.groupBy("link").agg(F.sum("n").alias("count")).withColumn("b_id", F.col("link").bitwiseAND((1 << _B_BITS) - 1))
    highest = Window.partitionBy("b_id")
    counts = counts.select("link", "count", (F.col("count") == F.max("count").over(highest)).cast("int").alias("best"))
    back = pairs.join(counts, "link").select(F.col("block").alias("of"), "place", "count", "best")
    return blocks.drop("links", "n").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_counted, _COUNTS)


def token_groups(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, ordinal, start, end, a_ids and b_ids of every group of every text: bytes of space+text between common cuts.

    Texts without tokens have no groups.
    """

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        sizes = aligner.vocabularies.a_sizes
        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            found = aligner.documents(texts(batch, "text"))
            for doc_id, numbers in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                start = 0
                written = (group for number in numbers.tolist() for group in aligner.groups[number].split(";"))
                for ordinal, group in enumerate(written):
                    a, b = ([int(n) for n in side.split(",")] for side in group.split("|"))
                    end = start + int(sizes[a].sum())
                    rows.append((doc_id, ordinal, start, end, a, b))
                    start = end
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ordinal", "start", "end", "a_ids", "b_ids"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        grouped, "doc_id BIGINT, ordinal BIGINT, start BIGINT, end BIGINT, a_ids ARRAY<INT>, b_ids ARRAY<INT>"
    )
