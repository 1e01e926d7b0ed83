"""Texts scored by prediction by partial matching over bytes, learned from the corpus.

A text is its words and one end; a word is its bytes and one stop. A byte is
predicted from the ORDER symbols before it in its text, over stops into the
words before (`score_texts`), or from those in its word only, with the start
of the word as a context of its own (`score_documents`). In a context seen T times with
D different symbols, a symbol seen n times has probability n / (T + D), and
D / (T + D) is left to escape to the next shorter context, where the symbols
of the longer one are excluded. Beyond the empty context all symbols left are
equally likely.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.llm.batches import slices
from mapledger.session import stage

ORDER = 6
SYMBOLS = 257  # bytes, of which the space stands for the stop of a word, and the end of a text
END, START = 256, 257
_BITS = 9

# bytes of text that share one list of words; words of one part of the vocabulary
BLOCK_BYTES = 32 << 20
PART_WORDS = 100_000
# the same for texts whose every symbol is held; bytes of all texts to a part of their grams
TEXT_BLOCK_BYTES = 10 << 20
PART_BYTES = 6 << 20

_BLOCKS = "block BIGINT, doc_id BIGINT, held_out BOOLEAN, ids BINARY, word BINARY, number INT, n BIGINT"


class _Block:
    """Texts as numbers of their words, and the words with their count in training texts.

    Words are numbered as they come; only numbers are held of a text.
    """

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.rows: list[tuple[int | None, bool, np.ndarray]] = []
        self.size = 0

    def add(self, doc_id: int | None, held_out: bool, text: bytes) -> None:
        words, number = text.split(), self.numbers.setdefault
        own = np.fromiter((number(word, len(self.numbers)) for word in words), np.uint32, len(words))
        self.rows.append((doc_id, held_out, own))
        self.size += len(text)

    def batch(self, block: int) -> pa.RecordBatch:
        n, m = len(self.rows), len(self.numbers)
        counted, learned = np.zeros(m, np.int64), np.zeros(m, np.int64)
        for _, held_out, own in self.rows:
            np.add.at(counted, own, 1)
            if not held_out:
                np.add.at(learned, own, 1)
        # frequent words get small numbers, which pack well
        order = np.argsort(-counted, kind="stable")
        place = np.empty(m, "<u4")
        place[order] = np.arange(m, dtype=np.uint32)
        ids = [zlib.compress(place[own].tobytes(), 1) for _, _, own in self.rows]
        columns = [
            pa.array(np.full(n + m, block, np.int64)),
            pa.array([row[0] for row in self.rows] + [None] * m, pa.int64()),
            pa.array([row[1] for row in self.rows] + [None] * m, pa.bool_()),
            pa.array(ids + [None] * m, pa.binary()),
            pa.array([None] * n + list(self.numbers), pa.binary()),
            pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(place.astype(np.int32))]),
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(learned)]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "held_out", "ids", "word", "number", "n"])


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, made = _Block(), TaskContext.get().partitionId() << 32
    for batch in slices(batches, "text"):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for row in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts, strict=True):
            block.add(row[0], row[1], (row[2] or b"").lower())
        if block.size >= BLOCK_BYTES:
            yield block.batch(made)
            block, made = _Block(), made + 1
    if block.rows:
        yield block.batch(made)


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word, gram) of every symbol of some words: the context of ORDER symbols and the symbol, nine bits each."""
    joined = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    owner = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(joined)) + ORDER * (owner + 1)
    padded = np.full(len(joined) + ORDER * len(words), START, np.int64)
    padded[at] = joined
    value = np.zeros(len(joined), np.int64)
    for k in range(ORDER, -1, -1):
        value = value << _BITS | padded[at - k]
    return owner, value


def end_gram() -> int:
    value = 0
    for _ in range(ORDER):
        value = value << _BITS | START
    return value << _BITS | END


def _key(gram: np.ndarray, order: int) -> np.ndarray:
    """Symbol with its context of that order."""
    return gram & ((1 << _BITS * (order + 1)) - 1)


class _Counts:
    """Symbols seen in the contexts of one order; `where` has the place of each given key."""

    def __init__(self, key: np.ndarray, n: np.ndarray) -> None:
        self.key, self.where = np.unique(key, return_inverse=True)
        self.n = np.bincount(self.where, n, len(self.key))
        context = self.key >> _BITS  # ascending, too
        first = np.diff(context, prepend=-1) != 0
        self.context, self.owner = context[first], np.cumsum(first) - 1
        self.total = np.bincount(self.owner, self.n, len(self.context))
        self.kinds = np.bincount(self.owner, minlength=len(self.context)).astype(np.float64)

    def of(self, key: np.ndarray) -> np.ndarray:
        """How often a symbol was seen in its context."""
        return _looked_up(self.key, self.n, key)


def _looked_up(keys: np.ndarray, values: np.ndarray, key: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(key))
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[at] == key, values[at], 0.0)


def gram_scores(gram: np.ndarray, n: np.ndarray, low: dict[int, _Counts], least: int) -> np.ndarray:
    """log10 probability of each gram's symbol in its context.

    `gram` and `n` hold all grams that share their last `least` symbols of
    context; `low` has the counts of the shorter orders.
    """
    orders, excluded = dict(low), {}  # for each context, how often its symbols were seen in the next shorter one
    key, seen = gram[n > 0], n[n > 0]
    for k in range(ORDER, 0, -1):
        if k >= least:
            orders[k] = _Counts(_key(key, k), seen)
            key, seen = orders[k].key, orders[k].n
        if ORDER > k >= least:  # each key of the longer order has its place in this one
            below = orders[k].n[orders[k].where]
            excluded[k + 1] = np.bincount(orders[k + 1].owner, below, len(orders[k + 1].context))
    for k in range(least, 0, -1):
        excluded[k] = np.bincount(orders[k].owner, orders[k - 1].of(_key(orders[k].key, k - 1)), len(orders[k].context))
    score, todo = np.zeros(len(gram)), np.arange(len(gram))
    out_n, out_kinds = np.zeros(len(gram)), np.zeros(len(gram))  # excluded here
    for k in range(ORDER, -1, -1):
        counts, key = orders[k], _key(gram[todo], k)
        context = key >> _BITS
        kinds = _looked_up(counts.context, counts.kinds, context)
        total = _looked_up(counts.context, counts.total, context) - out_n
        left = kinds - out_kinds
        own = counts.of(key)
        hit, escape = own > 0, (own == 0) & (left > 0)
        score[todo[hit]] += np.log10(own[hit] / (total + left)[hit])
        score[todo[escape]] += np.log10(left[escape] / (total + left)[escape])
        todo, out_kinds = todo[~hit], kinds[~hit]
        if k:
            out_n = _looked_up(counts.context, excluded[k], context[~hit])
    score[todo] -= np.log10(np.maximum(1, SYMBOLS - out_kinds))
    return score


def _scored_vocabulary(words: DataFrame, train_texts: int) -> DataFrame:
    """Add `logp` to distinct words (word, c), and a row with a null word for the end of a text."""
    spark = words.sparkSession
    parts = max(1, -(-words.count() // PART_WORDS))
    words = words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)))

    def counted(table: pa.Table) -> pa.Table:
        group, n = table.column("word").to_pylist(), table.column("c").to_numpy()
        owner, value = grams(group)
        found, where = np.unique(value, return_inverse=True)
        total = np.bincount(where, n[owner], len(found)).astype(np.int64)
        part = np.full(len(found), table.column("part")[0].as_py(), np.int64)
        return pa.table({"part": part, "gram": found, "n": total})

    by_part = words.groupBy("part").applyInArrow(counted, "part BIGINT, gram BIGINT, n BIGINT")
    end = spark.range(1).select(F.lit(-1).cast("bigint").alias("part"), F.lit(end_gram()).alias("gram"), F.lit(train_texts).cast("bigint").alias("n"))
    by_part = stage(by_part.unionByName(end), "grams")
    total = stage(by_part.groupBy("gram").agg(F.sum("n").alias("n")), "gram-counts")

    # the two lowest orders have at most 258 * 257 rows, of any corpus
    mask = (1 << 2 * _BITS) - 1
    pairs = total.where("n > 0").groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("n")).toPandas()
    pairs = pairs.astype({"key": np.int64, "n": np.float64})
    low = {1: _Counts(pairs["key"].to_numpy(), pairs["n"].to_numpy()), 0: _Counts(_key(pairs["key"].to_numpy(), 0), pairs["n"].to_numpy())}

    def scored(table: pa.Table) -> pa.Table:
        gram, n = table.column("gram").to_numpy(), table.column("n").to_numpy().astype(np.float64)
        return pa.table({"gram": gram, "logp": gram_scores(gram, n, low, 2)})

    # grams of one context of two symbols have all their longer contexts in one place
    shared = F.shiftright("gram", _BITS).bitwiseAND(F.lit((1 << 2 * _BITS) - 1))
    scores = total.withColumn("context", shared).groupBy("context").applyInArrow(scored, "gram BIGINT, logp DOUBLE")
    scores = stage(scores, "gram-scores")

    def spelled(words: pa.Table, table: pa.Table) -> pa.Table:
        group = words.column("word").to_pylist()
        owner, value = grams(group) if group else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        gram, logp = table.column("gram").to_numpy(), table.column("logp").to_numpy()
        order = np.argsort(gram)
        per = logp[order][np.searchsorted(gram[order], value)] if len(value) else np.zeros(0)
        return pa.table({"word": pa.array(group, pa.binary()), "c": words.column("c"), "logp": np.bincount(owner, per, len(group))})

    needed = by_part.where("part >= 0").select("part", "gram").join(scores, "gram")
    of_words = words.groupBy("part").cogroup(needed.groupBy("part")).applyInArrow(spelled, "word BINARY, c BIGINT, logp DOUBLE")
    of_end = scores.where(F.col("gram") == end_gram()).select(
        F.lit(None).cast("binary").alias("word"), F.lit(train_texts).cast("bigint").alias("c"), "logp"
    )
    return of_words.unionByName(of_end)


def score_documents(documents: DataFrame, parts: int = 7, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Learns from the rows whose crc32(doc_id as text) mod `parts` isn't
    `held_out`; a null id is never held out. A-Z count as a-z. `score` is the
    model's log10 probability of the text as its words and one end;
    `base_score` that of single tokens with add-one smoothing. A null text
    counts as empty: the end alone. Repeated rows are scored alike, and
    counted each; an empty table gives no rows; further columns are ignored.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(remainder == held_out, F.lit(False)).alias("held_out")
    )
    # a block's texts and words are written together, by one task
    blocks = stage(rows.mapInArrow(_in_blocks, _BLOCKS), "blocks")
    in_block = blocks.where(F.col("word").isNotNull())
    texts = blocks.where(F.col("ids").isNotNull()).select("block", "doc_id", "held_out", "ids")
    train_texts = texts.where(~F.col("held_out")).count()
    words = stage(in_block.groupBy("word").agg(F.sum("n").alias("c")), "words")
    facts = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    total, distinct = facts[0] + train_texts, facts[1] + (train_texts > 0)
    vocabulary = stage(_scored_vocabulary(words, train_texts), "vocabulary")
    end = vocabulary.where(F.col("word").isNull()).first()
    end_score = end.logp if end else 0.0

    def scored(texts: pa.Table, table: pa.Table) -> pa.Table:
        number = table.column("number").to_numpy()
        c, logp = np.zeros(len(number)), np.zeros(len(number))
        c[number], logp[number] = table.column("c").to_numpy(), table.column("logp").to_numpy()
        base = np.log10((c + 1) / (total + distinct + 1))
        base_end = np.log10((train_texts + 1) / (total + distinct + 1))
        found: tuple[list, ...] = ([], [], [], [])
        for packed in texts.column("ids").to_pylist():
            ids = np.frombuffer(zlib.decompress(packed), "<u4")
            values = len(ids) + 1, int((c[ids] > 0).sum()) + (train_texts > 0), base[ids].sum() + base_end, logp[ids].sum() + end_score
            for column, value in zip(found, values, strict=True):
                column.append(value)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"),
                "n_tokens": pa.array(found[0], pa.int64()), "n_known": pa.array(found[1], pa.int64()),
                "train_tokens": pa.array([total] * len(found[0]), pa.int64()),
                "base_score": pa.array(found[2], pa.float64()), "score": pa.array(found[3], pa.float64()),
            }
        )

    values = in_block.select("block", "word", "number").join(vocabulary.where(F.col("word").isNotNull()), "word")
    schema = "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, base_score DOUBLE, score DOUBLE"
    values = values.select(F.col("block").alias("of_block"), "number", "c", "logp")
    both = texts.groupBy("block").cogroup(values.groupBy("of_block"))
    return both.applyInArrow(scored, schema)


# --- contexts over whole texts -----------------------------------------------

_TEXT_BLOCKS = (
    "block BIGINT, doc_ids ARRAY<BIGINT>, held_out ARRAY<BOOLEAN>, sizes ARRAY<BIGINT>, ids BINARY, words BINARY, learned BINARY, pairs BINARY, "
    "size BIGINT, train_words BIGINT, train_texts BIGINT"
)
_PARTS = "part BIGINT, block BIGINT, keys BINARY, n BINARY"
_RESULTS = "block BIGINT, kind STRING, part BIGINT, data BINARY, distinct BIGINT"
_PAIR = (1 << 2 * _BITS) - 1
_GRAMS_AT_ONCE = 1 << 19  # distinct grams whose symbols are summed at once


def _packed(values: np.ndarray) -> bytes:
    """Numbers by their first bytes, second bytes and so on, which packs well."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.frombuffer(np.ascontiguousarray(planes.T).tobytes(), kind)


def text_symbols(ids: np.ndarray, sizes: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, symbol) of texts given as numbers of words: ORDER starts, words with their stops, and the end of each."""
    table = np.concatenate([np.frombuffer(b"".join(w + b" " for w in words), np.uint8).astype(np.int16), np.full(ORDER, START, np.int16), [np.int16(END)]])
    lengths = np.array([*(len(w) + 1 for w in words), ORDER, 1], np.int64)
    starts = np.cumsum(lengths) - lengths
    ends = np.cumsum(sizes + 2)
    line = np.zeros(int(ends[-1]), np.int64)
    inner = np.ones(len(line), bool)
    inner[ends - 1] = inner[ends - sizes - 2] = False
    line[inner] = ids
    line[ends - sizes - 2], line[ends - 1] = len(words), len(words) + 1
    own = lengths[line]
    total = int(own.sum())
    number = np.int32 if max(total, len(table)) < 1 << 31 else np.int64  # half the memory for all blocks of usual texts
    place = np.repeat((starts[line] - (np.cumsum(own) - own)).astype(number), own)
    place += np.arange(total, dtype=number)
    symbols = table[place]
    return np.repeat(np.arange(len(sizes), dtype=np.int32), np.add.reduceat(own, ends - sizes - 2)), symbols


def text_grams(owner: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, gram) of every symbol but the starts: the ORDER symbols before it in its text and the symbol."""
    value = np.zeros(len(symbols), np.int64)
    for k in range(ORDER, -1, -1):
        value <<= _BITS
        value[k:] |= symbols[: len(symbols) - k]
    real = symbols != START
    owner = owner[real]
    return owner, value[real]


def _part_of(gram: np.ndarray, parts: int) -> np.ndarray:
    """Grams of one context of two symbols have all their longer contexts in one part."""
    return ((gram >> _BITS & _PAIR) * 0x9E3779B1 >> 7) % parts


class _TextBlock(_Block):
    def batch(self, block: int) -> pa.RecordBatch:
        held = np.array([row[1] for row in self.rows], bool)
        sizes = np.array([len(row[2]) for row in self.rows], np.int64)
        ids, words = np.concatenate([row[2] for row in self.rows]), list(self.numbers)
        # frequent words get small numbers, which pack well
        order = np.argsort(-np.bincount(ids, minlength=len(words)), kind="stable")
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        ids, words = place[ids], [words[i] for i in order]
        learned = np.bincount(ids[~np.repeat(held, sizes)], minlength=len(words)).astype(np.int64)
        owner, symbols = text_symbols(ids, sizes, words)
        real = (symbols[1:] != START) & ~held[owner[1:]]
        pairs = np.bincount((symbols[:-1].astype(np.int64) << _BITS | symbols[1:])[real], minlength=_PAIR + 1).astype(np.int64)
        row = {
            "block": block, "doc_ids": [r[0] for r in self.rows], "held_out": held.tolist(), "sizes": sizes.tolist(),
            "ids": _packed(ids), "words": zlib.compress(b" ".join(words), 1), "learned": _packed(learned), "pairs": _packed(pairs),
            "size": self.size, "train_words": int(learned.sum()), "train_texts": int((~held).sum()),
        }
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), *[pa.binary()] * 4, *[pa.int64()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], list(row))


def _in_text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, made = _TextBlock(), TaskContext.get().partitionId() << 32
    for batch in slices(batches, "text"):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for row in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts, strict=True):
            block.add(row[0], row[1], (row[2] or b"").lower())
        if block.size >= TEXT_BLOCK_BYTES:
            yield block.batch(made)
            block, made = _TextBlock(), made + 1
    if block.rows:
        yield block.batch(made)


def _is_first(sorted_values: np.ndarray) -> np.ndarray:
    first = np.ones(len(sorted_values), bool)
    np.not_equal(sorted_values[1:], sorted_values[:-1], out=first[1:])
    return first


def _grams_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    sizes, words = np.array(row["sizes"], np.int64), zlib.decompress(row["words"]).split()
    return text_grams(*text_symbols(_unpacked(row["ids"], "<u4"), sizes, words))


def _by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts in order, each with the places of its rows in order."""
    order = np.argsort(part, kind="stable")
    starts = np.flatnonzero(np.diff(part[order], prepend=-1))
    for own in np.split(order, starts[1:]) if len(order) else []:
        yield int(part[own[0]]), own


def _word_parts(words: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(word) % parts for word in words), np.int64, len(words))


def score_texts(documents: DataFrame, parts: int = 7, held_out: int = 2) -> DataFrame:
    """The columns of `score_documents`, with contexts that run on over the words of a text.

    Rows, edges and `base_score` are those of `score_documents`. Each block of
    texts sends its distinct grams, with their counts in training texts, to
    the parts of their contexts, and gets their scores back in the same order.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(remainder == held_out, F.lit(False)).alias("held_out")
    )
    blocks = stage(rows.mapInArrow(_in_text_blocks, _TEXT_BLOCKS), "text-blocks")
    facts = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("size", "train_words", "train_texts"))).first()
    into, train_texts, total = max(12, -(-facts[0] // PART_BYTES)), facts[2], facts[1] + facts[2]

    # the two lowest orders have at most 258 * 257 rows, of any corpus
    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("pairs").to_pylist():
                n = _unpacked(data, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0])], ["key", "n"])

    pairs = blocks.select("pairs").mapInArrow(pairs_of, "key BIGINT, n BIGINT").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    key, n = pairs["key"].to_numpy(np.int64), pairs["n"].to_numpy(np.float64)
    low = {1: _Counts(key, n), 0: _Counts(_key(key, 0), n)}

    def words_sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, learned = zlib.decompress(row["words"]).split(), _unpacked(row["learned"], "<i8")
                sent = [(p, row["block"], zlib.compress(b" ".join([words[i] for i in own]), 1), _packed(learned[own])) for p, own in _by_part(_word_parts(words, into))]
                yield _batch(sent, [pa.int64(), pa.int64(), pa.binary(), pa.binary()], ["part", "block", "keys", "n"])

    def words_counted(table: pa.Table) -> pa.Table:
        count: dict[bytes, int] = {}
        for keys, n in zip(table.column("keys").to_pylist(), table.column("n").to_pylist(), strict=True):
            for word, k in zip(zlib.decompress(keys).split(), _unpacked(n, "<i8").tolist(), strict=True):
                count[word] = count.get(word, 0) + k
        found = []
        for keys in table.column("keys").to_pylist():
            own = zlib.decompress(keys).split()
            found.append(_packed(np.fromiter((count[word] for word in own), np.int64, len(own))))
        distinct = [sum(k > 0 for k in count.values()), *[0] * (len(found) - 1)]
        return _results(table, "words", found, distinct)

    def grams_sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                owner, gram = _grams_of(row)
                gram = gram.view(np.uint64)
                gram <<= np.uint64(1)
                gram |= np.array(row["held_out"], np.uint8)[owner]
                del owner
                gram.sort()
                learned = (gram.astype(np.uint8) & 1) ^ 1
                gram >>= np.uint64(1)
                starts = np.flatnonzero(_is_first(gram))
                n, gram = np.add.reduceat(learned, starts, dtype="<u4"), gram.view(np.int64)[starts]
                del learned, starts
                for p, own in _by_part(_part_of(gram, into)):
                    yield _batch([(p, row["block"], _packed(gram[own]), _packed(n[own]))], [pa.int64(), pa.int64(), pa.binary(), pa.binary()], ["part", "block", "keys", "n"])

    def grams_scored(table: pa.Table) -> pa.Table:
        own = [_unpacked(keys, "<i8") for keys in table.column("keys").to_pylist()]
        every = np.concatenate(own)
        n = np.concatenate([_unpacked(n, "<u4") for n in table.column("n").to_pylist()])
        gram, where = np.unique(every, return_inverse=True)
        score = gram_scores(gram, np.bincount(where, n, len(gram)), low, 2)
        found = [zlib.compress(score[at].tobytes(), 1) for at in np.split(where, np.cumsum([len(x) for x in own])[:-1])]
        return _results(table, "grams", found, [0] * len(found))

    sent = blocks.select("block", "words", "learned").mapInArrow(words_sent, _PARTS)
    counted = stage(sent.groupBy("part").applyInArrow(words_counted, _RESULTS), "word-counts")
    distinct = counted.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0] + (train_texts > 0)
    sent = blocks.select("block", "held_out", "sizes", "ids", "words").mapInArrow(grams_sent, _PARTS)
    results = counted.unionByName(sent.groupBy("part").applyInArrow(grams_scored, _RESULTS)).withColumnRenamed("block", "of_block")

    def scored(table: pa.Table, results: pa.Table) -> pa.Table:
        data = {(r["kind"], r["part"]): r["data"] for r in results.select(["kind", "part", "data"]).to_pylist()}
        (row,) = table.to_pylist()
        sizes, words = np.array(row["sizes"], np.int64), zlib.decompress(row["words"]).split()
        c = np.zeros(len(words), np.int64)
        for p, own in _by_part(_word_parts(words, into)):
            c[own] = _unpacked(data["words", p], "<i8")
        ids, text = _unpacked(row["ids"], "<u4"), np.repeat(np.arange(len(sizes)), sizes)
        base = np.bincount(text, np.log10((c + 1) / (total + distinct + 1))[ids], len(sizes)) + np.log10((train_texts + 1) / (total + distinct + 1))
        known = np.bincount(text, (c > 0)[ids], len(sizes)).astype(np.int64) + (train_texts > 0)
        owner, gram = _grams_of(row)
        order = np.argsort(gram)
        gram = gram[order]
        owner = owner[order]
        del order
        first = _is_first(gram)
        gram = gram[first]  # what repeats is not held any more
        logp = np.zeros(len(gram))
        for p, own in _by_part(_part_of(gram, into)):
            logp[own] = np.frombuffer(zlib.decompress(data.pop(("grams", p))))
        at, score = np.flatnonzero(first), np.zeros(len(sizes))
        for i in range(0, len(at), _GRAMS_AT_ONCE):
            ends = at[i + 1 : i + _GRAMS_AT_ONCE + 1]
            runs = np.diff(at[i : i + _GRAMS_AT_ONCE], append=ends[-1] if len(at) > i + _GRAMS_AT_ONCE else len(first))
            inside = owner[at[i] : at[i] + int(runs.sum())]
            score += np.bincount(inside, np.repeat(logp[i : i + _GRAMS_AT_ONCE], runs), len(sizes))
        return pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held_out"], pa.bool_()),
                "n_tokens": sizes + 1, "n_known": known, "train_tokens": np.full(len(sizes), total, np.int64), "base_score": base, "score": score,
            }
        )

    texts = blocks.select("block", "doc_ids", "held_out", "sizes", "ids", "words")
    schema = "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, base_score DOUBLE, score DOUBLE"
    return texts.groupBy("block").cogroup(results.groupBy("of_block")).applyInArrow(scored, schema)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(columns, kinds, strict=True)], names)


def _results(table: pa.Table, kind: str, found: list[bytes], distinct: list[int]) -> pa.Table:
    columns = table.column("block"), [kind] * len(found), table.column("part"), pa.array(found, pa.binary()), pa.array(distinct, pa.int64())
    return pa.table(dict(zip(["block", "kind", "part", "data", "distinct"], columns, strict=True)))
