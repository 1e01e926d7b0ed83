"""Languages of words and texts by a linear-chain conditional random field."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapledger.llm.batches import slices, texts

# Bounds of the labelled sample the field is fitted on.
SAMPLE_TEXTS = 200  # different texts of a language
SAMPLE_SEGMENTS = 6  # runs of words from a text, spread over all of it
SEGMENT_WORDS = 24
# frequent words of each language in the sample that are features of their own
LEXICON_WORDS = 400

BUCKETS = 1 << 16
UNKNOWN = "und"

_CHUNK = 256
_REMEMBERED = 100_000
# text that is labelled at once: its messages, vectors of all words, take some fifty times its size for few languages
_SLICE_BYTES = 1 << 19


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def features(words: list[str], lexicon: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every feature: n-grams of two and three letters, affixes, words of the lexicon.

    Word ends are marked, so n-grams at an end are affixes; prefixes and
    suffixes of three letters are further features.
    """
    joined = "".join(["\x02" + word + "\x03" for word in words])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.repeat(lengths, lengths) - inside  # characters from here to the end of the word
    found = []
    for n in (2, 3, 4):
        if len(codes) < n:
            continue
        value = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            value = (value ^ codes[k : len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        here = slice(0, len(value))
        fits = (left[here] >= n) & ((n < 4) | (inside[here] == 0) | (left[here] == n))
        # a word without letters has no features
        fits &= np.repeat(lengths > 2, lengths)[here]
        found.append((owner[here][fits], (value[fits] >> np.uint64(20)).astype(np.int64) % BUCKETS))
    known = [i for i, word in enumerate(words) if word in lexicon]
    if known:
        own = [int.from_bytes(words[i].encode(errors="surrogatepass")[-6:], "little") * 0x9E3779B1 >> 7 for i in known]
        found.append((np.array(known), np.array([value % BUCKETS for value in own], np.int64)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def summed(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Rows of values added up by owner."""
    return np.stack([np.bincount(owner, values[:, k], n) for k in range(values.shape[1])], axis=1)


@dataclass
class Field:
    """Weights of a fitted field."""

    labels: list[str]
    lexicon: frozenset[str]
    weights: np.ndarray  # BUCKETS x labels
    transitions: np.ndarray  # labels x labels

    def emissions(self, words: list[str]) -> np.ndarray:
        owner, bucket = features(words, self.lexicon)
        return summed(owner, self.weights[bucket], len(words))

    def marginals(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of each label for each word of several texts, by forward-backward."""
        forward, backward, _ = self.messages(emissions, lengths)
        both = forward * backward
        return both / both.sum(axis=1, keepdims=True)

    def messages(self, emissions: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward vectors of each word, each scaled, and its emission potentials.

        Texts are cut into chunks, and what a chunk does to the forward
        vector is one matrix: so all chunks of all texts advance together,
        however long a text is, and the result is that of the whole text.
        """
        n_labels, move = len(self.labels), np.exp(self.transitions)
        chunks = -(-lengths // _CHUNK)
        owner = np.repeat(np.arange(len(lengths)), chunks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        first = (np.cumsum(lengths) - lengths)[owner] + number * _CHUNK
        size = np.minimum(_CHUNK, lengths[owner] - number * _CHUNK)
        steps = int(size.max(initial=0))
        seen = np.exp(emissions - emissions.max(axis=1, keepdims=True))
        grid = np.ones((steps, len(owner), n_labels))
        at = np.arange(steps)[:, None]
        valid = at < size[None, :]
        place = np.where(valid, first[None, :] + at, 0)
        grid[valid] = seen[place[valid]]
        # what each chunk does to a forward vector
        product = np.broadcast_to(np.eye(n_labels), (len(owner), n_labels, n_labels)).copy()
        for t in range(steps):
            live = valid[t]
            moved = (product[live] @ move) * grid[t, live][:, None, :]
            product[live] = moved / moved.max(axis=(1, 2), keepdims=True)
        # vectors at the ends of the chunks, text by text
        before, after = np.ones((len(owner), n_labels)), np.ones((len(owner), n_labels))
        most = int(chunks.max(initial=0))
        start = np.cumsum(chunks) - chunks
        for c in range(1, most):
            row = start[chunks > c] + c
            vector = np.einsum("ni,nij->nj", before[row - 1], product[row - 1])
            before[row] = vector / vector.max(axis=1, keepdims=True)
        for c in range(most - 2, -1, -1):
            row = start[chunks > c + 1] + c
            vector = np.einsum("nij,nj->ni", product[row + 1], after[row + 1])
            after[row] = vector / vector.max(axis=1, keepdims=True)
        forward, backward = np.empty_like(grid), np.empty_like(grid)
        vector = before
        for t in range(steps):
            vector = (vector @ move) * grid[t]
            vector = vector / vector.max(axis=1, keepdims=True)
            forward[t] = vector
        vector = after
        for t in range(steps - 1, -1, -1):
            live = valid[t][:, None]
            backward[t] = vector
            moved = (grid[t] * vector) @ move.T
            vector = np.where(live, moved / moved.max(axis=1, keepdims=True), vector)
        result = []
        for grid_vectors in (forward, backward):
            flat = np.empty((len(emissions), n_labels))
            flat[place[valid]] = grid_vectors[valid]
            result.append(flat)
        return result[0], result[1], seen


def fit(samples: list[tuple[str, str]], seed: int = 1, rounds: int = 6, rate: float = 0.5, decay: float = 1e-6) -> Field:
    """Fit a field on (language, text) pairs by gradient ascent of the likelihood of label sequences.

    Segments of different texts are strung together, so that transitions
    between languages are learned as well as those within one.
    """
    labels = sorted({lang for lang, _ in samples})
    number = {lang: i for i, lang in enumerate(labels)}
    segments, counts = [], {lang: Counter() for lang in labels}
    for lang, text in samples:
        words = [core for core in map(letters, text.lower().split()) if core]
        counts[lang].update(words)
        every = max(SEGMENT_WORDS, -(-len(words) // SAMPLE_SEGMENTS))
        segments += [(number[lang], words[i : i + SEGMENT_WORDS]) for i in range(0, len(words), every)]
    lexicon = frozenset(word for c in counts.values() for word, n in c.most_common(LEXICON_WORDS) if n > 1)
    field = Field(labels, lexicon, np.zeros((BUCKETS, len(labels))), np.zeros((len(labels), len(labels))))
    random = np.random.default_rng(seed)
    squares, moves = np.full(field.weights.shape, 1e-2), np.full(field.transitions.shape, 1e-2)
    for _ in range(rounds):
        order = random.permutation(len(segments))
        for start in range(0, len(order), 96):
            batch = [segments[i] for i in order[start : start + 96]]
            words = [word for _, segment in batch for word in segment]
            if not words:
                continue
            truth = np.repeat([label for label, _ in batch], [len(s) for _, s in batch])
            # three segments in a row make one sequence
            lengths = np.add.reduceat([len(s) for _, s in batch], np.arange(0, len(batch), 3))
            owner, bucket = features(words, lexicon)
            emissions = summed(owner, field.weights[bucket], len(words))
            forward, backward, seen = field.messages(emissions, lengths)
            missing = -(forward * backward)
            missing /= -missing.sum(axis=1, keepdims=True)
            missing[np.arange(len(words)), truth] += 1
            touched, where = np.unique(bucket, return_inverse=True)
            slope = summed(where, missing[owner], len(touched)) / len(batch) - decay * field.weights[touched]
            squares[touched] += slope * slope
            field.weights[touched] += rate * slope / np.sqrt(squares[touched])
            # pairs within a sequence
            pair = np.ones(len(words), bool)
            pair[np.cumsum(lengths) - 1] = False
            here = np.flatnonzero(pair)
            change = np.zeros_like(field.transitions)
            np.add.at(change, (truth[here], truth[here + 1]), 1)
            change -= _expected_pairs(field.transitions, forward[here], (seen * backward)[here + 1])
            change /= len(batch)
            moves += change * change
            field.transitions += 0.1 * change / np.sqrt(moves)
    return field


def _expected_pairs(transitions: np.ndarray, forward: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Expected transitions between neighbours, from the forward vector of one and what follows from the other."""
    joint = forward[:, :, None] * np.exp(transitions)[None] * after[:, None, :]
    return (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def training_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of an id as text, modulo `parts`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def labelled_sample(documents: DataFrame, per_language: int = SAMPLE_TEXTS) -> list[tuple[str, str]]:
    """(lang, text): of each language the `per_language` different texts of smallest hash, from all rows given.

    Bounded: nothing else comes to the driver. Copies of a text count once.
    """
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.xxhash64("text").alias("hash"), "text"
    )
    ranked = rows.select("lang", "hash").distinct().withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    )
    chosen = ranked.where(F.col("rank") <= per_language).select("lang", "hash")
    wanted = [row.hash for row in chosen.collect()]
    if not wanted:
        return []
    some = rows.where(F.col("hash").isin(wanted)).groupBy("lang", "hash").agg(F.first("text").alias("text"))
    some = some.join(F.broadcast(chosen), ["lang", "hash"])
    return [(row.lang, row.text) for row in some.orderBy("lang", "hash").collect()]


class _Ids(dict):
    """Words numbered as they come."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(letters(word))
        return number


class Labeller:
    """Labels texts with a field and remembers the emissions of the words it has met."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self._forget()

    def _forget(self) -> None:
        self.ids = _Ids()
        self.emissions = np.zeros((0, len(self.field.labels)), np.float32)
        self.lettered = np.zeros(0, bool)

    def word_marginals(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of all words, whether each has a letter, and the number of words of each text."""
        if len(self.ids) > _REMEMBERED:
            self._forget()
        words = [text.lower().split() for text in batch]
        lengths = np.array([len(w) for w in words], np.int64)
        numbers = np.fromiter((self.ids[word] for group in words for word in group), np.int64, int(lengths.sum()))
        if self.ids.new:
            new = self.field.emissions(self.ids.new).astype(np.float32)
            self.emissions = np.concatenate([self.emissions, new])
            self.lettered = np.concatenate([self.lettered, [bool(core) for core in self.ids.new]])
            self.ids.new = []
        filled = lengths > 0
        found = self.field.marginals(self.emissions[numbers].astype(np.float64), lengths[filled])
        return found, self.lettered[numbers], lengths

    def label(self, batch: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text: the label with most expected words, and its share of them."""
        found, lettered, lengths = self.word_marginals(batch)
        owner = np.repeat(np.arange(len(batch)), lengths)
        total = summed(owner[lettered], found[lettered], len(batch))
        n = np.bincount(owner[lettered], minlength=len(batch))
        best = total.argmax(axis=1)
        share = total[np.arange(len(batch)), best] / np.maximum(n, 1)
        names = [self.field.labels[k] if words else UNKNOWN for k, words in zip(best, n, strict=True)]
        return names, np.clip(share, 0, 1).tolist()


def label_documents(documents: DataFrame, field: Field | None, extra: list[str] | None = None) -> DataFrame:
    """lang_pred and score of every row, with its doc_id and the columns `extra`.

    The score is the share of the predicted language among the words with a
    letter, by their marginal probabilities. A null text, or one without a
    letter, is `und` with score 0; so is every text without a field.
    """
    kept = ["doc_id", *(extra or [])]
    schema = ", ".join(f"`{name}` {documents.schema[name].dataType.simpleString()}" for name in kept)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field) if field else None
        for batch in slices(batches, "text", _SLICE_BYTES):
            names, scores = labeller.label(texts(batch, "text")) if labeller else ([UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows)
            arrays = [batch.column(batch.schema.get_field_index(name)) for name in kept]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*kept, "lang_pred", "score"]
            )

    columns = list(dict.fromkeys([*kept, "text"]))
    return documents.select(*columns).mapInArrow(labelled, f"{schema}, lang_pred STRING, score DOUBLE")


def _learned(documents: DataFrame, parts: int, held_out: int, per_language: int) -> tuple[DataFrame, Field | None]:
    rows = documents.select("doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(training_remainder(F.col("doc_id"), parts) == held_out, F.lit(False))
    )
    sample = labelled_sample(rows.where(~F.col("held_out")), per_language)
    return rows, fit(sample) if sample else None


def with_language(
    documents: DataFrame, parts: int = 4, held_out: int = 2, per_language: int = SAMPLE_TEXTS
) -> DataFrame:
    """The rows whose text gets a language, all their columns; null texts and texts without a letter go."""
    _, field = _learned(documents, parts, held_out, per_language)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field) if field else None
        for batch in slices(batches, "text", _SLICE_BYTES):
            if labeller:
                names, _ = labeller.label(texts(batch, "text"))
                yield batch.filter(pa.array([name != UNKNOWN for name in names], pa.bool_()))

    return documents.mapInArrow(chosen, documents.schema)


def identify_languages(
    documents: DataFrame, parts: int = 4, held_out: int = 2, per_language: int = SAMPLE_TEXTS
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    Learns from text and non-null lang of rows whose crc32(doc_id as text)
    mod `parts` isn't `held_out`, of which at most `per_language` different
    texts of a language; a null id is not held out. Repeated rows are
    labelled alike, rows with null texts are `und`, an empty table gives no
    rows, further columns are ignored.
    """
    rows, field = _learned(documents, parts, held_out, per_language)
    return label_documents(rows.select("doc_id", "text", "held_out"), field, ["held_out"])
