"""Toxicity by multiple-instance learning: a document is as toxic as its sentences together.

Only documents carry labels. A sentence has a probability of its own, from its
words; a document is clean if all its sentences are (noisy-or). Training
follows the document labels through that rule to the words, so the sentences
that made a document toxic can be located afterwards.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.llm.batches import slices, texts

# the fitting sample: different texts of each label, those of smallest hash, and their greatest length
SAMPLE_TEXTS = 1500
SAMPLE_CHARS = 10_000
# a feature must occur in so many sampled texts to get a weight
LEAST_TEXTS = 5
STEPS, RATE = 150, 0.15
# strength of the pull of all weights to zero, in documents
PENALTY = 0.1
# letters of a word's beginnings that count beside the word: what is inflected or compounded shares them
BEGINNINGS = (4, 5)
_START = -6.0
# words whose weight is remembered by a task
_REMEMBERED = 400_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


class _Features(dict):
    """The features of each word: itself, and its beginnings as `begin-`."""

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) > _REMEMBERED:
            self.clear()
        self[word] = found = (word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n))
        return found


_features = _Features()


def sentences(text: str) -> list[tuple[int, int, set[str]]]:
    """(start, end, distinct lower-case words) of every sentence that has a word.

    A sentence ends at a full stop, a mark or a line's end.
    """
    found = ((m.start(), m.end(), set(_WORD.findall(m.group().lower()))) for m in _SENTENCE.finditer(text))
    return [one for one in found if one[2]]


def features(words: set[str]) -> set[str]:
    return set().union(*map(_features.__getitem__, words))


@dataclass
class Model:
    """Weights of features, the bias of a sentence, and the share of documents toxic for no sentence of theirs."""

    weights: dict[str, float]
    bias: float
    leak: float

    def sentence_logits(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Place and logit of each sentence of a text."""
        weight, places, logits = self.weights.get, [], []
        for start, end, words in sentences(text):
            places.append((start, end))
            logits.append(self.bias + sum(weight(feature, 0.0) for feature in features(words)))
        return places, np.array(logits, np.float64)

    def score(self, logits: np.ndarray) -> float:
        """Noisy-or of the sentences and the leak."""
        clean = np.log1p(-self.leak) - np.logaddexp(0, logits).sum()
        return float(min(max(-np.expm1(clean), 0.0), 1.0))


def _gradient(logits: np.ndarray, leak: float, owner: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Slope of the loss by each sentence's logit and by the leak's logit."""
    clean = np.log1p(-leak) - np.bincount(owner, np.logaddexp(0, logits), len(toxic))
    clean = np.minimum(clean, -1e-12)
    # of -log(1 - e^clean) for toxic documents, of -clean for the others
    by_clean = weight * np.where(toxic, np.exp(clean) / -np.expm1(clean), -1.0)
    return -by_clean[owner] / (1 + np.exp(-logits)), float(-(by_clean * leak).sum())


def fit(sample: list[tuple[str, bool]], weights: dict[bool, float] | None = None) -> Model:
    """A model of labelled texts; `weights` says how many documents a text of each label stands for.

    Adam over the whole sample. With one label only, every text gets its share of 0 or 1.
    """
    toxic = np.array([label for _, label in sample], bool)
    if not len(toxic) or toxic.all() or not toxic.any():
        return Model({}, -np.inf, float(len(toxic) > 0 and toxic.all()))
    cut = [[features(words) for _, _, words in sentences(text)] for text, _ in sample]
    texts_with = Counter(word for found in cut for word in set().union(*found))
    vocabulary = {word: n for n, word in enumerate(sorted(w for w, n in texts_with.items() if n >= LEAST_TEXTS))}
    owner = np.repeat(np.arange(len(cut)), [len(found) for found in cut])
    pairs = [
        (n, vocabulary[word]) for n, words in enumerate(words for found in cut for words in found) for word in sorted(words) if word in vocabulary
    ]
    at, feature = np.array(pairs, np.int64).reshape(-1, 2).T
    stands_for = np.array([(weights or {}).get(bool(t), 1.0) for t in toxic])
    stands_for *= len(toxic) / stands_for.sum()
    # one vector: weights, then bias, then the leak's logit
    size = len(vocabulary)
    point = np.zeros(size + 2)
    point[size:] = _START, np.log(0.05)
    first, second = np.zeros_like(point), np.zeros_like(point)
    for step in range(1, STEPS + 1):
        logits = point[size] + np.bincount(at, point[feature], len(owner))
        leak = 1 / (1 + np.exp(-point[size + 1]))
        by_logit, by_leak = _gradient(logits, leak, owner, toxic, stands_for)
        slope = np.empty_like(point)
        slope[:size] = np.bincount(feature, by_logit[at], size) + PENALTY * point[:size]
        slope[size:] = by_logit.sum(), by_leak
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        point -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    kept = {word: float(point[n]) for word, n in vocabulary.items() if abs(point[n]) > 0.01}
    return Model(kept, float(point[size]), float(1 / (1 + np.exp(-point[size + 1]))))


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of an id as text, modulo `parts`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def labelled_sample(
    documents: DataFrame, labels: DataFrame, per_label: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS
) -> tuple[list[tuple[str, bool]], dict[bool, float]]:
    """Texts with their labels, and how many documents a text of each label stands for.

    Of each label the `per_label` different texts of smallest hash, out of
    those of at most `chars` characters; a text labelled both ways goes by the
    majority. Only hashes are joined and grouped; each label is a bounded
    top-n, not one sorted group. Nothing else comes to the driver.
    """
    rows = documents.where(F.col("text").isNotNull() & (F.char_length("text") <= chars))
    rows = rows.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    told = labels.where(F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    by_text = rows.select("doc_id", "hash").join(told, "doc_id").groupBy("hash").agg(F.avg("toxic").alias("share"))
    by_text = by_text.select("hash", (F.col("share") >= 0.5).alias("label")).persist()
    counts = {row.label: row.n for row in by_text.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = {
        row.hash: row.label
        for label in counts
        for row in by_text.where(F.col("label") == label).orderBy("hash").limit(per_label).collect()
    }
    by_text.unpersist()
    if not chosen:
        return [], {}
    some = rows.where(F.col("hash").isin(list(chosen))).groupBy("hash").agg(F.min("text").alias("text"))
    sample = [(row.text, bool(chosen[row.hash])) for row in some.orderBy("hash").collect()]
    sizes = Counter(label for _, label in sample)
    return sample, {label: counts[label] / sizes[label] for label in sizes}


def learn(documents: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0) -> Model:
    """A model of the labelled documents outside the held-out part."""
    known = F.coalesce(remainder(F.col("doc_id"), parts) != held_out, F.lit(False))
    sample, stands_for = labelled_sample(documents.where(known), labels.where(known))
    return fit(sample, stands_for)


def score_documents(documents: DataFrame, model: Model, parts: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted, and the most toxic sentence of each row of (doc_id, text).

    `sentence_score` and the code points `sentence_start` to `sentence_end`
    belong to the sentence of highest probability; they are null for a text
    without a sentence, which scores as the leak alone. A null text counts as
    empty, a null id is not held out. Repeated rows score alike, ties take the
    first sentence, texts are scored whole, an empty table gives no rows,
    further columns are ignored.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores, best = [], []
            for text in texts(batch, "text"):
                places, logits = model.sentence_logits(text)
                scores.append(model.score(logits))
                top = int(logits.argmax()) if len(logits) else -1
                best.append((float(1 / (1 + np.exp(-logits[top]))), *places[top]) if top >= 0 else (None, None, None))
            predicted = [int(score >= 0.5) for score in scores]
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())]
            kinds = (pa.float64(), pa.int64(), pa.int64())
            columns += [pa.array([one[k] for one in best], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "held_out", "score", "predicted", "sentence_score", "sentence_start", "sentence_end"]
            )

    apart = F.coalesce(remainder(F.col("doc_id"), parts) == held_out, F.lit(False)).alias("held_out")
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", apart).mapInArrow(
        scored,
        "doc_id BIGINT, held_out BOOLEAN, score DOUBLE, predicted INT, sentence_score DOUBLE, sentence_start BIGINT, sentence_end BIGINT",
    )


def offending_sentences(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, start, end, probability and sentence of every sentence of at least that probability, in whole texts."""

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch, "text"), strict=True):
                places, logits = model.sentence_logits(text)
                for n in np.flatnonzero(1 / (1 + np.exp(-logits)) >= least):
                    start, end = places[n]
                    rows.append((doc_id, start, end, float(1 / (1 + np.exp(-logits[n]))), text[start:end]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "end", "probability", "sentence"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        located, "doc_id BIGINT, start BIGINT, end BIGINT, probability DOUBLE, sentence STRING"
    )
