"""What a Python worker holds while it labels and encodes, and what it keeps for its next task."""

import random
import tracemalloc

import pyarrow as pa
import pytest

from mapledger.llm import language_crf, packing
from mapledger.llm.queries import tokenizer_path

FIELD = language_crf.fit([("en", "the cat sat on the mat of it " * 8), ("fr", "le chat est sur la table du " * 8)])


class Captured:
    """Stands for a frame: gives the function that its tasks would run."""

    schema = None

    def select(self, *names):
        return self

    def mapInArrow(self, task, schema):  # noqa: N802
        return task


def word(number):
    return "".join("abcdefghij"[int(digit)] for digit in str(number))


def test_labelling_holds_little_text_at_once(monkeypatch):
    rng = random.Random(1)
    words = [word(i) for i in range(3000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(1200)]
    monkeypatch.setattr(language_crf, "_learned", lambda *_: (None, FIELD))
    task = language_crf.with_language(Captured())
    tracemalloc.start()
    kept = sum(batch.num_rows for batch in task(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kept == len(texts)
    assert peak < 50e6  # 107 MB when two megabytes of text were labelled at once


def test_slices_change_no_language():
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["the", "cat", "chat", "est", "table", "mat", "12", "x1"], k=rng.randrange(90))) for _ in range(300)]
    names, scores = language_crf.Labeller(FIELD).label(texts)
    labeller, found = language_crf.Labeller(FIELD), []
    for start in range(0, len(texts), 7):
        found += zip(*labeller.label(texts[start : start + 7]), strict=True)
    assert [name for name, _ in found] == names
    assert [score for _, score in found] == pytest.approx(scores, abs=1e-12)


def test_words_are_forgotten_after_a_large_task(spark, monkeypatch):
    monkeypatch.setattr(packing, "KEPT", 1000, raising=False)
    path = tokenizer_path("word_bpe_49k.json")
    task = packing.token_pieces(Captured(), path, 1)
    for n, left in ((800, 800), (3000, 0)):  # words and their parts
        packing._words(path).clear()
        packing._words(path).parts.clear()
        texts = [" ".join(map(word, range(start, start + 100))) for start in range(10000, 10000 + n // 2, 100)]
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
        assert sum(pieces.num_rows for pieces in task(iter([batch]))) == len(texts)
        known = packing._words(path)
        assert len(known) + len(known.parts) == left
