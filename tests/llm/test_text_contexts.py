"""Scores by contexts that run on over the words of a text."""

import collections
import math
import zlib

import pytest

from mapledger.llm import ppm, queries

from .test_texts import DOCS, ODD, frame, scores_by_dicts, small


def scores_by_sets(train, texts, order=ppm.ORDER):
    def symbols(text):
        line = [ppm.START] * order + list(b"".join(w + b" " for w in (text or "").encode().lower().split())) + [ppm.END]
        return [(tuple(line[i - order : i]), line[i]) for i in range(order, len(line))]

    seen = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for text in train:
        for context, symbol in symbols(text):
            for k in range(order + 1):
                seen[k][context[order - k :]][symbol] += 1

    def logp(context, symbol):
        found, out = 0.0, set()
        for k in range(order, -1, -1):
            every = seen[k].get(context[order - k :], {})
            left = {s: n for s, n in every.items() if s not in out}
            if left:
                whole = sum(left.values()) + len(left)
                if symbol in left:
                    return found + math.log10(left[symbol] / whole)
                found += math.log10(len(left) / whole)
            out = set(every) or out
        return found - math.log10(ppm.SYMBOLS - len(out))

    return [sum(logp(*x) for x in symbols(t)) for t in texts]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("size", [3000, 10 << 20])
def test_against_sets(spark, monkeypatch, size):
    monkeypatch.setattr(ppm, "TEXT_BLOCK_BYTES", size)
    monkeypatch.setattr(ppm, "PART_BYTES", 2000)
    monkeypatch.setattr(ppm, "_GRAMS_AT_ONCE", 700)
    texts = [r.text[:600] for r in small(spark, "documents").select("text").limit(60).collect()] + [*ODD[:2], *ODD[3:], None, None] + ["Zz qqq\nzz"] * 3
    found = {r.doc_id: tuple(r)[1:] for r in ppm.score_texts(frame(spark, texts)).collect()}
    words = scores_by_dicts(list(enumerate(texts)))
    scores = scores_by_sets([t for i, t in enumerate(texts) if not is_held(i)], texts)
    assert set(found) == set(words) and any(is_held(i) for i in found)
    for i, w in words.items():
        assert found[i][:4] == w[:4] and found[i][4] == pytest.approx(w[4]) and found[i][5] == pytest.approx(scores[i])


def test_order_of_words_counts(spark, tmp_path):
    held = [i for i in range(200) if is_held(i)][:2]
    text = "the licence of this page covers every line of it and all that is copied from here"
    rows = [(i, text, None, None, 1) for i in range(50) if not is_held(i)]
    rows += [(held[0], text, None, None, 1), (held[1], " ".join(reversed(text.split())), None, None, 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    score = {r.doc_id: r.score for r in queries.op2_ppm_score(spark, str(tmp_path)).collect()}
    assert score[held[0]] > -2  # a copy of training texts costs almost nothing
    assert score[held[1]] < 4 * score[held[0]]


def test_edges(spark):
    assert ppm.score_texts(frame(spark, []).limit(0)).count() == 0
    only = [i for i in range(100) if is_held(i)][0]
    (row,) = ppm.score_texts(spark.createDataFrame([(only, "some text", None, None, 1)], DOCS)).collect()
    assert row.held_out and row.train_tokens == 0 and row.n_known == 0 and row.score == pytest.approx(-11 * math.log10(ppm.SYMBOLS))
    rows = ppm.score_texts(spark.createDataFrame([(None, None, None, None, 1)] * 2, DOCS)).collect()
    assert [(r.doc_id, r.held_out, r.n_tokens, r.train_tokens) for r in rows] == [(None, False, 1, 2)] * 2
