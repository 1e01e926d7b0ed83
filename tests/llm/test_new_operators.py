"""Toxicity, hard negatives and tokenizer alignment: against brute force, SQL or held-out labels, and their edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapledger.checks.compare import connect, difference
from mapledger.llm import alignment, hard_negatives, queries, toxicity

from ..conftest import TESTDATA

A, B = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a  b", "a\n b \t c", "héllo wörld", "a 你ß🀀b 🀀🀀", "x▁y z", "▁", "<0x41> <s> </s> <unk>",
    "<|endoftext|> it's 'll", "é ﬁ  x  y", "\x00 \x1c a\x1cb", "don't   stop  ", "x" * 3000, "word " * 500, "日本語のテキスト 日本",
    "tab\tx  \r\n\r\n y", "İstanbul ǅ 🏳️‍🌈", "a" + " " * 50 + "b",
]


def test_alignment_of_odd_texts(spark):
    rng = random.Random(1)
    alphabet = ["a", "b", " ", " ", "\n", "é", "你", "🀀", ".", "'s", "the ", "  ", "́", "<0x0A>", "\t"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(400)] + ["a b a b"] * 3
    docs = spark.createDataFrame([(n, t, 1) for n, t in enumerate(texts)], "doc_id BIGINT, text STRING, n_a INT").repartition(3)
    rows = {row.doc_id: row for row in alignment.count_links(docs, A, B, block_bytes=600).collect()}
    assert {n: tuple(row)[1:] for n, row in rows.items()} == brute_force(dict(enumerate(texts)))
    spans = alignment.token_groups(docs, A, B).where("doc_id = 8").orderBy("ordinal").collect()
    assert [s.start for s in spans] == [0, *[s.end for s in spans[:-1]]] and spans[-1].end == len((" " + ODD[8]).encode())
    assert len(spans) == rows[8].n_groups


def test_alignment_of_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    wanted = brute_force({row.doc_id: row.text for row in docs.collect()})
    assert {row.doc_id: tuple(row)[1:] for row in queries.op13_alignment(spark, TESTDATA).collect()} == wanted


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert alignment.count_links(empty, A, B).collect() == []
    nulls = spark.createDataFrame([(None, None), (None, "a b")], "doc_id BIGINT, text STRING")
    assert sorted(row.n_a for row in alignment.count_links(nulls, A, B).collect()) == [0, 2]


def brute_force(texts):
    """Whole texts by both libraries, tokens told apart by nothing but their bytes."""
    known = alignment.Vocabularies(A, B)
    tokens, links = {}, {}
    for n, text in texts.items():
        tokens[n], links[n] = ([], []), []
        if not text:
            continue
        whole = (" " + text).encode()
        a = [(i, known.a_bytes[i]) for i in known.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, known.b_bytes[i]) for i in known.b.encode(text)]
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            continue
        tokens[n] = tuple(list(zip([i for i, _ in side], np.cumsum([len(x) for _, x in side]).tolist())) for side in (a, b))
        starts = [[0, *[end for _, end in side[:-1]]] for side in tokens[n]]
        j = 0
        for (i, end), start in zip(tokens[n][0], starts[0]):
            while j and starts[1][j] > start:
                j -= 1
            while tokens[n][1][j][1] <= start:
                j += 1
            k = j
            while k < len(starts[1]) and starts[1][k] < end:
                links[n].append((i, tokens[n][1][k][0]))
                k += 1
    counts = Counter(link for found in links.values() for link in found)
    highest = defaultdict(int)
    for (_, b), c in counts.items():
        highest[b] = max(highest[b], c)
    result = {}
    for n in texts:
        a, b = tokens[n]
        common = sorted({end for _, end in a} & {end for _, end in b})
        groups, start = [], 0
        for cut in common:
            sides = [",".join(str(i) for i, end in side if start < end <= cut) for side in (a, b)]
            groups.append("|".join(sides))
            start = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        found = links[n]
        best = sum(counts[link] == highest[link[1]] for link in found)
        result[n] = (len(a), len(b), len(groups), len(found), best, sum(counts[link] for link in found), digest)
    return result


VECTORS = "vec_id BIGINT, label INT, embedding ARRAY<DOUBLE>, rank STRING"


def mined(spark, rows, block=7):
    vectors = spark.createDataFrame([(*row, "x") for row in rows], VECTORS)
    found = hard_negatives.mine_negatives(vectors, F.col("vec_id") % 10 == 0, positives=3, negatives=4, block=block)
    return sorted(tuple(row) for row in found.collect())


def brute_negatives(rows, positives=3, negatives=4):
    usable = [(i, l, [int(np.floor(256 * x)) for x in e]) for i, l, e in rows if None not in (i, l, e) and all(x is not None and np.isfinite(x) for x in e)]
    found = []
    for a, label, e in {(i, l, tuple(e)) for i, l, e in usable if i % 10 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(e, f)), i, l) for i, l, f in usable if len(f) == len(e))
        near = [(i, -s) for s, i, l in scored if l == label and i != a][:positives]
        for i, p in near:
            far = [(j, -s) for s, j, l in scored if l != label and 30 * p <= -100 * s <= 90 * p][:negatives]
            found += [(a, i, n + 1, j, p, s) for n, (j, s) in enumerate(far)]
    return sorted(found)


def test_negatives_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(3)), (rng.normal(size=6) + 0.5).round(2).tolist()) for i in range(150)]
    rows += [(200 + i, i % 2, [0.5] * 6) for i in range(20)]  # ties
    rows += [(400, 1, [1e5, -3e6, 2.0, 1.0, 0.0, 5.0]), (401, 1, [1e5, -3e6, 1.0, 1.0, 1.0, 1.0]), (402, 2, [8e4, -2e6, 0.0, 0.0, 0.0, 0.0])]
    rows += [(500, 0, None), (510, None, [1.0] * 6), (None, 0, [1.0] * 6), (520, 0, [1.0, None] * 3), (530, 0, [float("nan")] * 6), (540, 1, [float("inf")] * 6)]
    rows += [(600, 0, [1.0, 2.0]), (601, 0, [1.0, 2.0]), (602, 1, [1.0, 1.0]), (610, 1, []), (611, 1, []), (612, 0, [])]
    assert mined(spark, rows) == brute_negatives(rows)
    assert mined(spark, rows, block=10_000) == brute_negatives(rows)


def test_negatives_of_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 0, [1.0]), (2, 1, [1.0])]) == []  # no anchor
    repeated = [(0, 0, [1.0])] * 2 + [(1, 0, [1.0]), (2, 1, [0.5]), (2, 1, [0.5])]
    assert mined(spark, repeated) == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 2, 65536, 32768)]


def test_wide_products_are_exact():
    rng = np.random.default_rng(5)
    for high in (2, 300, 1 << 20, 1 << 31):
        vectors, anchor = rng.integers(-high, high, (50, 9)), rng.integers(-high, high, 9)
        wanted = [sum(int(x) * int(y) for x, y in zip(v, anchor)) for v in vectors]
        assert [int(x) for x in hard_negatives.Packed(vectors).products(anchor)] == wanted


def test_negatives_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(queries.op12_hard_negatives(spark, folder), connect(folder), queries.oracle_sql()["op12_hard_negatives"]) is None


def test_gradient():
    rng = np.random.default_rng(1)
    logits, owner = rng.normal(size=7), np.array([0, 0, 1, 1, 1, 2, 3])
    toxic, weight, leak_logit = np.array([True, False, True, False]), np.array([1.0, 2.0, 0.5, 1.0]), -2.0

    def loss(z, leak):
        clean = np.log1p(-1 / (1 + np.exp(-leak))) - np.bincount(owner, np.logaddexp(0, z), 4)
        return -(weight * np.where(toxic, np.log(-np.expm1(clean)), clean)).sum()

    by_logit, by_leak = toxicity._gradient(logits, 1 / (1 + np.exp(-leak_logit)), owner, toxic, weight)
    for n in range(7):
        step = np.eye(7)[n] * 1e-6
        assert abs((loss(logits + step, leak_logit) - loss(logits - step, leak_logit)) / 2e-6 - by_logit[n]) < 1e-6
    assert abs((loss(logits, leak_logit + 1e-6) - loss(logits, leak_logit - 1e-6)) / 2e-6 - by_leak) < 1e-6


def test_toxic_sentences_are_found(spark):
    """Labels of documents only; held-out documents and their sentences are told."""
    rng, plain, bad = random.Random(2), [f"w{i}" for i in range(200)], ["vile", "rotten", "wretch"]
    docs, labels, at = [], [], {}
    for n in range(600):
        parts = [[rng.choice(plain) for _ in range(6)] for _ in range(rng.randint(1, 9))]
        toxic = n % 3 == 0
        if toxic:
            chosen = rng.randrange(len(parts))
            parts[chosen].insert(2, rng.choice(bad).capitalize())
            at[n] = chosen
        docs.append((n, ". ".join(" ".join(p) for p in parts), "en", 0.5))
        labels.append((n, 0, int(toxic ^ (n % 40 == 7))))  # some labels are wrong
    docs += [(None, None, None, None), (1000, "", None, None), (1001, "?!", None, None), (1002, "w1 vile. " * 20_000, None, None)]
    labels += [(1001, 0, None), (None, 0, 1)]
    docs = spark.createDataFrame(docs, "doc_id BIGINT, text STRING, lang STRING, score DOUBLE")
    labels = spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")
    model = toxicity.learn(docs, labels)
    rows = {row.doc_id: row for row in toxicity.score_documents(docs, model).collect()}
    held = [n for n in range(600) if rows[n].held_out]
    assert 80 < len(held) < 160 and not rows[None].held_out
    assert all(rows[n].predicted == (n in at) for n in held)
    assert rows[None].score == rows[1000].score == rows[1001].score == pytest.approx(model.leak) and rows[1000].sentence_start is None
    assert rows[1002].predicted == 1
    text = {row.doc_id: row.text for row in docs.collect()}
    for n in held:
        if n in at:
            assert text[n][: rows[n].sentence_start].count(".") == at[n]
    found = {(row.doc_id, row.sentence.strip()) for row in toxicity.offending_sentences(docs.where(F.col("doc_id").isin(held)), model).collect()}
    assert {n for n, _ in found} == set(at) & set(held) and all(set(s.lower().split()) & set(bad) for _, s in found)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id BIGINT, text STRING")
    kind = "doc_id BIGINT, toxic INT"
    for given, score in (([], 0.0), ([(1, None)], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)):
        model = toxicity.learn(docs, spark.createDataFrame(given, kind))
        assert {row.score for row in toxicity.score_documents(docs, model).collect()} == {score}
    assert toxicity.score_documents(docs.limit(0), model).collect() == []


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.op11_toxicity(spark, folder).where("held_out").join(labels, "doc_id").select("score", "toxic").collect()
    toxic, clean = ([row.score for row in rows if row.toxic == k] for k in (1, 0))
    above = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    print(f"held-out AUC {above:.3f} of {len(toxic)} toxic and {len(clean)} clean documents")
    assert above > 0.7
