"""Near-duplicate texts and vectors, components and benchmark passages against brute force."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from mapledger.llm import decontamination, minhash, vector_links
from mapledger.llm.components import connected_components

from ..conftest import TESTDATA

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def words_of(random_, n, vocabulary=200):
    return [f"w{random_.randrange(vocabulary)}" for _ in range(n)]


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(500, 500)]
    rng.shuffle(edges)
    found = connected_components(spark.createDataFrame(edges, "u BIGINT, v BIGINT")).collect()
    wanted = roots({x for e in edges for x in e}, edges)
    assert {r.node: r.component for r in found} == {n: c for n, c in wanted.items() if n != c}
    assert connected_components(spark.createDataFrame([], "u BIGINT, v BIGINT")).count() == 0


def shingle_sets(rows):
    def of(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())

    return {i: of(text) for i, text in rows}


def test_minhash_against_all_pairs(spark):
    rng = random.Random(5)
    rows, base = [], words_of(rng, 150)
    for i in range(160):  # edited copies of one text, near the threshold among themselves
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = "x"
        rows.append((i, " ".join(copy)))
    rows += [(200 + i, " ".join(words_of(rng, rng.randrange(0, 60)))) for i in range(60)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "A b\tc"), (304, "a B c"), (305, "a b c d"), (306, "word " * 9), (307, "word " * 30)]
    rows += [(400 + i, rows[200][1].upper().replace(" ", "\n")) for i in range(3)]
    frame = spark.createDataFrame([(i, t, None, None, None, 1) for i, t in rows], DOCS + ", component_id BIGINT")
    sets = shingle_sets(rows)
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    wanted = roots(sets, links)
    found = minhash.near_duplicates(frame).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {i: (len(sets[i]), c, c == i) for i, c in wanted.items()}
    assert len(found) == len(rows)


def test_minhash_edges(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, None), (7, "other words than those of the rest"), (7, "x y")]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    found = sorted(map(tuple, minhash.near_duplicates(frame).collect()), key=repr)
    assert found == sorted(
        [(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 0, None, True), (7, 3, 7, True), (7, 1, 7, True)], key=repr
    )
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def test_minhash_on_the_small_table(spark):
    table = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    sets = shingle_sets(rows)
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    wanted = roots(sets, links)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(table).collect()}
    assert found == wanted and len(links) > 5


def test_odd_sketch_estimates(spark):
    signer = minhash.Signer(minhash.BANDS, minhash.ROWS, minhash.SKETCH_WORDS)
    rng = np.random.default_rng(2)
    bound = minhash.flip_bound(0.85, 192, 1024)
    flips = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 400).astype(np.uint64)
        y = np.concatenate([x[:368], rng.integers(0, 2**63, 32).astype(np.uint64)])  # similarity 0.852
        a, b = (signer.sign(np.sort(s))[1].view(np.uint64) for s in (x, y))
        flips.append(int(np.bitwise_count(a ^ b).sum()))
    # 192 * 0.148 samples differ, each of which flips two bits
    assert abs(np.mean(flips) - 55) < 8 and max(flips) <= bound


def cosine_links(rows, threshold=0.98):
    good = {}
    for k, (_, e, label) in enumerate(rows):
        if e is not None and label is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e):
            good[k] = np.array(e, np.float32).astype(np.float64)
    return [
        (a, b) for a, b in itertools.combinations(good, 2)
        if rows[a][2] == rows[b][2] and len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= threshold
    ]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, component_id STRING")


@pytest.mark.parametrize("tile", [7, 1024])
def test_vectors_against_all_pairs(spark, tile):
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1, None):
        centres = rng.normal(size=(12, 16))
        for i in range(90):
            noise = rng.normal(size=16) * rng.choice([0, 0.05, 0.2])
            rows.append((n, (rng.uniform(0.1, 9) * (centres[i % 12] + noise)).tolist(), label))
            n += 1
    rows += [(n + i, [1.0] * 16, 1) for i in range(40)]
    n += 40
    bad = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 3, [2.0] * 3, [1e30] * 3, [1e-30] * 3, [5.0]]
    rows += [(n + i, e, 1) for i, e in enumerate(bad)]
    links = cosine_links(rows)
    wanted = roots(range(len(rows)), links)
    count = collections.Counter(x for pair in links for x in pair)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_links.link_vectors(vectors(spark, rows), tile=tile).collect()}
    assert found == {i: (count[i], wanted[i], wanted[i] == i) for i in range(len(rows))}


def test_vectors_edges(spark):
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [0.0, 1.0], 1), (None, None, None)]
    found = sorted(map(tuple, vector_links.link_vectors(vectors(spark, rows)).collect()), key=repr)
    assert found == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (4, 0, 4, True), (None, 0, None, True)], key=repr)
    assert vector_links.link_vectors(vectors(spark, [])).count() == 0


def leaks_by_brute_force(docs, items, similarity=0.8):
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    found = {}
    for item_id, text in items:
        w = words(text)
        if not w:
            continue
        k = min(5, len(w))
        own = collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
        m = sum(own.values())
        for doc_id, doc in docs:
            d = words(doc)
            all_ = [tuple(d[i : i + k]) for i in range(len(d) - k + 1)]
            size = min(m, len(all_))
            best = 0
            for s in range(len(all_) - size + 1 if size else 0):
                window = collections.Counter(all_[s : s + size])
                best = max(best, sum((own & window).values()) / sum((own | window).values()))
            if best >= similarity:
                found[doc_id, item_id] = round(best, 9)
    return found


def test_leaks_against_brute_force(spark):
    rng = random.Random(8)
    items = [(i, " ".join(words_of(rng, rng.randrange(12, 60), 4000))) for i in range(25)]
    items += [(90, "two words"), (91, "one two three four"), (92, ""), (93, None), (94, "echo echo echo echo echo echo echo echo echo"), (95, items[3][1])]
    docs = []
    for i in range(120):
        body, item = words_of(rng, rng.randrange(0, 120), 4000), items[i % 25][1].split()
        kind = i % 6
        if kind == 1:
            item[rng.randrange(len(item))] = "changed"
        if kind == 2:
            item = item[rng.randrange(4) : len(item) - rng.randrange(4)]
        if kind == 3:
            item[0] = "changed"
        if kind == 4:
            item = item[: len(item) // 2]
        at = rng.randrange(len(body) + 1)
        docs.append((i, " ".join(body[:at] + [w.upper() + "," if kind == 5 else w for w in item] + body[at:])))
    docs += [(200, "so Two words"), (201, "one two, three four five"), (202, None), (203, ""), (204, "echo " * 30), (205, items[4][1] + ". " + items[5][1])]
    frame = spark.createDataFrame([(i, t, None, None, None, 1) for i, t in docs], DOCS + ", item_id INT")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id BIGINT, text STRING, doc_id STRING")
    found = decontamination.find_leaks(frame, bench).collect()
    wanted = leaks_by_brute_force(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found} == wanted and len(wanted) > 60
    kept = decontamination.without_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in docs} - {i for i, _ in wanted})
    assert decontamination.find_leaks(frame.limit(0), bench).count() == 0
    assert decontamination.find_leaks(frame, bench.limit(0)).count() == 0
    assert decontamination.without_leaks(frame, bench.limit(0)).count() == len(docs)


def test_hamming_blocks_miss_nothing(spark):
    rng = random.Random(1)
    items = [(i, rng.getrandbits(64) - (1 << 63)) for i in range(20)]
    near = []
    for i, fp in items:
        for d in range(12):
            bits = rng.sample(range(64), d)
            value = (fp + (1 << 64) if fp < 0 else fp) ^ sum(1 << b for b in bits)
            near.append((i, value - (1 << 64) if value >> 63 else value))
    own = spark.createDataFrame([(i, fp, 1, [1]) for i, fp in items], "item_id INT, fp BIGINT, m INT, item_shingles ARRAY<BIGINT>")
    windows = spark.createDataFrame([(i, n, fp) for n, (i, fp) in enumerate(near)], "i INT, n INT, fp BIGINT")
    keys = decontamination._item_keys(own, 11, 4)
    joined = decontamination._window_keys(windows, 4).join(keys, ["block", "value"]).where("i = item_id").select("n").distinct()
    assert joined.count() == len(near)
