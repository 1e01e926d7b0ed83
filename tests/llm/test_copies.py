"""Large groups of near copies: candidates by bitmaps of whole sets, links against brute force."""

import itertools
import random

from pyspark.sql import functions as F

from mapledger.llm import minhash

from .test_links import DOCS, roots, shingle_sets, words_of


def test_copies_without_their_source(spark):
    """More copies than are looked at in a bucket, most of them near the threshold of each other."""
    rng = random.Random(11)
    rows, base = [], words_of(rng, 150, 5000)
    for i in range(220):
        copy = list(base)
        for _ in range(rng.randrange(2, 6)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(4000)}"
        rows.append((i, " ".join(copy)))
    sets = shingle_sets(rows)
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = minhash.near_duplicates(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS), 80).collect()
    wanted = roots(sets, links)
    assert {r.doc_id: r.component_id for r in found} == wanted
    assert 1 < len(set(wanted.values())) < 220


def test_bitmaps_rule_out_no_link(spark):
    rng, texts = random.Random(4), {}
    for size in (1, 9, 60, 300, 3000, 30000):
        for _ in range(4):
            base = words_of(rng, size + 4, 10**6)
            texts[bytes([len(texts)])] = " ".join(base)
            for edits in (0.01, 0.02, 0.022, 0.03, 0.05):  # a word is part of five shingles
                copy = list(base)
                for k in rng.sample(range(size + 4), int(edits * size)):
                    copy[k] = f"edit{rng.randrange(10**6)}"
                texts[bytes([len(texts)])] = " ".join(copy)
    marked = minhash.with_parity(spark.createDataFrame(list(texts.items()), "node BINARY, text STRING")).cache()
    names = ["node", "size", "parity"]
    a, b = (marked.select(*[F.col(n).alias(p + n) for n in names]) for p in ("a_", "b_"))
    kept = {(bytes(r.a_node), bytes(r.b_node)) for r in a.join(b, F.col("a_node") < F.col("b_node")).where(minhash._may_link(80)).collect()}
    sets = shingle_sets(texts.items())
    assert {bytes(r.node): r["size"] for r in marked.collect()} == {n: len(s) for n, s in sets.items()}
    wide = {n: len(s) for n, s in sets.items()}
    links = far = 0
    for x, y in itertools.combinations(sorted(sets), 2):
        alike = len(sets[x] & sets[y]) / len(sets[x] | sets[y])
        if alike >= 0.8:
            links += 1
            assert (x, y) in kept
        elif alike < 0.7 and 50 < max(wide[x], wide[y]) < 5000:
            far += 1
            assert (x, y) not in kept
    assert links > 150 and far > 1000


def test_bitmaps_of_keys(spark):
    """Every text with a key passes, few others do, and the largest hash remainders have their place."""
    frame = spark.range(40000).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    frame = frame.unionByName(spark.createDataFrame([(-1, None), (-2, "")], "id BIGINT, text STRING"))
    keys = frame.where("id % 10 = 0 or id < 0").select(F.xxhash64("text").alias("key"))
    bitmaps = minhash._key_bitmaps(keys, "key")
    passed = {r.id for r in frame.join(F.broadcast(bitmaps), minhash._may_occur(frame["text"], bitmaps), "left_semi").collect()}
    left = {r.id for r in frame.join(F.broadcast(bitmaps), minhash._may_occur(frame["text"], bitmaps), "left_anti").collect()}
    wanted = {-1, -2, *range(0, 40000, 10)}
    assert wanted <= passed and len(passed - wanted) < 100 and len(passed) + len(left) == 40002
