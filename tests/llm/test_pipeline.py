"""The pipeline's stages by themselves, and from end to end."""

import itertools

import corpus_pipeline
from mapledger.llm import minhash
from mapledger.session import stage

from ..conftest import TESTDATA
from .test_links import leaks_by_brute_force, roots, shingle_sets

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score STRING, sequence_id STRING, component_id STRING"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, "?", "?", "?") for i, t in rows], DOCS)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = []
    for number, (_, apply) in enumerate(corpus_pipeline.STAGES[:-1]):
        done = apply(spark, docs, TESTDATA)
        assert done.schema == docs.schema
        docs = stage(done, f"test-{number}")
        kept.append(sorted(r.doc_id for r in docs.collect()))
    wanted = sorted(i for i, t in texts.items() if any(c.isalpha() for c in t or ""))
    assert kept[0] == wanted
    sets = shingle_sets([(i, texts[i]) for i in wanted])
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    wanted = sorted(i for i, c in roots(sets, links).items() if i == c)
    assert kept[1] == wanted
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
    leaks = {i for i, _ in leaks_by_brute_force([(i, texts[i]) for i in wanted], items)}
    assert kept[2] == sorted(set(wanted) - leaks) and leaks
    last = corpus_pipeline.run(spark, TESTDATA).collect()
    assert sorted({r.doc_id for r in last}) == kept[2]


def test_one_of_each_row(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(9, text), (4, text + " x"), (4, text + " x"), (None, text), (None, "only null ids " + text[:90]), (None, "only null ids " + text[:90]),
            (7, None), (7, None), (8, ""), (5, "something else that is alone here"), (5, "and another text of the same id")]
    kept = minhash.one_of_each(documents(spark, rows), 80)
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert kept.columns == documents(spark, rows).columns
    assert found == sorted([rows[1], rows[4], (7, None), (7, None), (8, ""), *rows[-2:]], key=repr)


def test_empty_and_odd_documents(spark):
    none = documents(spark, [])
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, none, TESTDATA).count() == 0
    odd = documents(spark, [(1, None), (None, ""), (2, "12 34"), (3, "word " * 20000), (None, "some words"), (None, "some words")])
    left = corpus_pipeline.STAGES[0][1](spark, odd, TESTDATA)
    assert sorted((r.doc_id is None, len(r.text)) for r in left.collect()) == [(False, 100000), (True, 10), (True, 10)]
    for _, apply in corpus_pipeline.STAGES[1:3]:
        left = apply(spark, left, TESTDATA)
    packed = corpus_pipeline.STAGES[3][1](spark, left, TESTDATA).collect()
    assert sorted({r.doc_id for r in packed}, key=repr) == [3, None]
