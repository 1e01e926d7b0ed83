"""Licence notices that wrap over lines, stand in comments or have neighbours."""

import collections
import random
import textwrap

import pytest

from mapledger.llm import licenses, queries

from .test_texts import DOCS, frame, licences_by_brute_force, small

HEADER = "Copyright 2020 Somebody\n\n" + textwrap.fill(licenses.TEMPLATES[1][1], 72) + "\nYou may obtain a copy of the License at\n\n    some place\n"
GPL = "Copyright (C) 2020 Somebody. " + licenses.TEMPLATES[13][1]


def by_license(spark, texts):
    found = collections.defaultdict(dict)
    for r in licenses.scan_notices(frame(spark, texts)).collect():
        found[r.doc_id][r.license] = (r.dice, r.n_passages)
    return dict(found)


def commented(text, mark, width=60):
    return "\n".join(f"{mark} {line}".rstrip() for line in textwrap.fill(text, width).split("\n"))


def test_wrapped(spark, tmp_path):
    texts = [HEADER, textwrap.fill(GPL, 60), commented(GPL, " *"), commented("x y. " + licenses.TEMPLATES[8][1] + " 1. source", "#", 40)]
    spark.createDataFrame([(i, t, None, None, 1) for i, t in enumerate(texts)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.license, r.dice, r.n_passages) for r in queries.op10_licenses(spark, str(tmp_path)).collect()}
    assert found == {0: ("Apache-2.0", 1, 1), 1: ("GPL-3.0", 1, 1), 2: ("GPL-3.0", 1, 1), 3: ("BSD-2-Clause", 1, 1)}


def windows_by_brute_force(text, dice):
    """Best coefficients of all windows, by licence, and whether the windows of others overlap none."""
    w = licence_words(text)
    pairs = list(zip(w, w[1:], strict=False))
    ranked = []
    for n, (name, template) in enumerate(licenses.TEMPLATES):
        other = licence_words(template)
        other = collections.Counter(zip(other, other[1:], strict=False))
        a = sum(other.values())
        for i in range(len(pairs)):
            best = max(((2 * sum((collections.Counter(pairs[i:j]) & other).values()) / (a + j - i), j) for j in range(i + 1, min(len(pairs), i + int(a * 1.3) + 1) + 1)), default=(0, 0))
            if pairs[i] in other and best[0] >= dice:
                ranked.append((-best[0], i - best[1], n, i, best[1], name))
    kept = []
    for x in sorted(ranked):
        if all(x[3] >= y[4] or y[3] >= x[4] for y in kept):
            kept.append(x)
    found = {}
    for x in kept:
        found[x[5]] = max(found.get(x[5], 0), -x[0])
    return found


def licence_words(text):
    import re

    return re.sub(r"[^\w.\-]+|_|[.\-]+(?![^\W_])|(?<![^\W_])[.\-]+", " ", text.lower()).split()


def test_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["", None, "no licence here", "Licensed under the\tAPACHE license, version 2.0", HEADER]
    for _, template in licenses.TEMPLATES:
        words = template.split()
        if len(words) > 25:
            words[rng.randrange(1, len(words) - 1)] = "changed"
        texts.append(textwrap.fill("Some of the text before " + " ".join(words) + " and the software after. " + " ".join(words[: len(words) // 2]), 40))
    found = by_license(spark, texts)
    wanted = {i: w for i, t in enumerate(texts) if t and (w := windows_by_brute_force(t, licenses.DICE))}
    assert len(wanted) > 25
    assert {i: {k: d for k, (d, _) in w.items()} for i, w in found.items()} == {i: pytest.approx(w) for i, w in wanted.items()}


def test_passages_are_found_too(spark):
    texts = [r.text for r in small(spark, "documents").limit(150).collect()]
    found = by_license(spark, texts)
    for i, t in enumerate(texts):
        for name, (d, _) in licences_by_brute_force(t, licenses.DICE).items():
            assert found[i][name][0] >= d - 1e-9
    twice = by_license(spark, ["Released under the MIT License. a b c Released under the MIT License.", None])
    assert twice == {0: {"MIT": (1.0, 1)}}
    assert licenses.scan_notices(frame(spark, texts).limit(0)).count() == licenses.scan_notices(frame(spark, texts), templates=[]).count() == 0
