"""Operators on single texts: pages, scores, packing, languages, tokens, chat and licences."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from mapledger.llm import chat, html_density, language_crf, licenses, packing, ppm, token_counts
from mapledger.llm.queries import tokenizer_path

from ..conftest import TESTDATA

tokenizers = pytest.importorskip("tokenizers")

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# every column an operator makes, as an extra one of the input
CLASH = ", held_out STRING, score STRING, piece STRING, word STRING, n_tokens STRING, license STRING, lang_pred STRING"
ODD = ["", " \n\t", "x" * 20000, "the " * 6000, "naïve ÀÉ İΣ 日本 🤣́ ​ \u0085", "a\x1cb", "<|endoftext|>x<|endoftext|>", "it's WE'LL don't 12,345.67 ½²"]


def frame(spark, texts, lang="en"):
    rows = [(i, t, lang if isinstance(lang, str) else lang[i], None, None, *["?"] * 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + CLASH)


def noise(seed, n, pool="ab Cé\n\t '’s日1%$  <|>ll"):
    rng = random.Random(seed)
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(200))) for _ in range(n)]


def small(spark, name):
    return spark.read.parquet(f"{TESTDATA}/{name}.parquet")


# --- pages -----------------------------------------------------------------


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style>{head}</head><body>{body}</body></html>"


PARTS = "<p>The first paragraph of the article has words enough.</p><p>The second &amp; last\n one, with <a href=x>a link</a>, too.</p>"
ARTICLE = "The first paragraph of the article has words enough.\nThe second & last one, with a link, too."
LONG = "<p>This goes on for much longer than the article does, so that its weight alone would have it taken for the main text.</p>" * 3


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (page(f"<nav><a href=/>Home</a></nav><article>{PARTS}</article><footer>f</footer>"), ARTICLE),
        (page(f"<div class='layout with-sidebar'><div id=content>{PARTS}</div><div class=sidebar>{LONG}</div></div>"), ARTICLE),
        (page(f"<main>{PARTS}</main><section id='comments'>{LONG}</section>"), ARTICLE),
        (page(f"<article>{PARTS}<div class='reader-comments'>{LONG}</div></article><form>{LONG}</form>"), ARTICLE),
        (page(f"<div class='cookie-notice'>{LONG}</div><div><div class='ad'>{LONG}</div><div>{PARTS}</div></div>"), ARTICLE),
        (page("<article><h1>Head</h1><p><b>Bold<br><p>Next<ul><li>One<li>Two</ul></article>"), "Head\nBold\nNext\nOne\nTwo"),
        (page("<article><pre>a  b\n c</pre>x<!-- no <p>no</p> -->y&#233;&lt;&nbsp;z<script>var a='</p>'</script></article>"), "a b c\nxyé< z"),
        ("only text", "only text"),
        ("<p>one<p>two<div>three", "one\ntwo\nthree"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        (page("<nav><a href=/>Home</a></nav>"), ""),
        ("", ""),
        (None, ""),
        ("<a title='x>y' href=\"z\">l</a> & <b", "l &"),
    ],
)
def test_page(html, text):
    assert html_density.main_text(html or "") == text


def test_pages(spark):
    rows = small(spark, "pages")
    found = html_density.extract_pages(rows.withColumnRenamed("page_id", "p").selectExpr("p AS page_id", "url", "html", "1 AS text", "2 AS n_chars"))
    wanted = {}
    for r in rows.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        lines = [re.sub(r"\s+", " ", re.sub("<[^>]*>", "", x)) for x in re.split(r"</?(?:p|h1|br)[^>]*>", inner)]
        wanted[r.page_id] = "\n".join(x for x in (__import__("html").unescape(x).strip() for x in lines) if x)
    assert {r.page_id: r.text for r in found.collect()} == wanted
    assert all(r.n_chars == len(r.text) for r in found.collect())
    assert html_density.extract_pages(rows.limit(0)).count() == 0


def test_links_lower_the_density():
    links = "<p>" + "".join(f"<a href=/{i}>A linked title number {i} of the list</a> " for i in range(30)) + "</p>"
    root = html_density.parse(page(f"<div>{links}</div><div>{PARTS * 4}</div>"))
    html_density.measure(root, root.children[1])
    left, right = (n for n in root.children[1].children)
    assert right.density_sum > left.density_sum


# --- model scores ------------------------------------------------------------


def ppm_by_dicts(train, texts, order=ppm.ORDER):
    """The model, symbol by symbol with sets."""
    words = lambda t: (t or "").encode().lower().split()
    seen = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]

    def symbols(text):
        for word in words(text):
            line = [ppm.START] * order + list(word) + [32]
            yield from ((tuple(line[i - order : i]), line[i]) for i in range(order, len(line)))
        yield (ppm.START,) * order, ppm.END

    for text in train:
        for context, symbol in symbols(text):
            for k in range(order + 1):
                seen[k][context[order - k :]][symbol] += 1

    def logp(context, symbol):
        total, out = 0.0, set()
        for k in range(order, -1, -1):
            all_ = seen[k].get(context[order - k :], {})
            left = {s: n for s, n in all_.items() if s not in out}
            if left:
                whole = sum(left.values()) + len(left)
                if symbol in left:
                    return total + math.log10(left[symbol] / whole)
                total += math.log10(len(left) / whole)
            out = set(all_) or out
        return total - math.log10(ppm.SYMBOLS - len(out))

    return [sum(logp(*x) for x in symbols(t)) for t in texts]


def scores_by_dicts(rows):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    words = lambda t: (t or "").encode().lower().split()
    count = collections.Counter(w for i, t in rows if not held[i] for w in [*words(t), None])
    n, v = sum(count.values()), len(count)
    model = ppm_by_dicts([t for i, t in rows if not held[i]], [t for _, t in rows])
    return {
        i: (held[i], len(words(t)) + 1, sum(count[w] > 0 for w in [*words(t), None]), n,
            sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*words(t), None]), score)
        for (i, t), score in zip(rows, model, strict=True)
    }


def test_scores_against_dicts(spark, monkeypatch):
    monkeypatch.setattr(ppm, "PART_WORDS", 300)
    table = small(spark, "documents").select("doc_id", "text").collect()
    texts = [r.text[:600] for r in table[:60]] + [*ODD[:2], *ODD[3:], None, None] + ["Zz qqq\nzz"] * 3
    rows = list(enumerate(texts))
    found = {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ppm.score_documents(frame(spark, texts)).collect()}
    wanted = scores_by_dicts(rows)
    assert set(found) == set(wanted) and any(v[0] for v in wanted.values())
    for i, w in wanted.items():
        assert found[i][:4] == w[:4] and found[i][4:] == pytest.approx(w[4:])


def test_score_edges(spark):
    assert ppm.score_documents(frame(spark, []).limit(0)).count() == 0
    only = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][0]
    (row,) = ppm.score_documents(spark.createDataFrame([(only, "some text", None, None, 1)], DOCS)).collect()
    assert row.held_out and row.train_tokens == 0 and row.n_known == 0
    assert row.score == pytest.approx(-11 * math.log10(ppm.SYMBOLS))  # ten symbols and the end, nothing learned
    assert row.base_score == pytest.approx(0)
    rows = ppm.score_documents(spark.createDataFrame([(None, "a", None, None, 1)] * 2, DOCS)).collect()
    assert [(r.doc_id, r.held_out, r.train_tokens) for r in rows] == [(None, False, 4)] * 2


def test_held_out_texts_are_predicted(spark):
    """Contexts help: much better than bytes by themselves."""
    table = {r.doc_id: r.text.encode().lower().split() for r in small(spark, "documents").collect()}
    rows = list(ppm.score_documents(small(spark, "documents")).collect())
    train = collections.Counter(x for r in rows if not r.held_out for w in table[r.doc_id] for x in w + b" ")
    total = sum(train.values())
    alone = sum(math.log10(max(1, train[x]) / total) for r in rows if r.held_out for w in table[r.doc_id] for x in w + b" ")
    assert sum(r.score for r in rows if r.held_out) > 0.75 * alone


# --- packing -------------------------------------------------------------------


def check_packing(rows, texts, capacity=packing.CAPACITY):
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = [[*e.ids, 1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    wanted = set()
    for i, own in enumerate(ids):
        for n, at in enumerate(range(0, len(own), capacity)):
            part = own[at : at + capacity]
            wanted.add((i, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == wanted and len(rows) == len(wanted)
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), -(-sum(len(x) for x in ids) // capacity)


def test_packing(spark):
    texts = [*ODD, *noise(1, 80), None, None, "word " * 9000]
    check_packing(packing.pack_documents(frame(spark, texts), tokenizer_path("word_bpe_49k.json")).collect(), texts)
    assert packing.pack_documents(frame(spark, texts).limit(0), tokenizer_path("word_bpe_49k.json")).count() == 0


def test_packing_of_the_small_table(spark):
    table = small(spark, "documents").orderBy("doc_id")
    found = packing.pack_documents(table, tokenizer_path("word_bpe_49k.json")).collect()
    used, least = check_packing(found, [r.text for r in table.collect()])
    assert used <= least + 2


def test_sum_of_squares_rule():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(1, 30, 300), np.sort(rng.integers(1, 30, 300))[::-1], np.array([30] * 5), np.array([10] * 7)):
        bins, offsets = packing.sum_of_squares(lengths, 30)
        level = {}
        for size, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True):
            def after(choice):
                gaps = collections.Counter(30 - x for x in {**level, choice: level.get(choice, 0) + size}.values())
                return sum(n * n for gap, n in gaps.items() if gap)

            options = {b2: after(b2) for b2 in [*level, -1] if level.get(b2, 0) + size <= 30}
            assert level.get(b, 0) == o and after(b if b in level else -1) == min(options.values())
            level[b] = o + size


# --- languages -------------------------------------------------------------------


def test_languages(spark):
    rows = small(spark, "documents")
    found = language_crf.identify_languages(rows)
    right = found.join(rows.select("doc_id", "lang"), "doc_id").where("held_out").selectExpr("avg(int(lang = lang_pred)) a", "min(score) low", "max(score) high").first()
    assert right.a > 0.97 and 0 <= right.low <= right.high <= 1
    ids = {r.doc_id: r.held_out for r in found.collect()}
    assert ids == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}


def test_language_edges(spark):
    known = [r.text for r in small(spark, "documents").where("lang in ('en', 'de')").limit(40).collect()]
    texts = [*known, None, "", "123 !?", "\n", "x" * 5000, known[0], "the " * 8000]
    data = frame(spark, texts, ["en" if " the " in t else "de" for t in known] + [None] * 7)
    found = {r.doc_id: r for r in language_crf.identify_languages(data).collect()}
    assert [found[i].lang_pred for i in range(40, 44)] == ["und"] * 4 and found[40].score == 0
    assert found[45].lang_pred == found[0].lang_pred and found[45].score == found[0].score
    kept = language_crf.with_language(data)
    assert kept.columns == data.columns and {r.doc_id for r in kept.collect()} == set(range(47)) - {40, 41, 42, 43}
    assert language_crf.identify_languages(data.limit(0)).count() == 0
    unlabelled = language_crf.identify_languages(data.where("lang IS NULL"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_forward_backward_against_all_paths():
    import itertools

    rng = np.random.default_rng(1)
    field = language_crf.Field(["a", "b", "c"], frozenset(), np.zeros((1, 3)), rng.normal(size=(3, 3)))
    lengths = np.array([1, 5, 3])
    emissions = rng.normal(size=(9, 3))
    found, start = field.marginals(emissions, lengths), 0
    for n in lengths:
        total = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.exp(sum(emissions[start + t, k] for t, k in enumerate(path)) + sum(field.transitions[a, b] for a, b in itertools.pairwise(path)))
            weight *= np.exp(field.transitions[:, path[0]]).sum()  # any label before the first word
            for t, k in enumerate(path):
                total[t, k] += weight
        assert found[start : start + n] == pytest.approx(total / total.sum(axis=1, keepdims=True))
        start += n


def test_chunks_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    field = language_crf.Field(["a", "b"], frozenset(), np.zeros((1, 2)), rng.normal(size=(2, 2)))
    emissions, lengths = rng.normal(size=(1300, 2)), np.array([700, 1, 599])
    whole = field.marginals(emissions, lengths)
    monkeypatch.setattr(language_crf, "_CHUNK", 7)
    assert field.marginals(emissions, lengths) == pytest.approx(whole)


def test_code_switched_words(spark):
    rows = small(spark, "documents").where("lang in ('en', 'de')").collect()
    field = language_crf.fit([(r.lang, r.text) for r in rows[:80]])
    english, german = (next(r.text for r in rows[80:] if r.lang == lang and len(r.text) > 600) for lang in ("en", "de"))
    words = english.split()[:40] + german.split()[:40]
    found, _, _ = language_crf.Labeller(field).word_marginals([" ".join(words)])
    labels = [field.labels[k] for k in found.argmax(axis=1)]
    assert labels[:40].count("en") >= 36 and labels[40:].count("de") >= 36


# --- tokens ------------------------------------------------------------------------


def test_token_counts(spark):
    texts = [*ODD, *noise(2, 200), None, *(r.text for r in small(spark, "documents").limit(100).collect())]
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    wanted = [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    found = {r.doc_id: r for r in token_counts.count_tokens(frame(spark, texts), tokenizer_path("byte_bpe_50k.json")).collect()}
    assert [found[i].n_tokens for i in range(len(texts))] == wanted
    assert all(found[i].n_bytes == len((t or "").encode()) and found[i].over_limit == (wanted[i] > 512) for i, t in enumerate(texts))
    assert token_counts.count_tokens(frame(spark, texts).limit(0), tokenizer_path("byte_bpe_50k.json")).count() == 0


# --- chat --------------------------------------------------------------------------


def test_chat_round_trip(spark):
    s, e = chat.START, chat.END
    nasty = ["", f"{e}{s}assistant ok", f"a{s}user\nb{e}\n", "<|\\im_end|>", f"<|\\\\im_start|>{e}", "<|im", "\n", "é日🤣 \\n", "im_end|>", "x" * 50000]
    convs = {i: [("user", t), ("assistant", u)] for i, (t, u) in enumerate((t, u) for t in nasty for u in nasty)}
    convs[500] = [("assi\\stant", "a"), ("r\no<|le", e), ("assistant", None), (None, "b"), ("assistant", "z"), ("user\\n", s)]
    rows = [(i, n, r, t, "?", "?") for i, turns in convs.items() for n, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    data = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING, turns STRING, formatted STRING")
    done = chat.format_conversations(data)
    found = {r.conv_id: r for r in chat.round_trip_digests(done).collect()}
    for i, turns in convs.items():
        lines = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
        loss = "".join(t or "" for r, t in turns if r == "assistant")
        row = found[i]
        assert (row.n_turns, row.turns_sha256) == (len(turns), hashlib.sha256(lines.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for row in done.collect():
        assert len(row.formatted) == found[row.conv_id].formatted_chars
        plain = "".join(f"{s}{r or ''}\n{t or ''}{e}\n" for r, t in convs[row.conv_id])
        assert row.escaped == (row.formatted != plain)
    assert not [r for r in done.collect() if r.conv_id == 5 * 10 + 7 and r.escaped]


def test_chat_edges(spark):
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    rows = [(None, 0, "user", "a"), (None, None, "user", "b"), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", None)]
    found = {r.conv_id: r.turns for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert [(t.role, t.text) for t in found[1]] == [("assistant", ""), ("user", "x"), ("user", "x")]
    assert [t.text for t in found[None]] == ["b", "a"]
    assert chat.round_trip_digests(chat.format_conversations(spark.createDataFrame([], schema))).count() == 0


# --- licences -----------------------------------------------------------------------


def licences_by_brute_force(text, dice):
    def bigrams(t):
        t = re.sub(r"[^\w.\-]+|_|[.\-]+(?![^\W_])|(?<![^\W_])[.\-]+", " ", t.lower())
        w = t.split()
        return tuple(zip(w, w[1:], strict=False))

    lines = text.split("\n")
    parts = {text, *lines, *re.split(r"\n[ \t\r]*\n\s*", text), *(x for line in lines for x in re.split(r"(?<=[.!?:;])\s+", line))}
    best = {}
    for own in {bigrams(p) for p in parts}:
        scored = []
        for n, (name, template) in enumerate(licenses.TEMPLATES):
            other = bigrams(template)
            shared = sum((collections.Counter(own) & collections.Counter(other)).values())
            scored.append((2 * shared / (len(own) + len(other)), -n, name))
        top = max(scored)
        if top[0] >= dice:
            d, k = best.get(top[2], (0, 0))
            best[top[2]] = max(d, top[0]), k + 1
    return best


def test_licences(spark):
    rng = random.Random(4)
    texts = ["", None, "no licence here", "Licensed under the\tAPACHE license, version 2.0", "x. Released under the MIT License. y", licenses.TEMPLATES[5][1]]
    for _, template in licenses.TEMPLATES:
        words = template.split()
        if len(words) > 25:
            words[rng.randrange(len(words))] = "changed"
        texts.append("Some text before.\n" + " ".join(words) + "\nSome text after.\n\n" + " ".join(words[: len(words) // 2]))
    texts += [r.text for r in small(spark, "documents").limit(150).collect()]
    found = collections.defaultdict(dict)
    for r in licenses.scan_licenses(frame(spark, texts)).collect():
        found[r.doc_id][r.license] = (round(r.dice, 9), r.n_passages)
    wanted = {i: {k: (round(d, 9), n) for k, (d, n) in licences_by_brute_force(t, licenses.DICE).items()} for i, t in enumerate(texts) if t}
    assert dict(found) == {i: w for i, w in wanted.items() if w}
    assert licenses.scan_licenses(frame(spark, texts).limit(0)).count() == 0
    assert licenses.scan_licenses(frame(spark, texts), templates=[]).count() == 0
