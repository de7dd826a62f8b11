"""Ranked lexical search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import lexical
from tidemart.llm.text import slices

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, queries, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, length = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for q, text in queries:
        found = []
        for i, bag, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                        for t in terms(text) if t in bag)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(q, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, queries, **options):
    d = spark.createDataFrame([(*r, 0, "x") for r in docs], "doc_id long, text string, score long, rank string")
    q = spark.createDataFrame([(*r, 0) for r in queries], "item_id long, text string, doc_id long")
    rows = lexical.top_documents(d.repartition(3), q, **options)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def corpus(n, seed, vocabulary=60):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.6)) % vocabulary}" for _ in range(4000)]
    return [(i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("block, together", [(7, 1), (64, 5), (4096, 128)])
def test_equals_plain_python(spark, monkeypatch, block, together):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "TOGETHER", together)
    docs = corpus(400, 1) + [(1000 + i, "w3 w3 copy of a text W9") for i in range(90)] + [(2000, None), (2001, ""), (2002, " .,- ")]
    asked = [(i, t) for i, (_, t) in enumerate(corpus(25, 2))] + [(50, "w3 copy w3 text"), (51, "absent"), (52, None), (53, "w1 " * 40)]
    assert run(spark, docs, asked) == brute(docs, asked)


def test_terms_of_all_scripts(spark):
    docs = [(1, "Été über 中文 ABC"), (2, "été ÉTÉ abc1"), (3, "x_y z-w {a}b"), (4, "Abc,ABC;aBc"), (5, "one two"), (6, "İİ i")]
    asked = [(1, "ÉTÉ ABC"), (2, "Été"), (3, "a b x z"), (4, "one two"), (5, "中文 über")]
    assert run(spark, docs, asked) == brute(docs, asked)


def test_repeats_missing_ids_and_ties(spark):
    docs = [(5, "same words"), (5, "same words"), (None, "same words"), (1, "same words"), (9, "words"), (None, None), (3, "far " * 500 + "same")]
    asked = [(1, "same words words"), (1, "far"), (None, "same")]
    assert run(spark, docs, asked) == brute(docs, asked)
    assert [r[2] for r in run(spark, docs, [(1, "same words")], k=2)] == [1, 5]


def test_no_rows(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a b")], []) == [] and run(spark, [(1, None)], [(1, "a")]) == []


def test_queries_in_several_passes(spark):
    docs, asked = corpus(80, 3), [(i, t) for i, (_, t) in enumerate(corpus(20, 4))]
    assert run(spark, docs, asked, query_bytes=700) == brute(docs, asked)


def test_intervals_are_left_out_by_their_bounds():
    """Of a thousand documents few are scored where some stand out."""
    texts = ["plain filler words only here"] * 1000
    for i in range(0, 1000, 40):
        texts[i] = "needle in plain words" if i % 80 else "needle needle needle"
    queries = lexical.Queries.of(["needle"])
    part = next(slices(pa.array(texts)))[2]
    w = lexical.terms(part)
    at = lexical.find(queries.hashes, w.hash)
    stats = lexical.Statistics(1000, len(w.hash), np.array([25]))
    best, scored = lexical.Best(queries, stats, 5), []
    bounds = lexical._bounds
    lexical._bounds = lambda b, x, y, g: (scored.append(len(x)), bounds(b, x, y, g))[1]
    try:
        best.add(np.arange(1000), w.row[at >= 0], at[at >= 0], np.bincount(w.row))
    finally:
        lexical._bounds = bounds
    assert best.ids[0].tolist() == [0, 80, 160, 240, 320] and sum(scored) < 40


def test_range_maximum():
    draw = np.random.default_rng(4)
    row, term = draw.integers(0, 50, 800), draw.integers(0, 6, 800)
    block = lexical.Block(row, term, np.full(50, 16), 6, lexical.Statistics(50, 800, np.zeros(6)))
    a = draw.integers(0, len(block.key) - 1, 300)
    b = np.minimum(a + draw.integers(1, 40, 300), len(block.key))
    best = block.greatest(a, b)
    assert ((a <= best) & (best < b)).all()
    assert [block.impact[x] for x in best] == [block.impact[i:j].max() for i, j in zip(a, b)]
