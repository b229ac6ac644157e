from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

import stationflow.llm.ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def split(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, top=20):
    held = [(d, Counter(split(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, words = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in set(items):
        rows = []
        for doc, counts, n in held:
            m = 100 - 25 + (25 * n * n_docs) // words
            score = 0
            for t in split(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * counts[t]) // (1000 * counts[t] + 12 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        found += [(item, rank + 1, r[3], -r[0]) for rank, r in enumerate(sorted(rows)[:top])]
    return sorted(found, key=str)


def run(spark, docs, items, parts=3, **options):
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS slice", "'t' AS term", "2 AS item").repartition(parts)
    i = spark.createDataFrame(items, ITEMS).selectExpr("*", "5 AS bundle", "'q' AS term")
    names = ("item_id", "rank", "doc_id", "score")
    return sorted((tuple(r[c] for c in names) for r in rs.ranked_search(d, i, **options).collect()), key=str)


def corpus(seed, docs=150, items=25):
    rng = random.Random(seed)
    common, rare = ["the", "of", "A", "Été", "x1", "and", "In"], [f"w{i}" for i in range(300)]
    word = lambda: rng.choice(common) if rng.random() < 0.6 else rng.choice(rare)
    text = lambda n: "".join(word() + rng.choice([" ", ", ", ".\n", "--", "@"]) for _ in range(n))
    asked = [(i, text(rng.choice([1, 3, 12, 40]))) for i in range(items)]
    rows = []
    for i in range(docs):
        parts = [text(rng.choice([0, 3, 30, 300]))]
        if rng.random() < 0.3:
            parts.append(rng.choice(asked)[1].upper())
        rows.append((i * 7 % docs, " ".join(parts)))
    return rows, asked


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    docs, items = corpus(seed)
    assert run(spark, docs, items) == brute(docs, items)


def test_owners_slices_and_bundles_change_nothing(spark, monkeypatch):
    docs, items = corpus(3)
    want = brute(docs, items, top=5)
    assert run(spark, docs, items, top=5, owners=()) == want
    monkeypatch.setattr(rs, "SLICE_DOCS", 7)
    assert run(spark, docs, items, top=5, owners=(40, 10, 4, 2), bundle=4) == want


def test_accumulators_stay_sparse(spark, monkeypatch):
    """Items of rare words: no accumulator opens for a document that holds the common words alone."""
    docs = [(i, f"the of and filler{i % 3} " * 5) for i in range(400)]
    docs += [(1000 + i, "the of and zebra quagga okapi") for i in range(25)]
    seen = []
    real = rs._bundles

    def spy(state, places, limit):
        rows = real(state, places, limit)
        seen.append(sum(len(r["at"]) // 4 for r in rows.collect()))
        return rows

    monkeypatch.setattr(rs, "_bundles", spy)
    items = [(1, "the zebra of quagga and okapi")]
    assert run(spark, docs, items, owners=(10,)) == brute(docs, items)
    assert seen == [0, 25]


def test_edge_cases(spark):
    long = "to be or not to be " * 5000
    docs = [(1, None), (2, ""), (3, "?!"), (None, "hello WORLD"), (4, long), (5, "hello world"), (5, "hello world"), (6, "hello"), (7, "other words")]
    items = [(1, None), (2, "..."), (3, "Hello World"), (3, "Hello World"), (3, "be hello"), (None, "hello"), (4, "absent")]
    assert run(spark, docs, items) == brute(docs, items)
    # a term that every document holds has a weight of 0
    assert run(spark, [(i, "same") for i in range(1200)], [(1, "same")]) == []


def test_ties_go_to_the_smaller_ids(spark):
    docs = [(i, "needle in hay") for i in range(60, 0, -1)] + [(100 + i, "hay only here") for i in range(500)]
    assert [r[2] for r in sorted(run(spark, docs, [(1, "needle")]), key=lambda r: r[1])] == list(range(1, 21))


def test_vocabulary_beyond_the_limit(spark, monkeypatch):
    docs, items = corpus(4, 60, 10)
    monkeypatch.setattr(rs.build_index, "__defaults__", (10,))
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a"), (2, "b")], []) == []
    assert run(spark, [(1, None)], [(1, "a")]) == []
