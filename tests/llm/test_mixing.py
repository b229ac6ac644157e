from __future__ import annotations

import random
from collections import Counter
from math import log

import pytest

from stationflow.llm.mixing import mix, mixed_documents, plan, solve
from stationflow.llm.scratch import Scratch

SCHEMA = "doc_id long, text string, source string"


def sources(spark, tokens):
    return spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(tokens)], "source string, tokens long")


def weights(tokens, t):
    powers = [(n / sum(tokens)) ** t for n in tokens]
    return [p / sum(powers) for p in powers]


TOKENS = [100_000, 30_000, 9_000, 2_000, 500]


def test_exponent_meets_the_entropy(spark):
    for target in (0.9, 1.2, 1.5):
        w = weights(TOKENS, solve(sources(spark, TOKENS), entropy=target).exponent)
        assert -sum(x * log(x) for x in w) == pytest.approx(target, abs=1e-6)
    assert solve(sources(spark, TOKENS), entropy=5.0).exponent == 0  # flatter than any mixture
    assert solve(sources(spark, TOKENS), entropy=0.01).exponent == pytest.approx(1)


def test_exponent_meets_the_repetition_limit(spark):
    found = solve(sources(spark, TOKENS), max_repeats=2.0)
    passes = [found.budget * w / n for w, n in zip(weights(TOKENS, found.exponent), TOKENS, strict=True)]
    assert max(passes) == pytest.approx(2.0, abs=1e-6) and min(passes) == pytest.approx(1.0, abs=1e-6)
    found = solve(sources(spark, TOKENS), max_repeats=3.0, budget=50_000)
    passes = [50_000 * w / n for w, n in zip(weights(TOKENS, found.exponent), TOKENS, strict=True)]
    assert max(passes) == pytest.approx(3.0, abs=1e-6)


def test_bisection_is_the_same_as_bisecting_in_plain_python(spark):
    low, high = 0.0, 1.0
    for _ in range(40):
        mid = (low + high) / 2
        w = weights(TOKENS, mid)
        if -sum(x * log(x) for x in w) <= 1.3:
            high = mid
        else:
            low = mid
    assert solve(sources(spark, TOKENS), entropy=1.3).exponent == pytest.approx(high, abs=1e-9)


def corpus(seed=1):
    rng, rows = random.Random(seed), []
    for source, n in (("hot", 900), ("mid", 300), ("small", 60), (None, 30)):
        for _ in range(n):
            rows.append((len(rows), " ".join(["w"] * rng.randint(5, 40)), source))
    return rows


def test_schedule_realises_the_weights(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    _, _, mixture = plan(docs, Scratch(spark, "t"))
    found = mix(docs).collect()
    size = {i: len(t.split()) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    total, used = Counter(), Counter()
    for i in size:
        total[source[i]] += size[i]
    for r in found:
        assert r.n_tokens == size[r.doc_id] and r.source == source[r.doc_id] and 0 <= r.at <= 1
        used[r.source] += r.n_tokens
    n = sum(total.values())
    for s, tokens in total.items():
        want = mixture.budget * (tokens / n) ** mixture.exponent / mixture.norm
        assert used[s] == pytest.approx(want, abs=45)  # within a block: here a document
    passes = Counter((r.doc_id, r.epoch) for r in found)
    assert set(passes.values()) == {1} and {d for d, _ in passes} == set(size)
    first = [r for r in found if r.epoch == 0 and r.source == "hot"]
    assert len({r.at for r in first}) > 300  # blocks are spread over the mixture


def test_budget_below_the_corpus_and_other_permutations(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    a = {(r.doc_id, r.epoch) for r in mix(docs, budget=3_000.0, seed=1).collect()}
    b = {(r.doc_id, r.epoch) for r in mix(docs, budget=3_000.0, seed=2).collect()}
    assert a != b and a == {(r.doc_id, r.epoch) for r in mix(docs.repartition(6), budget=3_000.0, seed=1).collect()}


def test_nulls_empty_and_clashing_columns(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", "b"), (None, "z", None), (4, "long " * 50_000, "b"), (3, "x y", "b"), (5, " ", None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "2 AS epoch", "'n' AS tokens", "3 AS share")
    found = Counter((r.doc_id, r.source) for r in mix(docs).collect())
    assert found[(1, "a")] == found[(2, "a")] == 1  # a source without tokens comes once
    assert found[(3, "b")] >= 2 and found[(None, None)] >= 1
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns and Counter((r.doc_id, r.source) for r in mixed.collect()) == found


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix(docs).count() == 0 and mixed_documents(docs).count() == 0
    blank = spark.createDataFrame([(1, "", "a")], SCHEMA)
    assert mix(blank).count() == 1


def test_native_plan(spark):
    plan_text = mix(spark.createDataFrame(corpus(), SCHEMA))._jdf.queryExecution().toString()
    assert not any(w in plan_text for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
