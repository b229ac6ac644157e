from __future__ import annotations

import numpy as np
import pytest

from stationflow.llm.neighbours import balanced_parts, nearest, neighbour_graph

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        s[i] = -9
        order = np.lexsort((ids, -np.round(s, 12)))[:k]
        found[ids[i]] = [(int(ids[j]), float(s[j])) for j in order if j != i]
    return found


def table(spark, rows):
    return spark.createDataFrame([(int(i), [float(c) for c in v] if v is not None else None) for i, v in rows], SCHEMA)


def as_dict(found):
    by = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(by[r.query_id])
    return by


@pytest.mark.parametrize("spread", [0.3, 3.0])
def test_recall_and_scores(spark, spread):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 24))
    rows = [(i, centres[i % 40] + spread * rng.normal(size=24)) for i in range(3000)]
    found, truth = as_dict(nearest(table(spark, rows).repartition(4)).collect()), brute(rows)
    assert set(found) == set(truth)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert hits / (5 * len(truth)) >= 0.9
    exact = {(q, i): s for q in truth for i, s in truth[q]}
    assert all(abs(s - exact[(q, i)]) < 1e-9 for q in found for i, s in found[q] if (q, i) in exact)


def test_one_vector_in_a_third_of_all_rows(spark):
    rng = np.random.default_rng(2)
    same = rng.normal(size=8)
    rows = [(i, same if i % 3 == 0 else rng.normal(size=8)) for i in range(9000)]
    found = as_dict(nearest(table(spark, rows)).collect())
    for q in (0, 150, 300):  # ties go to the smaller ids
        assert [i for i, _ in found[q]] == [i for i in range(0, 18, 3) if i != q][:5]
        assert len({s for _, s in found[q]}) == 1


def test_few_invalid_and_repeated_rows(spark):
    rows = [(0, [1, 0]), (1, [1, 1]), (2, [0, 0]), (3, None), (4, []), (5, [1, float("nan")]), (6, [float("inf"), 1]), (7, [1, 2, 3]), (8, [-1, 0]), (8, [-1, 0]), (50, [2, 0])]
    extra = table(spark, rows).unionAll(spark.createDataFrame([(None, [1.0, 1.0]), (9, [None, 1.0])], SCHEMA))
    found = as_dict(nearest(extra.selectExpr("*", "1 AS part", "2 AS score", "'x' AS vec")).collect())
    assert [i for i, _ in found[0]] == [50, 1, 8] and [i for i, _ in found[50]] == [0, 1, 8]
    assert found[0][0][1] == pytest.approx(1) and set(found) == {0, 50}


def test_empty_table(spark):
    found = nearest(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.count() == 0


def test_parts_are_balanced():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = balanced_parts(x, neighbour_graph(x, 10), 10, rng)
    assert np.bincount(label, minlength=10).max() <= 110 and label.min() >= 0
