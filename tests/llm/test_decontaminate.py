from __future__ import annotations

import hashlib
import random
import re

import pytest

from stationflow.llm.decontaminate import decontaminate, decontaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    found = []
    for doc, text in docs:
        words, hit, ids = split(text), set(), set()
        for item, item_text in items:
            target = split(item_text)
            k = min(13, len(target))
            if not k:
                continue
            windows = {tuple(target[i : i + k]) for i in range(len(target) - k + 1)}
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    ids.add(item)
        ids = sorted(str(i) for i in ids if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        found.append((doc, len(words), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(found, key=str)


def run(spark, docs, items):
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    return sorted((tuple(r)[:6] for r in decontaminate(d.repartition(3), i).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "A", "Été", "x1", "and", "In"]) if rng.random() < 0.6 else f"w{rng.randint(0, 60)}"
    text = lambda n: "".join(word() + rng.choice([" ", ", ", ".\n", "--"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 12, 13, 14, 30, 60]))) for i in range(25)]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            source = split(rng.choice(items)[1])
            at = rng.randint(0, max(0, len(source) - 5))
            parts += [" ".join(source[at : at + rng.randint(5, 40)]).upper(), text(rng.randint(0, 200))]
        docs.append((i, " ".join(parts)))
    assert run(spark, docs, items) == brute(docs, items)


def test_edge_cases(spark):
    repeat = "to be or not to be " * 2000  # a very long text whose words repeat
    items = [(1, None), (2, "..."), (3, "Hello World"), (None, "null item words"), (4, "to be or not to be " * 3), (5, "hello world"), (5, "other")]
    docs = [(1, None), (2, ""), (3, "?!"), (None, "hello, WORLD"), (4, repeat), (5, "null item words"), (6, "other hello world"), (6, "other hello world")]
    assert run(spark, docs, items) == brute(docs, items)


def test_clashing_columns_and_filter(spark):
    docs = spark.createDataFrame([(1, "hello world"), (2, "clean text"), (None, "hello world"), (3, None)], DOCS)
    docs = docs.selectExpr("*", "7 AS rid", "8 AS pos", "'t' AS term", "9 AS iid", "'w' AS word", "1 AS n_words")
    items = spark.createDataFrame([(1, "hello world")], ITEMS).selectExpr("*", "5 AS iid", "'q' AS words")
    kept = decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert decontaminate(docs, items).count() == 0
    some = decontaminate(spark.createDataFrame([(1, "a b")], DOCS), items).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in some] == [(2, 0, False)]
    assert decontaminate(docs, spark.createDataFrame([(1, "a b")], ITEMS)).count() == 0


def test_proximity(spark):
    item = " ".join(f"k{i}" for i in range(13))
    moved = "k0 k1 x k2 k3 k4 k5 k6 k7 k8 k9 k10 k11 k12"
    docs = spark.createDataFrame([(1, item), (2, moved), (3, "k0 " + "far " * 50 + "k12")], DOCS)
    found = {r.doc_id: r for r in decontaminate(docs, spark.createDataFrame([(1, item)], ITEMS)).collect()}
    assert (found[1].n_hit, found[1].n_near) == (13, 1)
    assert found[2].n_hit == 0 and found[2].n_near == 1
    assert found[3].n_near == 0


def test_native_plan(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)
    plan = decontaminate(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
