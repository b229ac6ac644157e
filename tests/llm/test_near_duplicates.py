from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stationflow.llm.components import connected_components
from stationflow.llm.near_duplicates import Params, distinct_documents, near_duplicates, shingles
from stationflow.llm.scratch import Scratch

SCHEMA = "doc_id long, text string"


def brute(rows):
    """doc_id -> (n_shingles, component) by comparing all pairs of word shingles."""
    sets = []
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        shingle = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
        sets.append((doc, shingle))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (doc, _) in enumerate(sets):
        ids.setdefault(find(i), []).append(doc)
    return {doc: (len(s), min(ids[find(i)])) for i, (doc, s) in enumerate(sets)}


def words(rng, n):
    return [rng.choice("abcdefgh") + rng.choice("xyzuvw") + str(rng.randint(0, 99)) for _ in range(n)]


def corpus(seed, group=60):
    rng, rows = random.Random(seed), []
    passage = words(rng, 60)
    base = words(rng, 150)
    for i in range(group):  # near copies of one text, some nearer to each other than to it
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            copy[rng.randrange(len(copy))] = "edit" + str(rng.randint(0, 400))
        rows.append((i, " ".join(copy)))
    for i in range(40):  # different texts around one long passage
        rows.append((1000 + i, " ".join([*words(rng, 30), *passage, *words(rng, 30)])))
    for i in range(60):
        rows.append((2000 + i, " ".join(words(rng, rng.choice([1, 4, 5, 40, 300])))))
    rows += [(3000 + i, rows[rng.randrange(len(rows))][1]) for i in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("params", [Params(), Params(short=3, block_docs=10)])
def test_same_components_as_all_pairs(spark, params):
    rows = corpus(5)
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), params).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) == r.representative for r in found)


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, long), (8, long + " x"),
            (None, long + " y"), (9, "É a b c d e"), (10, "é a b c d e"), (4, "One two")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rid", "'x' AS key", "2 AS cluster", "3 AS root")
    found = {(r.doc_id, r.n_shingles): r for r in near_duplicates(docs).collect()}
    assert len(found) == 11  # the repeated row is one document
    component = {k: r.component_id for k, r in found.items()}
    assert [component[(i, 0)] for i in (1, 2, 3)] == [1, 2, 3]
    assert component[(5, 1)] == 4 and component[(6, 1)] == 6
    assert component[(8, 29_997)] == 7 and component[(None, 29_997)] == 7
    assert component[(9, 2)] == 9 and component[(10, 2)] == 10  # only A-Z are lower-cased
    assert found[(None, 29_997)].kept is False
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 9, 10]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(empty).count() == 0
    assert distinct_documents(empty).count() == 0


def test_only_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (None, "q r")], SCHEMA)
    found = near_duplicates(docs).collect()
    assert len(found) == 2 and all(r.component_id is None and r.kept and r.representative for r in found)


def test_shingles():
    assert len(shingles(b"", 5)) == 0 and len(shingles(None, 5)) == 0
    assert len(shingles(b"a b c d", 5)) == 1 and len(shingles(b"a b c d e", 5)) == 1
    assert len(shingles(b"a b c d e a b c d e", 5)) == 5
    assert (shingles(b"A b\x0bc  d e f", 5) == shingles(b"a B c d e F", 5)).all()


def test_one_shingle_has_one_hash_in_texts_of_any_length(spark):
    assert (shingles(b"ha ha ha ha ha", 5) == shingles(b"ha ha ha ha ha ha", 5)).all()
    rows = [(1, "ha ha ha ha ha"), (2, "ha ha ha ha ha ha"), (3, "ha ha ha ha"), (4, "Ha " * 50)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 1)} == brute(rows)


def test_groups_of_long_documents_are_two_blocks_at_most(spark):
    from stationflow.llm import near_duplicates as nd

    for docs, size in ((60, 5000), (60, 400), (400, 1000), (50, 50_000)):
        p = Params(block_bytes=20_000)
        clusters = spark.createDataFrame([(1, i, size + i % 7) for i in range(docs)], "cluster long, rid long, bytes long")
        placed = nd._placed(clusters, p).cache()
        rows = placed.select("rid", "bytes")
        large = placed.where("blocks > 1")
        first = nd._first_groups(placed, p)
        second = nd._second_groups(large.select("cluster", "rid", "bytes", "blocks"), large, p)
        for groups in (first, second):
            sums = groups.join(rows, "rid").groupBy("group").agg(F.sum("bytes").alias("b")).collect()
            # dealt by a hash: uneven by some documents
            assert max((r.b for r in sums), default=0) <= 2 * p.block_bytes + 20 * size, (docs, size)
        met = second.alias("x").join(second.alias("y"), "group").select("x.rid", "y.rid").distinct().count()
        assert met in (0, docs * docs)  # all documents apart meet all others


def test_long_documents_in_many_blocks_get_the_same_components(spark):
    rows = corpus(6, group=40)
    for params in (Params(block_bytes=1200), Params(block_bytes=4000, short=3)):
        found = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), params).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)


def test_documents_unlike_the_first_of_a_combination_meet_each_other(spark):
    from stationflow.llm import near_duplicates as nd

    rng = random.Random(3)
    draw = lambda n: [rng.getrandbits(63) - (1 << 62) for _ in range(n)]
    unsigned = lambda v: sorted(v, key=lambda x: x % (1 << 64))
    sketches, like = [draw(64)], []
    for _ in range(9):  # nine pairs of near copies after one document that is unlike them all
        one = draw(64)
        like.append((len(sketches), len(sketches) + 1))
        sketches += [one, one[:60] + draw(4)]
    sets = spark.createDataFrame([(i, unsigned(s)) for i, s in enumerate(sketches)], "rid long, sketch array<long>")
    listed = spark.createDataFrame([(5, i) for i in range(len(sketches))], "key long, rid long")
    edges = nd._starred(listed, sets, Params(), Scratch(spark, "test")).collect()
    assert {(r.a, r.b) for r in edges} == set(like)
    assert nd._starred(listed.limit(0), sets, Params(), Scratch(spark, "test")).count() == 0


def test_the_first_round_of_a_crowd_makes_no_rows_beside_its_own(spark, monkeypatch):
    from stationflow.llm import near_duplicates as nd

    asked, stored, estimated, table = [], [], nd._estimated, Scratch.table

    def spy(pairs, *rest):
        asked.append(pairs._jdf.queryExecution().optimizedPlan().toString())
        return estimated(pairs, *rest)

    def kept(self, df, name):
        stored.append(name)
        return table(self, df, name)

    monkeypatch.setattr(nd, "_estimated", spy)
    monkeypatch.setattr(Scratch, "table", kept)
    rng = random.Random(4)
    draw = lambda n: sorted((rng.getrandbits(63) for _ in range(n)), key=lambda x: x % (1 << 64))
    base, other = draw(64), draw(64)
    sketches = [base] * 30 + [draw(64), other, other, draw(64)]
    sets = spark.createDataFrame(list(enumerate(sketches)), "rid long, sketch array<long>")
    listed = spark.createDataFrame([(k, i) for k in (5, 6) for i in range(len(sketches))], "key long, rid long")
    edges = {(r.a, r.b) for r in nd._starred(listed, sets, Params(), Scratch(spark, "test")).collect()}
    assert edges == {(0, i) for i in range(1, 30)} | {(31, 32)}
    # the copies meet the first one without a join; what is left of the lists is joined once a round
    assert len(asked) > 1 and not any("Join" in plan for plan in asked)
    assert stored.count("met") == len(asked) - 1


def test_copies_of_one_text_meet_few_documents_each(spark, monkeypatch):
    from stationflow.llm import near_duplicates as nd

    rng = random.Random(8)
    base = words(rng, 200)
    rows = []
    for i in range(400):  # the least edited ones come late
        copy = list(base)
        for _ in range(max(0, 6 - i // 50)):
            copy[rng.randrange(len(copy))] = "edit" + str(rng.randint(0, 400))
        rows.append((i, " ".join(copy)))
    asked, estimated = [], nd._estimated

    def spy(pairs, *rest):
        asked.append(pairs.count())
        return estimated(pairs, *rest)

    monkeypatch.setattr(nd, "_estimated", spy)
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)
    assert sum(asked) <= 8 * len(rows)  # 6.2 each; with the smallest rid first 11.3


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    root = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    found = {r.node: r.root for r in root.collect()}
    label = {i: i for e in edges for i in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert found == {n: r for n, r in label.items() if n != r}


def test_no_cross_join_or_python_udf_in_the_result(spark):
    docs = spark.createDataFrame(corpus(3, group=20), SCHEMA).withColumn("lang", F.lit("en"))
    plan = near_duplicates(docs)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_components_end_without_a_round_that_changes_nothing(spark, monkeypatch):
    stored, table = [], Scratch.table

    def kept(self, df, name):
        stored.append(name)
        return table(self, df, name)

    monkeypatch.setattr(Scratch, "table", kept)
    stars = [(i, i % 7) for i in range(7, 60)] + [(8, 1), (3, 3), (None, 2), (9, None)]  # one edge twice
    root = connected_components(spark.createDataFrame(stars, "a long, b long"), Scratch(spark, "test"))
    assert sorted((r.node, r.root) for r in root.collect()) == [(i, i % 7) for i in range(7, 60)]
    assert stored == ["stars", "least"]
    chain = [(i, i + 1) for i in range(40)]
    root = connected_components(spark.createDataFrame(chain, "a long, b long"), Scratch(spark, "test"))
    assert sorted((r.node, r.root) for r in root.collect()) == [(i, 0) for i in range(1, 41)]
    none = spark.createDataFrame([], "a long, b long")
    assert connected_components(none, Scratch(spark, "test")).count() == 0


def test_pairs_of_short_lists_and_of_crowds_are_estimated_together(spark, monkeypatch):
    from stationflow.llm import near_duplicates as nd

    asked, estimated = [], nd._estimated

    def spy(pairs, *rest):
        asked.append({(r.a, r.b): r.least for r in pairs.collect()})
        return estimated(pairs, *rest)

    monkeypatch.setattr(nd, "_estimated", spy)
    rng = random.Random(9)
    draw = lambda n: sorted((rng.getrandbits(63) for _ in range(n)), key=lambda x: x % (1 << 64))
    base, other = draw(64), draw(64)
    p = Params()
    # as many values in common as pass in a crowd, but not in a short list
    half = sorted(base[:40] + draw(24), key=lambda x: x % (1 << 64))
    sketches = [base, base, half, other, other, base[:42] + sorted(set(draw(22)))]
    sets = spark.createDataFrame([(i, sorted(s, key=lambda x: x % (1 << 64))) for i, s in enumerate(sketches)], "rid long, sketch array<long>")
    listed = spark.createDataFrame([(5, 0), (5, 1), (5, 2)], "key long, rid long")
    short = spark.createDataFrame([(0, 1, p.share), (0, 2, p.share), (3, 4, p.share), (3, 4, p.share), (3, 5, p.share)], "a long, b long, least double")
    edges = [(r.a, r.b) for r in nd._starred(listed, sets, p, Scratch(spark, "test"), short).collect()]
    assert (0, 1) in edges and (3, 4) in edges and (3, 5) not in edges and len(edges) == len(set(edges))
    assert asked[0] == {(0, 1): p.loose, (0, 2): p.loose, (3, 4): p.share, (3, 5): p.share}  # a crowd's bound is the lower
    alone = nd._starred(listed.limit(0), sets, p, Scratch(spark, "test"), short).collect()
    assert {(r.a, r.b) for r in alone} >= {(0, 1), (3, 4)} and asked[-1][(0, 2)] == p.share
