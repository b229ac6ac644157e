from __future__ import annotations

import random

import public_tokenizers
import pytest

from stationflow.llm.queries import BYTE_TOKENIZER, tokenizer_path
from stationflow.llm.scratch import Scratch
from stationflow.llm.token_counts import (
    LEAF,
    PATTERN,
    build_trees,
    changed_blocks,
    composed,
    derived_edits,
    edited_trees,
    leaves,
    roots,
    token_counter,
    token_counts,
)

SCHEMA = "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>"


@pytest.fixture(scope="module")
def path():
    return tokenizer_path(BYTE_TOKENIZER)


@pytest.fixture(scope="module")
def count(path):
    return token_counter(path)


PIECES = ["the", "  ", "\n", "a's", "ñandú", "x" * 30, "12 3", "\t", "'", "...", "　", "\x85", "\xa0", "I'll", " ", "foo bar baz"]


def test_pattern_is_the_vocabularys():
    assert PATTERN == public_tokenizers.PATTERN


def _applied(text, edits):
    for start, stop, new in edits:
        a = min(max(start, 0), len(text))
        text = text[:a] + (new or "") + text[min(max(stop, a), len(text)) :]
    return text


def _random_edits(rng, size, n):
    found = []
    for _ in range(n):
        start = rng.randint(0, size + 3)
        stop = start + rng.choice([0, 0, 1, 5, 40, 900, 5000, 60_000])
        found.append((start, stop, rng.choice(["", None, "x", " ", "\n\n", "hello there " * rng.choice([1, 100, 4000]), "'s", "　"])))
    return found


def _texts(trees):
    blocks = sorted(trees.select("tree", "doc_id", "block", "leaf_text").collect())
    found = {}
    for r in blocks:
        found[r.doc_id] = found.get(r.doc_id, "") + "".join(r.leaf_text)
    return found


def test_composed_edits_give_the_edited_text():
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice("abc ") for _ in range(rng.choice([0, 1, 20])))
        edits = [(rng.randint(-2, 25), rng.randint(-2, 25), rng.choice(["", None, "XY", "Z"])) for _ in range(rng.randint(0, 6))]
        found = composed(edits, len(text))
        assert all(a[1] < b[0] for a, b in zip(found, found[1:], strict=False))
        out, at = "", 0
        for start, stop, new in found:
            out += text[at:start] + new
            at = stop
        assert out + text[at:] == _applied(text, edits), (text, edits)


def test_any_edit_gives_the_count_of_the_whole_text(spark, path, count):
    rng = random.Random(3)
    rows, texts = [], {}
    for i in range(150):
        sizes = [0, 3, 50, 600, 9000, 60_000] if i % 10 == 0 else [0, 3, 50, 600]
        text = "".join(rng.choice(PIECES) + " " * (rng.random() < 0.7) for _ in range(rng.choice(sizes)))
        rows.append((i, text, _random_edits(rng, len(text), rng.randint(0, 6))))
    scratch = Scratch(spark, "test-token-trees")
    trees = build_trees(spark.createDataFrame(rows, SCHEMA).repartition(3), path, scratch)
    assert _texts(trees) == {i: text for i, text, _ in rows}
    texts = {i: _applied(text, edits) for i, text, edits in rows}
    edits = None
    for _ in range(2):  # the second edits meet the trees that the first have left
        trees = edited_trees(trees, edits, path, scratch)
        found = {r.doc_id: r for r in roots(trees).collect()}
        assert _texts(trees) == texts
        assert {i: (r.tokens, r.chars) for i, r in found.items()} == {i: (count(t), len(t)) for i, t in texts.items()}
        more = [(found[i].tree, _random_edits(rng, len(t), rng.randint(0, 6))) for i, t in texts.items()]
        texts = {i: _applied(t, e) for (i, t), (_, e) in zip(texts.items(), more, strict=True)}
        edits = spark.createDataFrame(more, "tree long, edits array<struct<start:int,stop:int,text:string>>")


def test_only_the_touched_region_is_encoded_again(spark, path, count):
    text = "some words of a long text " * 40_000
    rows = [(1, text, [(500_000, 500_010, "other words")]), (2, text, None)]
    scratch = Scratch(spark, "test-token-trees")
    trees = build_trees(spark.createDataFrame(rows, SCHEMA), path, scratch)
    changed = changed_blocks(trees, trees.where("block = 0").select("tree", "edits"), path, scratch).collect()
    assert [r.doc_id for r in changed] == [1] and 0 < changed[0].chars_encoded < 4 * LEAF
    found = {r.doc_id: r for r in token_counts(spark.createDataFrame(rows, SCHEMA), path).collect()}
    assert found[1].n_tokens == count(text[:500_000] + "other words" + text[500_010:])
    assert found[1].n_tokens_before == found[2].n_tokens == count(text) and found[2].chars_encoded_again == 0


def test_leaves_join_to_the_text():
    text = "word " * 1000 + "x" * 3000 + " end"
    found = leaves(text)
    assert "".join(found) == text and len(found) > 5 and leaves("") == [""]


def test_edge_cases(spark, path, count):
    rows = [
        (1, None, None), (2, "", [(0, 0, "new text")]), (3, "abc def", [(100, 200, " tail"), (-5, 3, None)]), (None, "null id", []),
        (4, "tie", [None, (None, 2, "x"), (1, None, "y")]), (4, "tie", None), (5, "word " * 30_000, [(10, 20, ""), (0, 5, "first")]),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_tokens", "2 AS start")
    found = {(r.doc_id, r.n_edits): r for r in token_counts(docs, path).collect()}
    assert len(found) == len(rows)
    assert found[(1, 0)].n_tokens == 0 and found[(2, 1)].n_tokens == count("new text")
    assert found[(3, 2)].n_tokens == count(" def tail") and found[(4, 3)].n_tokens == found[(4, 0)].n_tokens == count("tie")
    text = "word " * 30_000
    text = "first" + (text[:10] + text[20:])[5:]
    assert found[(5, 2)].n_tokens == count(text)
    assert token_counts(spark.createDataFrame([], SCHEMA), path).count() == 0


def test_derived_edits_against_brute_force(spark, path, count):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    edited = derived_edits(docs)
    found = {r.doc_id: r for r in token_counts(edited, path).collect()}
    for r in edited.collect():
        text = r.text
        for start, stop, new in r.edits:
            text = text[:start] + new + text[stop:]
        assert (found[r.doc_id].n_tokens_before, found[r.doc_id].n_tokens) == (count(r.text), count(text))
