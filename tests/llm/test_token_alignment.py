from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import stationflow.llm.token_alignment as ta
from stationflow.llm.queries import BYTE_BPE, PIECE_BPE, tokenizer_path
from stationflow.llm.scratch import Scratch

SCHEMA = "doc_id long, text string"
TEXTS = ["Hello, World!", None, "", " ", "  lead and trail ", "it's the dog's 42nd", "Été à Noël", "漢字 and ΑΣ σ", "<|endoftext|> in <s> </s>", "a\x1cb\x85c\xa0d",
         "x" * 5000, "é combining", "tab\tand\n  line\n\nnext", "under▁bar", "a\n b", "<0x41> \U0001f600 ok", "word " * 3000 + "end", "the the the"]


@pytest.fixture(scope="module")
def paths():
    return tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE)


def brute(rows, paths):
    """Every pair of tokens compared, with the tokenizers' own output on whole texts."""
    a_tok, b_tok = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a_tok.encode_special_tokens = True
    alphabet = ta._byte_alphabet()

    def piece(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for doc, text in rows:
        want = b" " + (text or "").encode()
        a = a_tok.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_tok.encode(text or "")
        a_bytes, b_bytes = [bytes(alphabet[c] for c in a_tok.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            docs.append((doc, [], [], [], []))
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        links, j = [], 0
        for i, end in enumerate(a_ends):  # tokens that start before this one's end and end behind its start
            start = end - len(a_bytes[i])
            while b_ends[j] <= start:
                j += 1
            k = j
            while k < len(b) and b_ends[k] - len(b_bytes[k]) < end:
                links.append((a[i], b[k]))
                k += 1
        groups, la, lb = [], 0, 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            ha, hb = a_ends.index(cut) + 1, b_ends.index(cut) + 1
            groups.append((a[la:ha], b[lb:hb]))
            la, lb = ha, hb
        docs.append((doc, a, b, groups, links))
    counts = Counter(link for d in docs for link in d[4])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    found = []
    for doc, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        found.append((doc, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                      sum(counts[x] for x in links), digest))
    return sorted(found, key=str)


def run(spark, rows, paths, parts=3):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "2 AS seq", "'x' AS pairs").repartition(parts)
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[c] for c in names) for r in ta.aligned_tokens(docs, *paths).collect()), key=str)


def test_same_as_brute_force(spark, paths):
    rng = random.Random(5)
    alphabet = "aB'sé É́ \t\n\x1c\x85\xa0 Σς0१9<|>re漢!%▁"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += [" ".join(rng.choice(["the", "of", "thtion", "erable,", "été", "ing.\n\nOn"]) for _ in range(200)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, "tie tie"), (3, "tie tie")]
    assert run(spark, rows, paths) == brute(rows, paths)


def test_blocks_of_any_size_give_the_same(spark, paths, monkeypatch):
    rows = [(i, f"the word {i % 7} of text number {i} " * (1 + i % 5) + "end") for i in range(60)]
    want = brute(rows, paths)
    monkeypatch.setattr(ta, "BLOCK_LINKS", 40)
    monkeypatch.setattr(ta, "CHUNK", 100)
    assert run(spark, rows, paths, 4) == want


def test_real_documents(spark, paths):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert run(spark, rows, paths) == brute(rows, paths)


def test_pairs_and_ids(spark, paths):
    docs = spark.createDataFrame([(1, "the the"), (2, "the cat")], SCHEMA)
    found = ta.Alignment(docs, *paths, Scratch(spark, "t"))
    a_tok, b_tok = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    texts = {r.doc_id: r for r in found.texts.collect()}
    assert texts[2].a_ids == a_tok.encode(" the cat").ids and texts[2].b_ids == b_tok.encode("the cat")
    assert sum(texts[2].a_sizes) == len(texts[2].a_ids) and sum(texts[2].b_sizes) == len(texts[2].b_ids)
    pairs = {(r.a, r.b): (r.n, r.best) for r in found.pairs.collect()}
    the = (a_tok.encode(" the").ids[0], b_tok.encode("the")[0])
    assert pairs[the] == (3, True)


def test_empty_table(spark, paths):
    assert run(spark, [], paths) == []
    assert run(spark, [(1, None), (2, "")], paths) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
