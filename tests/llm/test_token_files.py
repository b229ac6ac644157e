from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from stationflow.llm import token_files
from stationflow.llm.queries import WORD_TOKENIZER, tokenizer_path
from stationflow.llm.scratch import Scratch
from stationflow.llm.token_files import Encoder, read_tokens, token_digests, write_token_files

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def path():
    return tokenizer_path(WORD_TOKENIZER)


@pytest.fixture(scope="module")
def plain(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


TEXTS = ["Hello, World!", None, "", " ", "it's the dog's 42nd", "Été à Noël", "漢字 and ΑΣ σ", "<|endoftext|> inside", "a\x1cb\x85c\xa0d", "x" * 5000,
         "é combining", "tab\tand\nline", "don't WON'T we'll", "!!!???...", "0123456789", "word " * 20_000]


def test_encoder_equals_the_tokenizer(path, plain):
    encode = Encoder(path).encode
    rng = random.Random(2)
    alphabet = "aB'sé É́ \t\n\x1c\x85\xa0 Σς0१9<|>re漢!%​"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    assert [np.frombuffer(x, "<i4").tolist() for x in encode([t or "" for t in texts])] == [plain(t) for t in texts]


def test_round_trip(spark, path, plain):
    rows = [(i * 7 % 40, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "tie"), (3, "tie"), (3, "other")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'c' AS shard", "1 AS ids", "2 AS n_tokens").repartition(3)
    found = sorted(token_digests(docs, path, Scratch(spark, "t").path("f"), shards=4).collect(), key=lambda r: r.start)
    assert len(found) == len(rows)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens
    crc = lambda t: zlib.crc32(np.array(plain(t), "<u4").tobytes())
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in found) == sorted((d or -1, len(plain(t)), crc(t)) for d, t in rows)


def test_files_hold_the_ids_in_order(spark, path, plain):
    place = Scratch(spark, "t").path("f")
    rows = [(i, f"text number {i} " * (i % 5)) for i in range(60)]
    write_token_files(spark.createDataFrame(rows, SCHEMA), path, place, shards=3)
    back = {r.doc_id: list(r.ids) for r in read_tokens(spark, place).collect()}
    assert back == {d: plain(t) for d, t in rows}
    metadata = read_tokens(spark, place, tokens=False)
    assert metadata.columns == ["doc_id", "start", "n_tokens"]
    assert "ids" not in metadata._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_id_are_cut_between_shards(spark, path, plain):
    rows = [(None, f"null {i}") for i in range(300)] + [(7, f"seven {i}") for i in range(300)] + [(i, "x") for i in range(10, 60)]
    place = Scratch(spark, "t").path("f")
    found = token_digests(spark.createDataFrame(rows, SCHEMA).repartition(3), path, place, shards=6).collect()
    found.sort(key=lambda r: r.start)
    assert [r.doc_id for r in found] == [r[0] for r in rows]
    assert [r.start + r.n_tokens for r in found[:-1]] == [r.start for r in found[1:]]
    assert sorted(r.n_tokens for r in found) == sorted(len(plain(t)) for _, t in rows)
    shards = spark.read.parquet(place).groupBy("shard").count().collect()
    assert max(r["count"] for r in shards) < 250


def test_empty_table(spark, path):
    assert token_digests(spark.createDataFrame([], SCHEMA), path, Scratch(spark, "t").path("f")).count() == 0


def test_words_of_a_batch_are_cut_once(path, plain, monkeypatch):
    class Counted:
        cut = 0

        def __init__(self, pattern):
            self.pattern = pattern

        def findall(self, text):
            Counted.cut += len(text)
            return self.pattern.findall(text)

    for name in ("_PRE_TOKENS", "_RUNS"):
        if hasattr(token_files, name):
            monkeypatch.setattr(token_files, name, Counted(getattr(token_files, name)))
    texts = [f"It's the {i % 7}th\tday, isn't it?\r\n " * 50 for i in range(40)]
    found = Encoder(path).encode(texts)
    assert [np.frombuffer(x, "<i4").tolist() for x in found] == [plain(t) for t in texts]
    assert Counted.cut < sum(map(len, texts)) / 100


@pytest.mark.parametrize("cache", [0, 30, 10_000])
def test_a_full_cache_and_marks_in_texts(path, plain, monkeypatch, cache):
    monkeypatch.setattr(token_files, "CACHE", cache)
    encode = Encoder(path).encode
    for low in range(4):
        texts = ["", "\0", "\1", "\0010 a \0", "a \1\0001 b", "\n\n", "漢 \0010", "<|endoftext|>", f"word{low}'s w{low}x, é!'t " * low]
        assert [np.frombuffer(x, "<i4").tolist() for x in encode(texts)] == [plain(t) for t in texts]
    assert encode([]) == []
