"""Token-ID files: Parquet list columns with chosen encodings, row groups and page indexes.

The documents are range-partitioned by doc_id and the hash of their text, encoded
shard by shard and written in ascending order.  A file holds one shard's rows:

- ``shard``, ``doc_id``, ``start_in_shard``, ``n_tokens``: metadata, delta- and
  dictionary-encoded, so offsets are read without touching the tokens;
- ``ids``: a list of 32-bit ints, dictionary-encoded up to the dictionary limit.

Row groups and pages are bounded by the writer options; the writer adds column
and offset indexes, so a filter on ``doc_id`` reads only the pages it needs.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.scratch import bounded_broadcast, small_batches

ship(__name__)

END = 2
_LOWER = "a-z\xdf-\xf6\xf8-\xff"
#: Texts of ASCII and Latin-1 letters without control characters.
_PLAIN = re.compile(f"[\\t\\n\\r\x20-\x7e\xc0-\xd6\xd8-\xde{_LOWER}]*")
#: The tokenizer's pre-tokens for these (fixed by its file).
_PRE_TOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LOWER}]+|[0-9]|[^\\s0-9{_LOWER}]+")
#: Lines of such, of the mark of a text's end, and of marks that stand for whole texts.
_RUNS = re.compile(f"\n|\0|\1[0-9]+|{_PRE_TOKENS.pattern}")
_MARKS = {"\n": np.array([-1], "<i4").tobytes(), "\0": np.array([END], "<i4").tobytes()}
#: Encoded pre-tokens kept per Python worker; the cache starts anew when it is full.
CACHE = 800_000

WRITE_OPTIONS = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.writer.version": "v2",
    "compression": "zstd",
}
_SCHEMA = "shard int, doc_id long, start_in_shard long, n_tokens long, ids array<int>"


class Encoder:
    """Texts -> ids as little-endian 32-bit bytes, the end id included.

    A text of ASCII and Latin-1 letters, whose normal form and lower case are
    plain, is split at white space, which no pre-token of the tokenizer crosses.
    The distinct parts of a batch are cut into the tokenizer's pre-tokens here.
    Each distinct pre-token goes through the tokenizer's model once and is looked
    up after that; many go in one call, and the model's word-end mark tells their
    ids apart.  Any other text goes through the whole tokenizer.  Memory is
    bounded by ``CACHE``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

        self.full, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.model.normalizer = normalizers.Sequence([])
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex("\n"), "removed"), byte_level])
        self.ends = np.zeros(self.model.get_vocab_size(), dtype=bool)
        self.ends[[i for token, i in self.model.get_vocab().items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        for low in range(0, len(new), 1000):
            part = new[low : low + 1000]
            found = self.model.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<i4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                raise ValueError("the vocabulary doesn't mark word ends")
            data, at = ids.tobytes(), 0
            for run, cut in zip(part, (4 * cuts).tolist(), strict=True):
                self.known[run], at = data[at:cut], cut

    def look_up(self, parts: str, fixed: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``parts`` (lines), each part's followed by -1, and where these are; ``fixed``: the marks' ids."""
        runs = _RUNS.findall(parts)
        self.known |= fixed
        found = [*map(self.known.get, runs)]
        for mark in fixed:
            del self.known[mark]
        new = {r for r, x in zip(runs, found, strict=True) if x is None}
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
        self.learn([*new])
        found = [self.known[r] if x is None else x for r, x in zip(runs, found, strict=True)]
        ids = np.frombuffer(b"".join(found), dtype="<i4")
        return ids, np.flatnonzero(ids < 0)

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of each text's."""
        plain = [bool(_PLAIN.fullmatch(t)) and "<|" not in t for t in texts]
        whole = self.full.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False)
        # marks, which no plain text holds, stand for the ends and the other texts
        other = {f"\1{i}": np.array(x.ids, "<i4").tobytes() for i, x in enumerate(whole)}
        marks = iter(other)
        marked = [f"{t.lower() if p else next(marks)} \0" for t, p in zip(texts, plain, strict=True)]
        split = pc.ascii_split_whitespace(pa.array(marked, pa.large_string()))
        coded = split.values.dictionary_encode()
        distinct = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        lines = pc.binary_join(distinct, pa.scalar("\n", pa.large_string()))[0].as_py()
        ids, stop = self.look_up(f"{lines}\n", other | _MARKS)
        first = np.concatenate([[0], stop[:-1] + 1])
        part = coded.indices.to_numpy()
        size = (stop - first)[part]
        ends = np.cumsum(size)
        at = np.repeat(first[part] - (ends - size), size)
        at += np.arange(len(at))
        return ids[at], np.diff(np.concatenate([[0], ends])[split.offsets.to_numpy()])

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, sizes = self.encode_flat(texts)
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


def _encoder(path: str) -> Encoder:
    """One encoder per Python worker: workers outlive their tasks, and so does what they have looked up."""
    kept = sys.modules.setdefault("_stationflow_encoders", types.ModuleType("_stationflow_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, start = _encoder(path).encode_flat, TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, sizes = encode([t or "" for t in batch.column(1).to_pylist()])
            ends = start + np.cumsum(sizes)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(sizes), shard, np.int32)),
                    batch.column(0),
                    pa.array(ends - sizes),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(offsets, pa.array(ids)),
                ],
                names=["shard", "doc_id", "start_in_shard", "n_tokens", "ids"],
            )
            start = int(ends[-1])

    return run


def write_token_files(docs: DataFrame, tokenizer: str, path: str, shards: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write them in ascending doc_id order to ``path``.

    Null doc_ids come first; rows of one doc_id are ordered by the hash of their
    text and are all written.  A null text is empty: its ids are the end id
    alone.  ``shards`` defaults to the session's shuffle partitions.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    placed.mapInArrow(_encoded(tokenizer), _SCHEMA).write.options(**WRITE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str, tokens: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens[, ids]) of the files at ``path``.

    Without ``tokens`` only the metadata columns are read.  The start of a
    shard is the sum of the shards before it; there is one row per shard.
    """
    rows = spark.read.schema(_SCHEMA).parquet(path)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    start = (F.col("base") + F.col("start_in_shard")).alias("start")
    found = rows.join(bounded_broadcast(base, 16), "shard").select("doc_id", start, "n_tokens", "ids")
    return found if tokens else found.drop("ids")


def token_digests(docs: DataFrame, tokenizer: str, path: str, shards: int | None = None) -> DataFrame:
    """Write the token files of ``docs`` to ``path`` and read them back; a row per row of ``docs``.

    Columns: doc_id, start (ids of all documents before it), n_tokens (with the
    end id), ids_crc32 (unsigned crc32 of all ids as little-endian unsigned
    32-bit integers).  See ``write_token_files`` for nulls, ties and repeated
    rows.  An empty table gives no rows.
    """
    write_token_files(docs, tokenizer, path, shards)
    return read_tokens(docs.sparkSession, path).mapInArrow(
        _digest_rows, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = [zlib.crc32(x.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()) for x in batch.column(3)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
        )
