"""Alignment of two tokenizers' tokens by interval coalescing.

Every text is encoded by a byte-level BPE (A) and a piece BPE (B).  A token is the
interval of bytes it stands for.  The tokens of many texts are laid out one after
the other and sorted by start; a group breaks where a start reaches the largest end
before it, and inside a group every start that tokens share opens one overlap of
an A and a B token.

How often a pair of ids overlaps is counted over the whole corpus.  A task deals
its texts to blocks of bounded size and writes each block's distinct pairs once; the
pairs are counted by shuffling these, and a block gets back the counts of its own
pairs alone, so no task holds the table of all pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.scratch import Scratch, long_rows

ship(__name__)

#: Overlaps of a block (a longer text is a block of its own).
BLOCK_LINKS = 500_000
#: Bytes of texts that are encoded and aligned at a time.
CHUNK = 1 << 18
#: Encoded words kept during a task; the cache starts anew when it is full.
CACHE = 600_000
_SPACED, _INSIDE = re.compile(r"\s "), re.compile(r"\S ")

_SCHEMA = (
    "block long, seq int, doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>, "
    "pair_at array<int>, pairs array<long>, pair_n array<int>"
)
_TYPES = [pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int32())] * 5, pa.list_(pa.int64()), pa.list_(pa.int32())]
_NAMES = [part.split()[0] for part in _SCHEMA.split(", ")]


def _byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 is itself, others come from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Texts -> ids of both tokenizers, and whether the tokens spell a space and the text.

    Neither tokenizer has a token that holds a space behind a character other than white
    space (which is tested), so words cut at single spaces are encoded one by one, each
    distinct word once.  Texts with white space before a space are encoded whole.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = _byte_alphabet()
        tokens = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t in tokens]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_len, self.b_len = (np.array([len(x) for x in v], dtype=np.int64) for v in (self.a_bytes, self.b_bytes))
        spelled = (t.decode("utf-8", "replace") for t in [*self.a_bytes, *self.b_bytes])
        self.by_word = not any(_INSIDE.search(t) for t in spelled)
        #: Per word the ids of A and of B; ``odd`` words aren't spelt by both.
        self.known: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.odd: set[str] = set()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _both(self, texts: list[str]) -> tuple[list[bytes], list[bytes], list[bool]]:
        """Ids by A of a space and each text, by B of the text (it adds the space), and whether both spell it."""
        a = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        whole = [b" " + t.encode() for t in texts]
        flat = [np.array([i for ids in part for i in ids], np.int32) for part in (a, b)]
        cuts = [np.cumsum([0, *map(len, part)]) for part in (a, b)]
        sizes = np.array([len(w) for w in whole])
        same = np.ones(len(texts), bool)
        for ids, cut, length, spelling in zip(flat, cuts, (self.a_len, self.b_len), (self.a_bytes, self.b_bytes), strict=True):
            upto = np.concatenate([[0], np.cumsum(length[ids])])[cut]
            if b"".join(map(spelling.__getitem__, ids.tolist())) == b"".join(whole):
                same &= np.diff(upto) == sizes
            else:
                pairs = zip(whole, (ids[x:y].tolist() for x, y in zip(cut, cut[1:], strict=False)), strict=True)
                same &= [b"".join(map(spelling.__getitem__, own)) == w for w, own in pairs]
        parts = [(ids.tobytes(), (4 * cut).tolist()) for ids, cut in zip(flat, cuts, strict=True)]
        a, b = ([data[x:y] for x, y in zip(cut, cut[1:], strict=False)] for data, cut in parts)
        return a, b, same.tolist()

    def _joined(self, words: list[str]) -> tuple[list[bytes], list[bytes], list[bool]]:
        """``_both`` of words that don't end in white space, by one call over all of them where both spell it."""
        text = " " + " ".join(words)
        spelled, ends = text.encode(), np.cumsum([1 + len(w.encode()) for w in words])
        found = []
        for ids, length, spelling in (
            (self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.a_len, self.a_bytes),
            (self.b.encode(text[1:]), self.b_len, self.b_bytes),
        ):
            if b"".join(map(spelling.__getitem__, ids)) != spelled:
                return self._both(words)
            ids = np.array(ids, np.int32)
            upto = np.cumsum(length[ids])
            last = np.searchsorted(upto, ends)
            if (upto[last] != ends).any():
                return self._both(words)
            data, cuts = ids.tobytes(), [0, *(4 * (last + 1)).tolist()]
            found.append([data[x:y] for x, y in zip(cuts, cuts[1:], strict=False)])
        return found[0], found[1], [True] * len(words)

    def forget(self) -> None:
        self.known, self.known_b, self.odd = {}, {}, set()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        words = [t.split(" ") if t and self.by_word and not _SPACED.search(" " + t) else [] for t in texts]
        words = [ws if "" not in ws else [] for ws in words]
        distinct = set().union(*words)
        if len(self.known) + len(distinct) > CACHE:
            self.forget()
        new = [w for w in distinct if w not in self.known]
        loose = [w for w in new if w[-1].isspace()]
        new = [w for w in new if not w[-1].isspace()]
        for part in [new[low : low + 1000] for low in range(0, len(new), 1000)] + ([loose] if loose else []):
            a, b, same = self._both(part) if part is loose else self._joined(part)
            self.known.update(zip(part, a, strict=True))
            self.known_b.update(zip(part, b, strict=True))
            self.odd.update(w for w, ok in zip(part, same, strict=True) if not ok)
        found = []
        for text, ws in zip(texts, words, strict=True):
            a = b = b""
            if ws and self.odd.isdisjoint(ws):
                a, b = (b"".join(map(known.__getitem__, ws)) for known in (self.known, self.known_b))
            elif text:
                (a,), (b,), (same,) = self._both([text])
                a, b = (a, b) if same else (b"", b"")
            found.append((np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)))
        return found


def _kept(key: str, make):
    """One object per Python worker and key: workers outlive their tasks."""
    kept = sys.modules.setdefault("_stationflow_alignment", types.ModuleType("_stationflow_alignment")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def coalesce(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups and overlaps of two token sequences that cover the same bytes.

    ``a_len`` and ``b_len`` are the tokens' byte lengths, all above 0.  Returns, per
    group, its start in bytes and its numbers of A and of B tokens; and, per overlap,
    its start and the positions of its A and its B token.
    """
    ends = np.concatenate([np.cumsum(a_len), np.cumsum(b_len)])
    starts = ends - np.concatenate([a_len, b_len])
    kind = np.zeros(len(starts), np.int8)
    kind[len(a_len) :] = 1
    order = np.lexsort((kind, starts))
    starts, ends, is_b = starts[order], ends[order], kind[order] == 1
    reach = np.maximum.accumulate(ends)
    breaks = np.ones(len(starts), bool)
    breaks[1:] = starts[1:] >= reach[:-1]
    group = np.cumsum(breaks) - 1
    groups = int(group[-1]) + 1 if len(group) else 0
    last = np.ones(len(starts), bool)
    last[:-1] = starts[1:] != starts[:-1]
    b_seen = np.cumsum(is_b)
    a_seen = np.arange(1, len(starts) + 1) - b_seen
    return (
        starts[breaks],
        np.bincount(group[~is_b], minlength=groups).astype(np.int32),
        np.bincount(group[is_b], minlength=groups).astype(np.int32),
        starts[last],
        a_seen[last] - 1,
        b_seen[last] - 1,
    )


def _lists(values: np.ndarray, sizes: np.ndarray, kind=np.int32) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind, copy=False)))


class _Block:
    """Aligned texts whose overlaps are indexed together."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.links = 0

    def add(self, tok: Tokenizers, doc_ids: list[int | None], texts: list[str]) -> None:
        ids = tok.encode(texts)
        a, b = (np.concatenate([x[i] for x in ids]) for i in (0, 1))
        n_a, n_b = (np.array([len(x[i]) for x in ids], np.int64) for i in (0, 1))
        lengths = tok.a_len[a]
        sizes = np.bincount(np.repeat(np.arange(len(ids)), n_a), lengths, minlength=len(ids)).astype(np.int64)
        edges = np.cumsum(sizes)
        g_start, g_a, g_b, l_start, l_a, l_b = coalesce(lengths, tok.b_len[b])
        # a start belongs to the first text that ends behind it: texts without tokens take no bytes
        n_groups = np.bincount(np.searchsorted(edges, g_start, "right"), minlength=len(ids))
        doc = np.searchsorted(edges, l_start, "right")
        keys = a[l_a].astype(np.int64) << 32 | b[l_b]
        self.parts.append((doc_ids, a, n_a, b, n_b, g_a, g_b, n_groups, doc, keys))
        self.links += len(keys)

    def rows(self, block: int) -> pa.RecordBatch:
        """One row per text and one (``seq`` -1) with the block's distinct pairs and their counts."""
        doc_ids = [i for p in self.parts for i in p[0]]
        a, n_a, b, n_b, g_a, g_b, n_groups = (np.concatenate([p[i] for p in self.parts]) for i in range(1, 8))
        before = np.cumsum([0, *(len(p[0]) for p in self.parts[:-1])])
        doc = np.concatenate([p[8] + at for p, at in zip(self.parts, before, strict=True)])
        pairs, at = np.unique(np.concatenate([p[9] for p in self.parts]), return_inverse=True)
        own, own_n = np.unique(doc * max(1, len(pairs)) + at, return_counts=True)
        n, width = len(doc_ids), max(1, len(pairs))
        n_own = np.bincount(own // width, minlength=n)
        totals = np.bincount(at, minlength=len(pairs))
        tail = lambda xs, x=0: np.append(xs, x)  # noqa: E731 - the block's own row
        columns = [
            pa.array(np.full(n + 1, block, np.int64)),
            pa.array(tail(np.arange(n, dtype=np.int32), np.int32(-1)).astype(np.int32)),
            pa.array([*doc_ids, None], pa.int64()),
            _lists(a, tail(n_a)),
            _lists(b, tail(n_b)),
            _lists(g_a, tail(n_groups)),
            _lists(g_b, tail(n_groups)),
            _lists(own % width, tail(n_own)),
            _lists(pairs, tail(np.zeros(n, np.int64), len(pairs)), np.int64),
            _lists(np.concatenate([own_n, totals]), tail(n_own, len(pairs))),
        ]
        return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def _align(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _kept(f"{a_path}|{b_path}", lambda: Tokenizers(a_path, b_path))
        first, count, block = TaskContext.get().partitionId() << 32, 0, _Block()
        for batch in batches:
            sizes, low = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), 0
            while low < len(sizes):
                high, size = low, 0
                while high < len(sizes) and (high == low or size + sizes[high] <= CHUNK):
                    size, high = size + sizes[high], high + 1
                doc_ids, texts = (c.slice(low, high - low).to_pylist() for c in batch.columns)
                block.add(tok, doc_ids, [t or "" for t in texts])
                low = high
                if block.links >= BLOCK_LINKS:
                    yield block.rows(first + count)
                    count, block = count + 1, _Block()
        if block.parts:
            yield block.rows(first + count)
        tok.forget()  # the worker outlives its task

    return run


class Alignment:
    """The alignment of a corpus, as written tables.

    ``texts``: one row per document with ``a_ids`` and ``b_ids`` (token ids in order),
    ``a_sizes`` and ``b_sizes`` (tokens of each group, in order), and, under
    ``pair_at`` and ``pair_n``, its distinct linked pairs (places in its block's list of
    pairs) and how many of its links each has.
    ``pairs``: one row per id pair that is linked anywhere: a, b, ``n`` (links in the
    whole corpus), ``best`` (no pair of this B id has more).
    """

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, scratch: Scratch):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        table = scratch.table(rows.mapInArrow(_align(a_path, b_path), _SCHEMA), "alignment")
        self.texts = table.where("seq >= 0").drop("pairs")
        entry = F.explode(F.arrays_zip("pairs", "pair_n"))
        self.blocks = table.where("seq < 0").select("block", entry.alias("e")).select(
            "block", F.col("e.pairs").alias("pair"), F.col("e.pair_n").cast("long").alias("n")
        )
        counts = scratch.table(self.blocks.groupBy("pair").agg(F.sum("n").alias("n")), "counts")
        b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
        counts = counts.withColumn("b", b.cast("int"))
        most = counts.groupBy("b").agg(F.max("n").alias("most"))
        self.pairs = scratch.table(
            counts.join(most, "b").select(
                "pair", F.shiftright("pair", 32).cast("int").alias("a"), "b", "n", (F.col("n") == F.col("most")).alias("best")
            ),
            "pairs",
        )

    def link_scores(self) -> DataFrame:
        """(block, seq, n_links, n_best, count_sum) of every text.

        A block's texts meet the counts of its own pairs, which they refer to by place.
        """
        asked = self.blocks.select(F.col("block").alias("own"), "pair")
        looked = asked.join(self.pairs.select("pair", "n", "best"), "pair")
        rows = self.texts.select("block", "seq", "pair_at", "pair_n")
        return rows.groupBy("block").cogroup(looked.groupBy("own")).applyInArrow(
            _scores, "block long, seq int, n_links long, n_best long, count_sum long"
        )


def _scores(rows: pa.Table, looked: pa.Table) -> pa.Table:
    order = np.argsort(looked["pair"].to_numpy(), kind="stable")
    n, best = looked["n"].to_numpy()[order], looked["best"].to_numpy(zero_copy_only=False)[order]
    out = []
    for at, k in zip(rows["pair_at"].combine_chunks(), rows["pair_n"].combine_chunks(), strict=True):
        at, k = (x.values.to_numpy().astype(np.int64) for x in (at, k))
        out.append((int(k.sum()), int(k[best[at]].sum()), int((k * n[at]).sum())))
    sums = np.array(out, np.int64).reshape(-1, 3)
    names = ("n_links", "n_best", "count_sum")
    return pa.table({c: rows[c] for c in ("block", "seq")} | {c: sums[:, i] for i, c in enumerate(names)})


def _texts_of_groups(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, marks: tuple) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of every group in order."""
    group = np.arange(len(a_sizes))
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_group, b_group = np.repeat(group, a_sizes), np.repeat(group, b_sizes)
    place = np.empty(len(a) + len(b), object)
    a_at = np.arange(len(a)) + (b_end - b_sizes)[a_group]
    b_at = np.arange(len(b)) + a_end[b_group]
    comma_a, bar, comma_b, semicolon = marks
    a_text, b_text = comma_a[a], comma_b[b]
    a_text[a_end - 1], b_text[b_end - 1] = bar[a[a_end - 1]], semicolon[b[b_end - 1]]
    place[a_at], place[b_at] = a_text, b_text
    return b"".join(place.tolist())[:-1]


def _marks(size: int) -> tuple:
    ids = [str(i).encode() for i in range(size)]
    return tuple(np.array([i + end for i in ids], object) for end in (b",", b"|", b",", b";"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [batch.column(c) for c in ("a_ids", "b_ids", "a_sizes", "b_sizes")]
        most = max([0, *(int(x.values.to_numpy().max()) for x in lists[:2] if len(x.values))])
        marks = _kept(f"marks {most.bit_length()}", lambda n=1 << most.bit_length(): _marks(n))
        rows = []
        for row in zip(*lists, strict=True):
            a, b, a_sizes, b_sizes = (x.values.to_numpy() for x in row)
            text = _texts_of_groups(a, b, a_sizes, b_sizes, marks) if len(a) else b""
            rows.append((len(a), len(b), len(a_sizes), hashlib.sha256(text).hexdigest() if len(a) else ""))
        n_a, n_b, n_groups, sha = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("block", "seq", "doc_id")),
             *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), pa.array(sha, pa.string())],
            names=["block", "seq", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"],
        )


def aligned_tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): how the two tokenizers' tokens align.

    Columns: doc_id, n_a, n_b, n_groups (byte offsets where tokens of both end),
    groups_sha256 (of the groups' ids as text), n_links (overlapping A and B tokens),
    n_best (links whose id pair is linked most often, over the corpus, of all pairs of
    its B id; ties count), count_sum (of the links' corpus-wide pair counts).

    A null or empty text, or one that either tokenizer doesn't spell byte for byte, has
    no tokens: zeros and an empty digest.  Repeated rows, and rows with a null
    doc_id, each get a row of their own and each count.  Very long texts are aligned
    whole.  An empty table gives no rows; further columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "token-alignment")
    found = Alignment(docs, a_path, b_path, scratch)
    ids = found.texts.select("block", "seq", "doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes")
    digested = "block long, seq int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string"
    with long_rows(docs.sparkSession):
        digests = scratch.table(ids.mapInArrow(_digests, digested), "digests")
        scores = scratch.table(found.link_scores(), "scores")
    return digests.join(scores, ["block", "seq"]).drop("block", "seq")
