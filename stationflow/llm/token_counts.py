"""Edit-aware token counts with a kept segment tree per document.

A text is cut into leaves at places that every encoding respects: before white
space that follows something else, which the pre-tokenizer never joins across.
The trees are a table with a row per block of leaves, which holds their texts,
their tokens and the block's sums; the blocks' sums add up to the root.  Edits
are first put together to disjoint replacements of the text as it was.  Sums
lead to the blocks they touch; of these, only the leaves that an edit touches
and those whose boundary it may move are cut and encoded anew.  All other rows
of the table stay as they are.
"""

from __future__ import annotations

import base64
import re
import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.scratch import BROADCAST_BYTES, Scratch, small_batches

ship(__name__)

#: Characters of a leaf, at least, before it may end.
LEAF = 400
#: Leaves of a block.
FAN = 64

# Fixed by the vocabulary file: how texts are cut into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=\S)(?=[ \n\t])")


def token_counter(path: str):
    """text -> number of tokens; the vocabulary is loaded once per Python worker."""
    kept = sys.modules.setdefault("_stationflow_counters", types.ModuleType("_stationflow_counters")).__dict__
    if path not in kept:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        kept[path] = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = kept[path].encode_ordinary
    return lambda text: len(encode(text))


def leaves(text: str, least: int = LEAF) -> list[str]:
    """Consecutive pieces of ``text`` of ``least`` characters or more, cut where no token crosses."""
    found, start = [], 0
    while len(text) - start > least and (cut := _CUT.search(text, start + least)):
        found.append(text[start : cut.start()])
        start = cut.start()
    return [*found, text[start:]]


_EDITS = "array<struct<start:long,stop:long,text:string>>"
_BLOCK = {
    "tree": pa.int64(), "doc_id": pa.int64(), "block": pa.int64(), "chars": pa.int64(), "tokens": pa.int64(),
    "leaves": pa.int64(), "blocks": pa.int64(), "leaf_tokens": pa.list_(pa.int64()), "leaf_text": pa.list_(pa.string()),
}
_CHANGED = _BLOCK | {"tokens_before": pa.int64(), "leaves_before": pa.int64(), "chars_encoded": pa.int64()}
_BLOCK_DDL = (
    "tree long, doc_id long, block long, chars long, tokens long, leaves long, blocks long, "
    "leaf_tokens array<long>, leaf_text array<string>"
)


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=[*types])


def _built(path: str):
    """(tree, doc_id, edits, text) -> blocks; the first block of a tree carries its ``edits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(path)
        for batch in batches:
            rows, first = [], []
            for i, (tree, doc_id, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)), strict=True)):
                pieces = leaves(text or "")
                blocks = -(-len(pieces) // FAN)
                for low in range(0, len(pieces), FAN):
                    part = pieces[low : low + FAN]
                    tokens = [count(p) for p in part]
                    rows.append((tree, doc_id, low // FAN, sum(map(len, part)), sum(tokens), len(part), blocks, tokens, part))
                    first.append(None if low else i)
            made = _batch(rows, _BLOCK)
            edits = batch.column(2).take(pa.array(first, pa.int64()))
            yield pa.RecordBatch.from_arrays([*made.columns, edits], names=[*_BLOCK, "edits"])

    return run


def build_trees(docs: DataFrame, vocabulary: str, scratch: Scratch) -> DataFrame:
    """The trees of ``docs`` (doc_id, text and, if there, edits), written: a row per block of ``FAN`` leaves at most.

    Columns: tree (unique per row of ``docs``), doc_id, block (from 0, in the
    order of the text), chars, tokens, leaves (sums of the block), blocks (of
    the tree as built; edits add none), leaf_tokens, leaf_text, edits (those of the row, with block 0; null elsewhere).  A null
    or empty text is one empty leaf.  Further columns are not read.
    """
    small_batches(docs.sparkSession)
    edits = F.col("edits") if "edits" in docs.columns else F.lit(None)
    rows = docs.select(
        F.monotonically_increasing_id().alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), edits.cast(_EDITS).alias("edits"), "text"
    )
    trees, path = rows.mapInArrow(_built(vocabulary), f"{_BLOCK_DDL}, edits {_EDITS}"), scratch.path("trees")
    trees.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(trees.schema).parquet(path)


def roots(trees: DataFrame) -> DataFrame:
    """(tree, doc_id, chars, tokens, leaves) of every document: the sums of its blocks' sums."""
    sums = [F.sum(c).alias(c) for c in ("chars", "tokens", "leaves")]
    return trees.groupBy("tree").agg(F.max("doc_id").alias("doc_id"), *sums)


def composed(edits, chars: int) -> list[tuple[int, int, str]]:
    """``edits`` ((start, stop, text), each of the text as edited so far) as disjoint ascending ones of the text of ``chars`` before.

    Positions are cut off at the text's ends; a null edit or position changes
    nothing, a null text deletes.
    """
    parts = [(0, chars, None)] if chars else []  # ranges of the text before, or new texts
    length = chars
    for edit in edits or ():
        if edit is None or edit[0] is None or edit[1] is None:
            continue
        start = min(max(edit[0], 0), length)
        stop = min(max(edit[1], start), length)
        new = edit[2] or ""
        left, right, at = [], [], 0
        for a, b, text in parts:
            size = b - a
            low, high = min(max(start - at, 0), size), min(max(stop - at, 0), size)
            if low:
                left.append((a, a + low, text and text[:low]))
            if high < size:
                right.append((a + high, b, text and text[high:]))
            at += size
        parts = [*left, *([(0, len(new), new)] if new else []), *right]
        length += len(new) - (stop - start)
    found, at, new = [], 0, ""
    for a, b, text in parts:
        if text is not None:
            new += text
        else:
            if a > at or new:
                found.append((at, a, new))
            at, new = b, ""
    return [*found, (at, chars, new)] if at < chars or new else found


def _plain(edits: list[dict | None] | None) -> list[tuple | None]:
    return [e and (e["start"], e["stop"], e["text"]) for e in edits or ()]


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    of = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("text", pa.string())]))
    for batch in batches:
        found = []
        for edits, chars in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            found.append([dict(zip(("start", "stop", "text"), e, strict=True)) for e in composed(_plain(edits), chars)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, of)], names=["tree", "edits"])


def _redone(blocks: list[tuple], edits: list[tuple[int, int, str]], count) -> list[tuple]:
    """Rows of ``_CHANGED`` of one tree's touched ``blocks`` (tree, doc_id, block, blocks, begin, leaf_tokens, leaf_text) under composed ``edits``."""
    items = []
    for n, (*_, begin, tokens, pieces) in enumerate(blocks):
        for t, piece in zip(tokens, pieces, strict=True):
            items.append((begin, piece, t, n))
            begin += len(piece)
    texts, sums, encoded = [[] for _ in blocks], [[] for _ in blocks], [0] * len(blocks)
    i = e = 0
    while i < len(items):
        start, text, tokens, n = items[i]
        end = start + len(text)
        if e == len(edits) or edits[e][0] > end:
            texts[n].append(text)
            sums[n].append(tokens)
            i += 1
            continue
        region, mine, reach = [text], [], -1
        while True:  # the leaves that edits reach, up to the one whose first boundary the last edit may move
            while e < len(edits) and edits[e][0] <= end:
                mine.append(edits[e])
                reach = edits[e][1]
                e += 1
            if i + 1 == len(items) or items[i + 1][0] > reach:
                break
            i += 1
            region.append(items[i][1])
            end += len(items[i][1])
        i += 1
        old, new, at = "".join(region), [], 0
        for a, b, text in mine:
            new += [old[at : a - start], text]
            at = b - start
        pieces = leaves("".join([*new, old[at:]]))
        texts[n] += pieces
        sums[n] += [count(p) for p in pieces]
        encoded[n] += sum(map(len, pieces))
    return [
        (tree, doc_id, block, sum(map(len, t)), sum(s), len(t), of, s, t, sum(was), len(was), again)
        for (tree, doc_id, block, of, _, was, _), t, s, again in zip(blocks, texts, sums, encoded, strict=True)
    ]


def _edited_alone(path: str):
    """Trees of one block (tree, doc_id, block, leaf_tokens, leaf_text, edits) -> changed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(path)
        for batch in batches:
            done = []
            for tree, doc_id, block, tokens, pieces, edits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = composed(_plain(edits), sum(map(len, pieces)))
                if found:
                    done += _redone([(tree, doc_id, block, 1, 0, tokens, pieces)], found, count)
            yield _batch(done, _CHANGED)

    return run


def _edited(path: str):
    """Marks (begin, edits) and blocks in the order of (tree, block), the mark first -> changed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(path)
        mark, group, edits = None, [], {}
        for batch in batches:
            done = []
            for tree, block, begin, marked, doc_id, blocks, tokens, pieces in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begin is not None:
                    mark = (tree, block, begin, marked)
                elif mark and mark[:2] == (tree, block):
                    if group and group[0][0] != tree:
                        done += _redone(group, [edits[start] for start in sorted(edits)], count)
                        group, edits = [], {}
                    group.append((tree, doc_id, block, blocks, mark[2], tokens, pieces))
                    edits |= {e["start"]: (e["start"], e["stop"], e["text"]) for e in mark[3] if e["text"] is not None}
            yield _batch(done, _CHANGED)
        yield _batch(_redone(group, [edits[start] for start in sorted(edits)], count), _CHANGED)

    return run


_CHANGED_DDL = f"{_BLOCK_DDL}, tokens_before long, leaves_before long, chars_encoded long"


def changed_blocks(trees: DataFrame, edits: DataFrame | None, vocabulary: str, scratch: Scratch) -> DataFrame:
    """The blocks of ``trees`` that ``edits`` (tree, edits: array of (start, stop, text)) touch, as they are afterwards.

    Without ``edits`` those that the trees were built with count; a tree of one
    block then is edited where it is read, as its row holds all there is to know.
    Columns: as of the trees, and tokens_before, leaves_before, chars_encoded.  A
    block whose leaves went into the one before has none left.  What an edit adds
    stays in its first block, of whatever size.  One row of ``edits`` a tree.
    """
    small_batches(trees.sparkSession)
    if edits is None:
        own = trees.where("blocks = 1 AND size(edits) > 0")
        own = own.select("tree", "doc_id", "block", "leaf_tokens", "leaf_text", "edits").mapInArrow(_edited_alone(vocabulary), _CHANGED_DDL)
        trees = trees.where("blocks > 1")
        return own.unionAll(changed_blocks(trees, trees.where("block = 0").select("tree", "edits"), vocabulary, scratch))
    plain = edits.select("tree", F.col("edits").cast(_EDITS).alias("edits")).where(F.size("edits") > 0)
    plan = plain.join(roots(trees).select("tree", "chars"), "tree").mapInArrow(_composed, f"tree long, edits {_EDITS}")
    before = Window.partitionBy("tree").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("begin")
    placed = trees.select("tree", "block", "chars", begin)
    touching = F.filter("edits", lambda e: (e["start"] <= F.col("begin") + F.col("chars")) & (e["stop"] >= F.col("begin")))
    once = lambda e: F.struct(  # noqa: E731  # the text goes with the block that holds the start
        e["start"].alias("start"), e["stop"].alias("stop"), F.when(e["start"] >= F.col("begin"), e["text"]).alias("text")
    )
    marks = placed.join(plan, "tree").select("tree", "block", "begin", F.transform(touching, once).alias("edits"))
    marks = scratch.table(marks.where(F.size("edits") > 0), "marks")

    blocks = trees.select("tree", "block", "doc_id", "blocks", "leaf_tokens", "leaf_text")
    if 32 * marks.count() <= BROADCAST_BYTES:  # few edits: other blocks stay where they are
        blocks = blocks.join(F.broadcast(marks.select("tree", "block")), ["tree", "block"], "left_semi")
    met = marks.unionByName(blocks, allowMissingColumns=True).select(
        "tree", "block", "begin", "edits", "doc_id", "blocks", "leaf_tokens", "leaf_text"
    )
    met = met.repartition("tree").sortWithinPartitions("tree", "block", F.col("begin").isNull())
    return met.mapInArrow(_edited(vocabulary), _CHANGED_DDL)


def edited_trees(trees: DataFrame, edits: DataFrame | None, vocabulary: str, scratch: Scratch) -> DataFrame:
    """``trees`` after ``edits``: the changed blocks, written, and the others as they were; see ``changed_blocks``."""
    changed = scratch.table(changed_blocks(trees, edits, vocabulary, scratch), "changed")
    keys = changed.select("tree", "block")
    keys = F.broadcast(keys) if 32 * keys.count() <= BROADCAST_BYTES else keys
    same = trees.select(*_BLOCK).join(keys, ["tree", "block"], "left_anti")
    return same.unionByName(changed.where("leaves > 0").select(*_BLOCK))


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Counts of ``docs`` (doc_id, text, edits: array of (start, stop, text)), a row per row.

    Columns: doc_id, n_edits, n_tokens_before, n_tokens (after all edits in
    their order), n_leaves, chars_encoded_again (by the edits).  ``start`` and
    ``stop`` are characters from 0 of the text as edited so far, cut off at its
    ends; a null edit or position changes nothing, a null replacement deletes.
    A null text is empty; null edits are none.  Repeated rows count alike.
    """
    scratch = Scratch(docs.sparkSession, "token-counts")
    trees = build_trees(docs, vocabulary, scratch)
    changed = changed_blocks(trees, None, vocabulary, scratch)
    moved = changed.groupBy("tree").agg(
        F.sum(F.col("tokens") - F.col("tokens_before")).alias("more_tokens"),
        F.sum(F.col("leaves") - F.col("leaves_before")).alias("more_leaves"),
        F.sum("chars_encoded").alias("chars_encoded"),
    )
    first = trees.where("block = 0").select("tree", F.greatest(F.size("edits"), F.lit(0)).alias("n"))
    whole = roots(trees).join(first, "tree")
    none = F.lit(0)
    return whole.join(moved, "tree", "left").select(
        "doc_id",
        F.coalesce("n", none).cast("long").alias("n_edits"),
        F.col("tokens").alias("n_tokens_before"),
        (F.col("tokens") + F.coalesce("more_tokens", none)).alias("n_tokens"),
        (F.col("leaves") + F.coalesce("more_leaves", none)).alias("n_leaves"),
        F.coalesce("chars_encoded", none).cast("long").alias("chars_encoded_again"),
    )


def derived_edits(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with three edits each that follow from the text alone:
    a deletion, a replacement by words of the text's own beginning, and an insertion at the end."""
    size = F.coalesce(F.char_length("text"), F.lit(0))
    place = lambda seed: F.pmod(F.xxhash64("doc_id", F.lit(seed)), size + 1).cast("int")
    beginning = F.coalesce(F.substring("text", 1, 40), F.lit(""))
    edit = lambda start, length, text: F.struct(
        start.alias("start"), (start + length).alias("stop"), text.alias("text")
    )
    return docs.select(
        "doc_id",
        "text",
        F.array(
            edit(place(1), F.lit(25), F.lit("")),
            edit(place(2), F.lit(10), beginning),
            edit(size, F.lit(0), F.concat(F.lit("\n"), beginning)),
        ).alias("edits"),
    )
