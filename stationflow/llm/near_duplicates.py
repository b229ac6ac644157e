"""Near-duplicates by bottom-k sketches from one hash function.

1. Every document's distinct shingles are hashed once; its sketch is the ``k``
   smallest hashes.  Documents with equal sets are one class from here on.
2. Two sets of Jaccard similarity ``s`` share about ``s * k`` of the ``k``
   smallest hashes of their union, so linked ones share more than ``share`` of
   them but for a chance of 6e-7 (binomial).  Hence the rarest ``1 - share`` of a
   sketch's values suffice as its inverted-list entries (prefix principle):
   linked sets have one of them in common.  Values that many documents share
   come last in that order and stay out of the lists.
3. Lists up to ``short`` documents yield their pairs.  Documents in longer ones
   (large groups of copies, or texts made mostly of common passages) are listed
   again under ``keys`` combinations of ``grain`` retained values each; two sets
   of similarity 0.85 share none of these with a chance of 4e-6 if they are of
   one size, of 6e-4 if one holds the other.  A combination's documents are
   compared with the first of them, the one whose long lists are longest: the
   most central of a group of copies, which then comes first in most of the
   group's combinations and is like all of them.  Those less similar to it than
   ``loose`` are compared among themselves in further rounds, with four times as many
   first ones each time, until none is left; a list of copies costs one pair a
   document, one of unrelated documents all its pairs.  Pairs are filtered by
   the similarity that the union's sketch estimates.
4. The connected components of these candidates are clusters; no link leaves
   one.  Each cluster's texts come together once, in blocks of bounded size,
   and exact intersections of the full sets decide.  Blocks of a large cluster
   are compared with a few hub documents first; then only documents outside
   the cluster's main component meet all its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.components import connected_components
from stationflow.llm.scratch import Scratch, bounded_broadcast, small_batches

ship(__name__)


@dataclass(frozen=True)
class Params:
    """``threshold``: link at 100 * intersection >= threshold * union."""

    width: int = 5
    threshold: int = 85
    k: int = 64
    #: Share of the union's sketch that linked sets have in common (missed at 0.85 and k = 64 with a chance of 6e-7).
    share: float = 0.60
    #: Least estimate between a document and one of the first ones of its list.
    loose: float = 0.45
    short: int = 12
    keys: int = 60
    grain: int = 5
    block_docs: int = 1500
    block_bytes: int = 8 << 20


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words.

    A-Z are lower-cased, words are runs without ASCII white space; fewer words
    than ``width`` are one shingle; no words, no shingle.
    """
    words = (text or b"").lower().split()
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))] if words else [], dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for i in range(width):  # position-dependent mixing, then the usual 64-bit finaliser
        total = (total ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    total = (total ^ (total >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    total = (total ^ (total >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.unique(total ^ (total >> np.uint64(31)))


_FEATURES = "rid long, doc_id long, text_hash long, n_shingles long, key1 long, key2 long, bytes long, sketch array<long>"


def _features(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, doc_id, text_hash, text = batch.columns
            n, key1, key2, size, sketch = [], [], [], [], []
            for t in text:
                data = t.as_buffer() if t.is_valid else None
                data = data.to_pybytes() if data is not None else b""
                s = shingles(data, p.width)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                size.append(len(data))
                key1.append(int.from_bytes(digest[:8], "little", signed=True))
                key2.append(int.from_bytes(digest[8:], "little", signed=True))
                sketch.append(s[: p.k].view(np.int64))
            offsets = np.cumsum([0, *map(len, sketch)]).astype(np.int32)
            values = np.concatenate(sketch) if sketch else np.array([], np.int64)
            yield pa.RecordBatch.from_arrays(
                [rid, doc_id, text_hash, *(pa.array(x, pa.int64()) for x in (n, key1, key2, size)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                names=["rid", "doc_id", "text_hash", "n_shingles", "key1", "key2", "bytes", "sketch"],
            )

    return run


def _inverted_lists(sets: DataFrame, p: Params, scratch: Scratch) -> DataFrame:
    """(value, rid): the rarest values of each sketch that other sketches hold as well."""
    entries = sets.select("rid", F.size("sketch").alias("s"), F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    by_set = (
        entries.join(shared, "value")
        .groupBy("rid")
        .agg(F.first("s").alias("s"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))
    )
    # values of one document come first in the order but open no list
    length = F.expr(f"s - cast(ceil({p.share} * s) AS int) + 1 - (s - size(v))")
    return scratch.table(
        by_set.select("rid", F.explode(F.slice("v", 1, F.greatest(length, F.lit(0)))).alias("v")).select("v.value", "rid"),
        "lists",
    )


def _estimated(pairs: DataFrame, sets: DataFrame, p: Params, scratch: Scratch) -> DataFrame:
    """``pairs`` (a, b, least) whose share of the union's sketch that both sketches hold is ``least`` or more."""
    x = sets.select(F.col("rid").alias("a"), F.transform("sketch", _unsigned).alias("x"))
    y = sets.select(F.col("rid").alias("b"), F.transform("sketch", _unsigned).alias("y"))
    union = F.slice(F.array_sort(F.array_union("x", "y")), 1, p.k)
    both = F.array_intersect(F.array_intersect(union, F.col("x")), F.col("y"))
    near = pairs.join(x, "a").join(y, "b").where(F.size(both) >= F.col("least") * F.size(union))
    return scratch.table(near.select("a", "b"), "edges")


def _unsigned(v):
    """Longs in the order of the unsigned hashes they hold."""
    return v.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def _combinations(p: Params):
    """(rid, weight, sketch) -> (key, rid, weight): per key, the retained values that come first under ``grain`` reorderings."""
    rng = np.random.default_rng(11)
    odd = rng.integers(0, 1 << 63, p.keys * p.grain, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, weights = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keys = np.zeros((batch.num_rows, p.keys), np.uint64)
            for row, sketch in zip(keys, batch.column(2), strict=True):
                values = sketch.values.to_numpy().view(np.uint64)
                turned = values[None, :] * odd[:, None]
                turned = (turned ^ (turned >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                first = values[turned.argmin(axis=1)].reshape(p.keys, p.grain)
                for i in range(p.grain):
                    row ^= first[:, i]
                    row *= np.uint64(0x9E3779B97F4A7C15)
                    row ^= row >> np.uint64(31)
                row += np.arange(p.keys, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(rids, p.keys)), pa.array(np.repeat(weights, p.keys))],
                names=["key", "rid", "weight"],
            )

    return run


def _candidates(lists: DataFrame, sets: DataFrame, p: Params, scratch: Scratch) -> DataFrame:
    """Edges (a, b) of the candidate graph."""
    sizes = lists.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    sized = scratch.table(lists.join(sizes, "value"), "sized")
    members = sized.where(F.col("n") <= p.short).groupBy("value").agg(F.sort_array(F.collect_list("rid")).alias("m"))
    pairs = members.select(F.explode("m").alias("a"), "m").select(
        "a", F.explode(F.filter("m", lambda b: b > F.col("a"))).alias("b")
    )
    crowd = sized.where(F.col("n") > p.short).groupBy("rid").agg(F.sum("n").alias("weight"))
    crowd = sets.select("rid", "sketch").join(crowd, "rid").select("rid", "weight", "sketch")
    listed = scratch.table(crowd.mapInArrow(_combinations(p), "key long, rid long, weight long"), "combinations")
    return _starred(listed, sets, p, scratch, pairs.withColumn("least", F.lit(p.share)))


def _starred(listed: DataFrame, sets: DataFrame, p: Params, scratch: Scratch, pairs: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) within the combinations ``listed`` (key, rid); every document meets its like or all others.

    A third column, ``weight``, says which documents come first; without it the
    smallest ``rid`` does.  ``pairs`` (a, b, least) of short lists are estimated
    together with those of the first round, so that the sketches are joined once.
    """
    if "weight" not in listed.columns:
        listed = listed.withColumn("weight", F.lit(0))
    near, rest, firsts, few = [], listed, 1, 0
    while True:
        least = F.min_by("rid", F.struct(-F.col("weight"), "rid")).alias("least")
        sizes = rest.groupBy("key").agg(least, F.count("*").alias("n")).where("n > 1")
        sizes = scratch.table(sizes, "sizes")
        found = sizes.agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).first()
        if not found["n"]:
            break
        few = few or found["n"]
        last = firsts > 1 and found["pairs"] <= few  # no more pairs are left than the first round had: all at once
        # the least one, and others by their hash
        is_first = (F.col("rid") == F.col("least")) | (F.pmod(F.xxhash64("key", "rid"), F.col("n")) < firsts - 1)
        is_first = F.lit(True) if last else is_first
        dealt = scratch.table(rest.join(sizes, "key").select("key", "rid", "weight", "least", is_first.alias("is_first")), "dealt")
        if firsts == 1:  # the one first document came with the sizes
            met = dealt.where("NOT is_first").withColumnRenamed("least", "first")
        else:
            first = dealt.where("is_first").select("key", F.col("rid").alias("first"))
            met = dealt.join(first, "key").where("rid <> first AND (NOT is_first OR first < rid)")
            met = scratch.table(met.select("key", "rid", "first", "is_first"), "met")
        pair = F.least("first", "rid").alias("a"), F.greatest("first", "rid").alias("b")
        wanted = met.select(*pair, F.lit(p.loose).alias("least"))
        near.append(_estimated(_wanted(wanted if pairs is None else wanted.unionAll(pairs)), sets, p, scratch))
        pairs = None
        if last:
            break
        if firsts == 1:  # everyone met one document only
            rest = met.select("key", "rid", "weight", *pair).join(near[-1], ["a", "b"], "left_anti").select("key", "rid", "weight")
        else:
            linked = met.where("NOT is_first").select("key", "rid", *pair).join(near[-1], ["a", "b"], "left_semi")
            others = dealt.where("NOT is_first").select("key", "rid", "weight")
            rest = others.join(linked.select("key", "rid"), ["key", "rid"], "left_anti")
        rest = scratch.table(rest, "rest")
        firsts *= 4
    if pairs is not None:
        near.append(_estimated(_wanted(pairs), sets, p, scratch))
    return reduce(DataFrame.unionAll, near) if near else listed.select(F.col("key").alias("a"), F.col("rid").alias("b")).limit(0)


def _wanted(pairs: DataFrame) -> DataFrame:
    """Every pair once, with the least of its bounds."""
    return pairs.groupBy("a", "b").agg(F.min("least").alias("least"))


def _exact_links(sets: list[np.ndarray], threshold: int) -> np.ndarray:
    """Component numbers of bounded many sets under exact Jaccard links."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    common = values[counts > 1]
    shared = np.zeros((n, n), dtype=np.float32)
    at = [np.searchsorted(common, s[np.isin(s, common, assume_unique=True)]) for s in sets]
    step = 2048
    for low in range(0, len(common), step):
        part = np.zeros((n, step), dtype=np.float32)
        for i, a in enumerate(at):
            part[i, a[np.searchsorted(a, low) : np.searchsorted(a, low + step)] - low] = 1
        shared += part @ part.T
    both = shared.astype(np.int64)
    linked = 100 * both >= threshold * (sizes[:, None] + sizes[None, :] - both)
    label = np.full(n, -1)
    for i in range(n):
        if label[i] < 0:
            front = np.array([i])
            label[i] = i
            while len(front):
                front = np.flatnonzero(linked[front].any(axis=0) & (label < 0))
                label[front] = i
    return label


def _linked(p: Params):
    """Groups of (group, rid, text) that arrive in a row -> star edges (a, b) of their exact components."""

    def solve(rids: list[int], texts: list[bytes]) -> tuple[list[int], list[int]]:
        order = np.argsort(rids, kind="stable")
        rids, index = np.unique(np.array(rids)[order], return_index=True)
        sets = [shingles(texts[order[i]], p.width) for i in index]
        label = _exact_links(sets, p.threshold)
        moved = np.flatnonzero(label != np.arange(len(rids)))
        return rids[moved].tolist(), rids[label[moved]].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rids, texts = None, [], []

        def flush():
            a, b = solve(rids, texts) if len(rids) > 1 else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for group, rid, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != key:
                    yield flush()
                    key, rids, texts = group, [], []
                rids.append(rid)
                texts.append(text)
        yield flush()

    return run


def _solve(groups: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """Exact links within ``groups`` (group: string, rid); ``texts`` has (rid, text as binary)."""
    placed = groups.join(texts, "rid").select("group", "rid", "text")
    ordered = placed.repartition("group").sortWithinPartitions("group")
    return ordered.mapInArrow(_linked(p), "a long, b long")


def _placed(clusters: DataFrame, p: Params) -> DataFrame:
    """(cluster, rid, bytes, blocks, docs, mean, block): every document in one block, on average of ``block_bytes`` at most."""
    sizes = clusters.groupBy("cluster").agg(
        F.least(_parts(p), F.count("*")).alias("blocks"), F.count("*").alias("docs"), F.avg("bytes").alias("mean")
    )
    block = F.pmod(F.xxhash64("rid"), F.col("blocks")).alias("block")
    return clusters.join(sizes, "cluster").select("cluster", "rid", "bytes", "blocks", "docs", "mean", block)


def _parts(p: Params):
    """Number of parts that hold ``block_bytes`` and ``block_docs`` at most, if dealt evenly."""
    return F.greatest(F.ceil(F.sum("bytes") / p.block_bytes), F.ceil(F.count("*") / p.block_docs), F.lit(1))


def _group(*cols: str):
    return F.concat_ws("/", *(F.col(c).cast("string") for c in cols)).alias("group")


def _first_groups(placed: DataFrame, p: Params) -> DataFrame:
    """(group, rid): each block with a few hub documents, which together are no larger than a block.

    Hubs are at most twice as long as the cluster's mean; where that exceeds a
    block, there is one on average.
    """
    hubs = F.greatest(F.lit(1), F.least(F.lit(64), F.floor(p.block_bytes / F.greatest("mean", F.lit(1)))))
    chosen = placed.where("blocks > 1 AND bytes <= 2 * mean").where(F.pmod(F.xxhash64("rid", F.lit(1)), F.col("docs")) < hubs)
    everywhere = chosen.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("to <> block")
    everywhere = everywhere.select("cluster", "rid", F.col("to").alias("block"))
    return placed.select("cluster", "rid", "block").unionAll(everywhere).select(_group("cluster", "block"), "rid")


def _second_groups(apart: DataFrame, large: DataFrame, p: Params) -> DataFrame:
    """(group, rid): every part of ``apart`` with every block of its cluster in ``large``; parts are no larger than blocks."""
    parts = apart.groupBy("cluster").agg(F.least(_parts(p), F.count("*")).alias("parts"))
    side = apart.join(parts, "cluster").select(
        "cluster",
        "rid",
        F.pmod(F.xxhash64("rid", F.lit(2)), F.col("parts")).alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    whole = large.join(parts, "cluster").select(
        "cluster", "rid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block"
    )
    return side.unionByName(whole).select(_group("cluster", "part", "block"), "rid").distinct()


def _verified(clusters: DataFrame, texts: DataFrame, p: Params, scratch: Scratch) -> DataFrame:
    """(node, root): components of the exact link graph; ``clusters``: (cluster, rid, bytes)."""
    placed = scratch.table(_placed(clusters, p), "blocks")
    large = placed.where("blocks > 1")
    label = connected_components(_solve(_first_groups(placed, p), texts, p), scratch)
    if large.isEmpty():
        return label

    rooted = large.join(label, F.col("rid") == F.col("node"), "left").select(
        "cluster", "rid", "bytes", "blocks", F.coalesce("root", "rid").alias("root")
    )
    counts = rooted.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    apart = rooted.join(main, "cluster").where("root <> main").select("cluster", "rid", "bytes", "blocks")
    apart = scratch.table(apart, "apart")
    if apart.isEmpty():
        return label
    known = label.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return connected_components(known.unionAll(_solve(_second_groups(apart, large, p), texts, p)), scratch)


def near_duplicates(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """Classes of near-duplicate documents; one row per document of ``docs`` (doc_id, text).

    Columns: doc_id, n_shingles (size of the set of shingles), component_id
    (smallest doc_id reachable over links, its own included), kept
    (``doc_id = component_id``), text_hash (``xxhash64`` of the text),
    representative (true for exactly one document of each component: the one
    of the smallest doc_id, nulls last, then text_hash).

    A document is a (doc_id, text); repeated rows are one document.  A null,
    empty or blank text has no shingles and is linked with nothing, also not
    with another such text.  Documents of one doc_id and different texts have a
    row each.  A null doc_id takes part; component_id is null only where every
    doc_id of the component is.  Further columns are not read.
    """
    p = params or Params()
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    small_batches(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    rows = keyed.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text_hash", F.col("text").cast("binary"))
    features = scratch.table(rows.mapInArrow(_features(p), _FEATURES), "features")

    with_words = features.where("n_shingles > 0")
    same = with_words.groupBy("key1", "key2", "n_shingles").agg(F.min("rid").alias("first"))
    classes = scratch.table(
        with_words.select("rid", "key1", "key2", "n_shingles").join(same, ["key1", "key2", "n_shingles"]).select("rid", "first"),
        "classes",
    )
    sets = scratch.table(
        features.select("rid", "sketch", "bytes", "doc_id", "text_hash")
        .join(classes.where("rid = first"), "rid")
        .drop("first"),
        "sets",
    )
    lists = _inverted_lists(sets.select("rid", "sketch"), p, scratch)
    edges = _candidates(lists, sets, p, scratch)
    member = connected_components(edges, scratch)
    clusters = member.select(F.col("root").alias("cluster"), F.col("node").alias("rid")).unionAll(
        member.select(F.col("root").alias("cluster"), F.col("root").alias("rid")).distinct()
    )
    clusters = scratch.table(
        clusters.join(sets.select("rid", "bytes", "doc_id", "text_hash"), "rid"), "clusters"
    )
    wanted = clusters.select("rid", F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")
    source = keyed.select(F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash", F.col("text").cast("binary").alias("text"))
    texts = source.join(bounded_broadcast(wanted, 32), ["id", "text_hash"]).select("rid", "text")
    root = _verified(clusters.select("cluster", "rid", "bytes"), texts, p, scratch)

    rooted = features.select("rid", "doc_id", "text_hash", "n_shingles").join(classes, "rid", "left")
    rooted = rooted.join(root, F.col("first") == F.col("node"), "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("root", "first", "rid").alias("root")
    )
    rooted = scratch.table(rooted.groupBy("doc_id", "text_hash").agg(F.first("n_shingles").alias("n_shingles"), F.min("root").alias("root")), "rooted")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    # written before the join: beside an aggregate in its stage, AQE can't split a hot root
    least = scratch.table(rooted.groupBy("root").agg(F.min(order).alias("least")), "least")
    return rooted.join(bounded_broadcast(least, 48), "root").select(
        "doc_id",
        "n_shingles",
        F.col("least.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("least.doc_id")).alias("kept"),
        "text_hash",
        (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))).alias(
            "representative"
        ),
    )


def distinct_documents(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """One row of ``docs`` per component, with all its columns: the representative's.

    Of repeated rows (same doc_id and text) one is kept, whichever it is in the
    other columns.
    """
    gone = near_duplicates(docs, params).where("NOT representative").select("doc_id", "text_hash")
    gone = Scratch(docs.sparkSession, "distinct-documents").table(gone.toDF("gone_id", "gone_hash"), "gone")
    # the user's columns are packed into one, so that none can clash with ours
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), F.struct("*").alias("row"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash"))
    kept = rows.join(bounded_broadcast(gone, 32), same, "left_anti")
    repeats = kept.groupBy("id", "hash").agg(F.count("*").alias("n")).where("n > 1")
    if not repeats.isEmpty():
        kept = kept.dropDuplicates(["id", "hash"])
    return kept.select("row.*")
