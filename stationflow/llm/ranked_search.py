"""Ranked search over an inverted index whose terms are dealt to successive owners.

The index is built where the documents are read: a task cuts them into slices of
bounded size and writes, per slice and query term, the documents that hold it and how
often.  Terms are owned by stages by how many documents hold them, rarest first, so
an owner's postings stay within its share of the corpus.

Items travel in bundles.  A bundle enters a stage with the sparse accumulators it has
gathered for a slice (documents and integer scores), meets the owner's postings of
that slice in a cogroup, adds their contributions and leaves for the next owner.
After a stage the largest partial scores of an item over all slices give a score its
best documents have for certain; accumulators that can't reach it with all that the
later owners could add are left behind, and no new ones open once even a document that
holds every remaining term couldn't reach it.  Both are exact: ties are kept.
The last stage's scores are selected per slice, then per item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.scratch import Scratch, bounded_broadcast

ship(__name__)

TOP = 20
#: Documents and postings of a slice (a document of more terms is a slice of its own).
SLICE_DOCS, SLICE_POSTINGS = 4096, 2_000_000
#: Items that travel together: a slice's bundle has so many rows of accumulators at most.
BUNDLE = 256
#: An owner's terms are held by at most one in so many documents; the last one owns the others.
OWNERS = (1000, 50)
#: Smallest value of a document's length factor.
LEAST_M = 75

_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The text's terms: runs of digits, ASCII letters (lower-cased) and characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = Counter(terms(text))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([item] * len(counts), pa.int64()),
                    pa.array(list(counts), pa.binary()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["item", "term", "times"],
            )


def query_items(items: DataFrame, scratch: Scratch, bundle: int = BUNDLE) -> tuple[DataFrame, DataFrame, int]:
    """(item, item_id) of every item, (item, bundle, term, times) of its terms, and the number of bundles.

    ``item`` numbers the distinct rows of (item_id, text); its hash deals it to a bundle.
    """
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    known = scratch.table(rows.distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    found = known.select("item", "text").mapInArrow(_item_rows, "item long, term binary, times long")
    bundles = max(1, -(-known.count() // bundle))
    asked = found.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int"))
    return known.select("item", "item_id"), scratch.table(asked, "item-terms"), bundles


_INDEX = "slice long, term binary, at binary, times binary, most long, doc_ids array<long>, sizes array<long>, words long"


def _index(known: frozenset[bytes] | None):
    def slice_rows(number: int, doc_ids: list, counted: list[tuple[int, dict]]) -> pa.RecordBatch:
        lists: dict[bytes, tuple[list[int], list[int]]] = {}
        for at, (_, counts) in enumerate(counted):
            for term, n in counts.items():
                places, times = lists.setdefault(term, ([], []))
                places.append(at)
                times.append(n)
        sizes, k = [n for n, _ in counted], len(lists)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number] * (k + 1), pa.int64()),
                pa.array([*lists, None], pa.binary()),
                pa.array([*(np.array(p, "<i4").tobytes() for p, _ in lists.values()), None], pa.binary()),
                pa.array([*(np.array(t, "<i4").tobytes() for _, t in lists.values()), None], pa.binary()),
                pa.array([*(max(t) for _, t in lists.values()), None], pa.int64()),
                pa.array([None] * k + [doc_ids], pa.list_(pa.int64())),
                pa.array([None] * k + [sizes], pa.list_(pa.int64())),
                pa.array([None] * k + [sum(sizes)], pa.int64()),
            ],
            names=[part.split()[0] for part in _INDEX.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, doc_ids, counted, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                found = terms(text.as_py())
                if not found:
                    continue
                if counted and (len(counted) >= SLICE_DOCS or size >= SLICE_POSTINGS):
                    yield slice_rows(number, doc_ids, counted)
                    number, doc_ids, counted, size = number + 1, [], [], 0
                counts = Counter(found)
                if known is not None:
                    counts = {t: counts[t] for t in known.intersection(counts)}
                doc_ids.append(doc_id.as_py())
                counted.append((len(found), counts))
                size += len(counts)
        if counted:
            yield slice_rows(number, doc_ids, counted)

    return run


def build_index(docs: DataFrame, vocabulary: DataFrame, scratch: Scratch, limit: int = 8 << 20) -> DataFrame:
    """Postings (slice, term, at, times, most) and one header a slice (doc_ids, sizes, words; no term).

    ``at`` are places in the header's lists, ``times`` the term's occurrences there,
    both little-endian 32-bit; documents without any term have no place.  ``vocabulary``
    (term) is handed to the tasks if it measures ``limit`` bytes at most; else all
    terms are posted and the others left out by a join.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = vocabulary.agg(F.sum(F.octet_length("term") + 64).alias("n")).first()["n"] or 0
    known = frozenset(bytes(r.term) for r in vocabulary.toLocalIterator()) if size <= limit else None
    index = scratch.table(rows.mapInArrow(_index(known), _INDEX), "index")
    if known is not None:
        return index
    asked = index.join(vocabulary, "term", "left_semi").select(*index.columns)
    return scratch.table(asked.unionAll(index.where("term IS NULL")), "asked-index")


def _contribution(times, m):
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


def _stage(docs_total: int, words_total: int, last: bool, top: int):
    """One owner's work on a slice: accumulators of a bundle and the owner's postings -> accumulators."""

    def run(key: tuple, bundle: pa.Table, owned: pa.Table) -> pa.Table:
        slice_, number = (k.as_py() for k in key)
        header = owned.filter(pc.is_null(owned["term"]))
        none = pa.table({c: pa.array([], t) for c, t in _BUNDLE_TYPES.items()})
        if not header.num_rows:
            return none
        sizes = header["sizes"][0].values.to_numpy()
        m = LEAST_M + (25 * sizes * docs_total) // words_total
        items = sorted({*bundle["item"].to_pylist()})
        row = {item: i for i, item in enumerate(items)}
        scores = np.zeros((len(items), len(sizes)), np.int64)
        opened = np.zeros((len(items), len(sizes)), bool)
        opens, floor, rest = (np.zeros(len(items), np.int64) for _ in range(3))
        for r in bundle.to_pylist():
            i = row[r["item"]]
            at = np.frombuffer(r["at"], "<i4")
            scores[i, at] = np.frombuffer(r["scores"], "<i8")
            opened[i, at] = True
            opens[i], floor[i], rest[i] = r["opens"], r["floor"], r["rest"]
        for r in owned.to_pylist():
            if r["term"] is None:
                continue
            at, times = (np.frombuffer(r[c], "<i4") for c in ("at", "times"))
            gain = r["weight"] * _contribution(times.astype(np.int64), m[at])
            for item, n in zip(r["items"], r["item_times"], strict=True):
                if item in row:
                    scores[row[item], at] += n * gain
        scores[(opens == 0)[:, None] & ~opened] = 0
        if last:
            keep = scores > 0
        else:
            keep = (scores > 0) & (scores + rest[:, None] >= floor[:, None])
        out = {c: [] for c in _BUNDLE_TYPES}
        ids = header["doc_ids"][0].as_py() if last else None
        for item, i in row.items():
            at = np.flatnonzero(keep[i])
            if last:
                at = at[_best(scores[i, at], [ids[x] for x in at.tolist()], top)]
            values = scores[i, at]
            large = np.sort(values)[::-1][:top]
            out["slice"].append(slice_), out["bundle"].append(number), out["item"].append(item)
            out["at"].append(at.astype("<i4").tobytes()), out["scores"].append(values.astype("<i8").tobytes())
            out["large"].append(large.tolist())
            out["doc_ids"].append([ids[x] for x in at.tolist()] if last else [])
            out["values"].append(values.tolist() if last else [])
        return pa.table({c: pa.array(v, _BUNDLE_TYPES[c]) for c, v in out.items()})

    return run


def _best(values: np.ndarray, ids: list, top: int) -> list[int]:
    """Places of the ``top`` largest values, ties by id (null last)."""
    order = sorted(range(len(ids)), key=lambda x: (-values[x], ids[x] is None, ids[x] or 0)) if len(ids) <= 4 * top else None
    if order is None:
        least = np.partition(values, len(values) - top)[len(values) - top]
        near = np.flatnonzero(values >= least).tolist()
        order = sorted(near, key=lambda x: (-values[x], ids[x] is None, ids[x] or 0))
    return order[:top]


_BUNDLE_TYPES = {
    "slice": pa.int64(),
    "bundle": pa.int32(),
    "item": pa.int64(),
    "at": pa.binary(),
    "scores": pa.binary(),
    "large": pa.list_(pa.int64()),
    "doc_ids": pa.list_(pa.int64()),
    "values": pa.list_(pa.int64()),
}
_BUNDLE = "slice long, bundle int, item long, at binary, scores binary, large array<long>, doc_ids array<long>, values array<long>"


#: Columns of an owner's postings as they meet the bundles, and of a slice's header.
_OWNED, _HEADER = ("slice", "bundle", "term", "at", "times", "weight", "items", "item_times"), ("doc_ids", "sizes")


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = TOP, owners: tuple[int, ...] = OWNERS, bundle: int = BUNDLE
) -> DataFrame:
    """The ``top`` best ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Columns: item_id, rank (from 1), doc_id, score.  Terms, weights and scores are
    as the query's contract has them: a term's weight falls with the documents that hold
    it, a document's share with its length; repeated terms of an item count each time.
    Only scores above 0 are listed, equal ones by ascending doc_id.

    A null or wordless text has no terms: such a document isn't counted, such an item has
    no rows.  Repeated rows of ``docs`` are documents of their own; a null doc_id comes
    after all others of its score.  Equal rows of ``items`` are one item; rows of one
    item_id with different texts are ranked apart.  Very long texts are indexed whole.
    Empty tables give no rows; further columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "ranked-search")
    known, asked, bundles = query_items(items.select("item_id", "text"), scratch, bundle)
    vocabulary = scratch.table(asked.select("term").distinct(), "vocabulary")
    index = build_index(docs, vocabulary, scratch)
    headers, postings = index.where("term IS NULL"), index.where("term IS NOT NULL")
    total = headers.agg(F.sum(F.size("sizes")).alias("n"), F.sum("words").alias("l")).first()
    schema = "item_id long, rank int, doc_id long, score long"
    if not total["n"]:
        return docs.sparkSession.createDataFrame([], schema)
    n, words = int(total["n"]), int(total["l"])

    df, most = F.col("df"), F.col("most")
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * df + 1))).cast("long")
    owner = F.lit(len(owners))
    for number, share in reversed(list(enumerate(owners))):
        owner = F.when(df * share <= n, number).otherwise(owner)
    held = postings.groupBy("term").agg(
        F.sum(F.octet_length("at") / 4).cast("long").alias("df"), F.max("most").alias("most")
    )
    stats = scratch.table(
        held.select(
            "term",
            weight.alias("weight"),
            owner.alias("owner"),
            # no document gains more by the term than one of the least length factor that holds it most often
            (weight * F.floor(1_000_000_000 * most / (1000 * most + 12 * LEAST_M) + 1).cast("long")).alias("bound"),
        ).where("weight > 0"),
        "terms",
    )
    wanted = asked.join(stats, "term")
    bounds = wanted.groupBy("item", "bundle", "owner").agg(F.sum(F.col("times") * F.col("bound")).alias("bound"))
    stages = len(owners) + 1
    later = [F.sum(F.when(F.col("owner") > s, F.col("bound")).otherwise(0)).alias(f"after{s}") for s in range(-1, stages)]
    limits = scratch.table(bounds.groupBy("item", "bundle").agg(*later).withColumnRenamed("after-1", "after_none"), "limits")

    asked_terms = scratch.table(
        wanted.groupBy("term", "bundle", "weight", "owner").agg(
            F.sort_array(F.collect_list(F.struct("item", "times"))).alias("entries")
        ).select("term", "bundle", "weight", "owner", F.col("entries.item").alias("items"), F.col("entries.times").alias("item_times")),
        "asked",
    )
    # every bundle visits every slice, whose header goes with it
    places = headers.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))))
    state, floors = None, None
    for stage in range(stages):
        own = bounded_broadcast(
            asked_terms.where(F.col("owner") == stage).drop("owner"), 64 + F.octet_length("term") + 16 * F.size("items")
        )
        owned = postings.join(own, "term").select(*_OWNED, *(F.lit(None).cast("array<long>").alias(c) for c in _HEADER))
        lead = [F.lit(None).cast(kind).alias(c) for c, kind in zip(_OWNED[5:], ("long", *["array<long>"] * 2), strict=True)]
        owned = owned.unionAll(places.select(*_OWNED[:5], *lead, *_HEADER))
        after = F.col("after_none" if stage == 0 else f"after{stage - 1}")
        limit = limits.select("item", "bundle", after.alias("before"), F.col(f"after{stage}").alias("rest"))
        if floors is not None:
            limit = limit.join(floors, "item", "left")
        else:
            limit = limit.withColumn("floor", F.lit(0).cast("long"))
        limit = scratch.table(
            limit.select(
                "item", "bundle", "rest", F.coalesce("floor", F.lit(0)).cast("long").alias("floor"),
                (F.col("before") >= F.coalesce("floor", F.lit(0))).cast("long").alias("opens"),
            ),
            "stage-limits",
        )
        owned = owned.withColumnsRenamed({"slice": "own_slice", "bundle": "own_bundle"})
        entering = _bundles(state, places, limit)
        work = _stage(n, words, stage + 1 == stages, top)
        state = scratch.table(
            entering.groupBy("slice", "bundle").cogroup(owned.groupBy("own_slice", "own_bundle")).applyInArrow(work, _BUNDLE),
            "state",
        )
        if stage + 1 < stages:
            best = Window.partitionBy("item").orderBy(F.desc("large"))
            ranked = state.select("item", F.explode("large").alias("large")).withColumn("r", F.row_number().over(best))
            floors = scratch.table(
                ranked.where(F.col("r") <= top).groupBy("item").agg(
                    F.when(F.count("*") == top, F.min("large")).alias("floor")
                ),
                "floors",
            )
    found = state.select("item", F.explode(F.arrays_zip("doc_ids", "values")).alias("e"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.select("item", F.col("e.doc_ids").alias("doc_id"), F.col("e.values").alias("score")).withColumn(
        "rank", F.row_number().over(order)
    )
    chosen = scratch.table(ranked.where(F.col("rank") <= top), "chosen")
    return chosen.join(known, "item").select("item_id", "rank", "doc_id", "score")


def _bundles(state: DataFrame | None, places: DataFrame, limit: DataFrame) -> DataFrame:
    """What enters a stage: a row per slice and item, with the accumulators the earlier owners left."""
    limit = bounded_broadcast(limit, 64)
    if state is None:
        rows = places.select("slice", "bundle").join(limit, "bundle")
        nothing = F.lit(b"")
        return rows.select("slice", "bundle", "item", nothing.alias("at"), nothing.alias("scores"), "opens", "floor", "rest")
    rows = state.select("slice", "bundle", "item", "at", "scores").join(limit.drop("bundle"), "item")
    return rows.where("opens = 1 OR octet_length(at) > 0").select(
        "slice", "bundle", "item", "at", "scores", "opens", "floor", "rest"
    )
