"""Benchmark decontamination with a distributed positional inverted index.

The index holds one posting (row, position, term) for every corpus word that
also occurs in the benchmark.  It is partitioned by document, as the input is:
every task writes the postings of the documents it reads, so building it moves
no data.  Matching works on the postings:

1. term frequencies come from the whole index; in each window of a benchmark
   item the two rarest words are its anchors;
2. the anchors' postings, shifted by the word's offset in the item, give
   alignments (row, item, start); only those where both anchors of a window
   meet at the same start go on;
3. for these the postings of all item words are intersected at their adjusted
   positions; windows that are there whole are exact phrase matches;
4. anchors of an item that meet within ``slop`` words of their offsets, without
   the whole phrase, are proximity matches.

Only built-in DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.scratch import Scratch, bounded_broadcast
from stationflow.llm.words import lower_ascii, split_words, word_count

WINDOW = 13
ANCHORS = 2
SLOP = 4


def benchmark_items(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(iid, item_id, words, n, starts, len) of the items that have words; ``iid`` is a row number."""
    words = F.filter(F.col("raw"), lambda w: w != "")
    return (
        benchmark.select(
            F.monotonically_increasing_id().alias("iid"),
            F.col("item_id").cast("string").alias("item_id"),
            split_words(F.col("text")).alias("raw"),
        )
        .select("iid", "item_id", F.transform(words, lower_ascii).alias("words"))
        .withColumn("n", F.size("words"))
        .where("n > 0")
        .withColumn("len", F.least("n", F.lit(window)))
        .withColumn("starts", F.sequence(F.lit(0), F.col("n") - F.col("len")))
    )


def build_index(docs: DataFrame, vocabulary: DataFrame, scratch: Scratch) -> DataFrame:
    """Postings (rid, pos, term, doc_id, n_words), written document by document.

    Position 0 of every row is a header posting without a term that carries
    ``doc_id`` and ``n_words``; word ``i`` stands at position ``i + 1``.
    ``vocabulary`` has the distinct lower-cased benchmark words as ``word``.
    """
    words = split_words(F.col("text"))
    known = vocabulary.select("word", F.xxhash64("word").alias("term")).unionAll(
        vocabulary.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(None).cast("long").alias("term"))
    )
    split = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", words.alias("words"))
    each = split.select("rid", "doc_id", word_count(F.col("words")).alias("n_words"), F.posexplode("words"))
    postings = (
        each.withColumn("word", lower_ascii(F.col("col")))
        .join(bounded_broadcast(known, F.octet_length("word") + 64), "word")
        .where("pos = 0 OR term IS NOT NULL")
    )
    header = F.col("pos") == 0
    return scratch.table(
        postings.select(
            "rid",
            "pos",
            "term",
            F.when(header, F.col("doc_id")).alias("doc_id"),
            F.when(header, F.col("n_words")).alias("n_words"),
        ),
        "index",
    )


def window_anchors(items: DataFrame, frequencies: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """(iid, item_id, len, starts, terms, anchors): per window the offsets of its rarest words."""
    words = items.select("iid", F.posexplode("words").alias("off", "word"))
    counted = words.select("iid", "off", F.xxhash64("word").alias("term")).join(frequencies, "term", "left")
    entry = F.struct(F.col("off"), F.coalesce("freq", F.lit(0)).alias("freq"), F.col("term"))
    sorted_words = counted.groupBy("iid").agg(F.sort_array(F.collect_list(entry)).alias("at"))

    def rarest(start: Column) -> Column:
        inside = F.slice("at", start + 1, F.col("len"))
        by_freq = F.array_sort(F.transform(inside, lambda e: F.struct(e["freq"].alias("freq"), e["off"].alias("off"))))
        return F.transform(F.slice(by_freq, 1, anchors), lambda e: e["off"])

    return items.join(sorted_words, "iid").select(
        "iid", "item_id", "len", "starts", F.col("at.term").alias("terms"), F.transform("starts", rarest).alias("anchors")
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, anchors: int = ANCHORS, slop: int = SLOP
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) against ``benchmark`` (item_id, text).

    Columns: doc_id, n_words, n_hit (words inside any occurrence of a window),
    n_items (items with occurring windows), items_sha256 (of their ids, sorted as
    strings and comma-joined; of the empty string without any), contaminated
    (``n_hit > 0`` and ``20 * n_hit >= n_words``), n_near (items whose anchors
    meet within ``slop`` words of their offsets, exact ones included).

    A null or wordless text has no words and is clean.  Repeated rows and rows
    with a null ``doc_id`` each get a row of their own.  Items without words
    match nothing; items with a null id count as hits but not as items; items
    of one id count once.  Further columns of either table are not read.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    items = scratch.table(benchmark_items(benchmark.select("item_id", "text"), window), "items")
    vocabulary = scratch.table(items.select(F.explode("words").alias("word")).distinct(), "vocabulary")
    index = build_index(docs.select("doc_id", "text"), vocabulary, scratch)
    postings = index.where("pos > 0").select("rid", (F.col("pos") - 1).alias("pos"), "term")

    frequencies = postings.groupBy("term").agg(F.count("*").alias("freq"))
    plan = scratch.table(window_anchors(items, frequencies, anchors), "anchors")

    offsets = plan.select("iid", "terms", F.explode(F.array_distinct(F.flatten("anchors"))).alias("off"))
    lookups = scratch.table(
        offsets.select(F.element_at("terms", F.col("off") + 1).alias("term"), "iid", "off").distinct(), "lookups"
    )
    hits = postings.join(bounded_broadcast(lookups, 24), "term").select(
        "rid", "iid", (F.col("pos") - F.col("off")).alias("start"), "off"
    )
    # an item's row holds its words, their anchors and its window starts
    plan = bounded_broadcast(plan, 200 + F.size("terms") * (16 + 16 * anchors))
    aligned = scratch.table(_alignments(hits, plan, slop), "alignments")

    starts = aligned.where("exact").select("rid", "iid", "start")
    rows = scratch.table(starts.select("rid").distinct(), "rows")
    wanted = starts.join(plan.select("iid", "terms"), "iid").select(
        "rid", "iid", "start", F.posexplode("terms").alias("off", "term")
    )
    near_rows = postings.join(bounded_broadcast(rows, 16), "rid", "left_semi")
    found = (
        wanted.withColumn("pos", F.col("start") + F.col("off"))
        .join(near_rows, ["rid", "pos", "term"])
        .groupBy("rid", "iid", "start")
        .agg(F.collect_set("off").alias("got"))
        .join(plan.select("iid", "item_id", "len", "starts"), "iid")
    )
    whole = F.filter(
        "starts", lambda s: F.size(F.array_intersect(F.sequence(s, s + F.col("len") - 1), F.col("got"))) == F.col("len")
    )
    exact = scratch.table(
        found.select("rid", "item_id", "start", "len", whole.alias("at")).where(F.size("at") > 0), "matches"
    )

    covered = exact.select("rid", "start", "len", F.explode("at").alias("s")).select(
        "rid", F.explode(F.sequence(F.col("start") + F.col("s"), F.col("start") + F.col("s") + F.col("len") - 1)).alias("pos")
    )
    n_hit = covered.distinct().groupBy("rid").agg(F.count("*").alias("n_hit"))
    by_item = exact.groupBy("rid").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    near = aligned.where("near").select("rid", "iid").distinct().groupBy("rid").agg(F.count("*").alias("n_near"))

    header = index.where("pos = 0").select("rid", "doc_id", "n_words")
    joined = header.join(n_hit, "rid", "left").join(by_item, "rid", "left").join(near, "rid", "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("ids", none)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("ids", none)), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("any"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    ).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        (F.col("any") & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "n_near",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with all their columns.

    A row goes if its doc_id and text are those of a contaminated row.
    """
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc_id"), "text")
    bad = decontaminate(keyed, benchmark, **options).where("contaminated").select("doc_id.*").distinct()
    bad = Scratch(docs.sparkSession, "decontaminated").table(bad.toDF("bad_id", "bad_hash"), "rejected")
    # the user's columns are packed into one, so that none can clash with ours
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), F.struct("*").alias("row"))
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("hash") == F.col("bad_hash"))
    return rows.join(bounded_broadcast(bad, 32), same, "left_anti").select("row.*")


def _alignments(hits: DataFrame, plan: DataFrame, slop: int) -> DataFrame:
    """(rid, iid, start, exact, near) where all anchors of some window meet.

    ``exact``: at one start.  ``near``: at starts less than ``slop`` apart; every
    start is dealt to two overlapping ranges of ``2 * slop`` words, so any such
    set of anchors shares a range.
    """
    by_start = hits.groupBy("rid", "iid", "start").agg(F.collect_set("off").alias("got"))
    joined = by_start.join(plan.select("iid", "anchors"), "iid")
    complete = F.exists("anchors", lambda w: F.size(F.array_except(w, F.col("got"))) == 0)
    ranges = F.array(F.floor(F.col("start") / (2 * slop)) * 2, F.floor((F.col("start") + slop) / (2 * slop)) * 2 - 1)
    exact = joined.where(complete).select("rid", "iid", "start", F.lit(True).alias("exact"), F.lit(True).alias("near"))
    loose = (
        joined.where(~complete)
        .select("rid", "iid", "anchors", "got", F.explode(ranges).alias("range"))
        .groupBy("rid", "iid", "range")
        .agg(F.array_distinct(F.flatten(F.collect_list("got"))).alias("got"), F.first("anchors").alias("anchors"))
        .where(complete)
        .select("rid", "iid", F.lit(None).cast("int").alias("start"), F.lit(False).alias("exact"), F.lit(True).alias("near"))
    )
    return exact.unionAll(loose)
