"""WARC archives: writing, and reading with boundary-chain verification.

Writing: Spark's text writer puts one record after the other; the line separator
is the two line ends that close a record.

Reading: Spark splits the archives at the version line that starts a record, so
every piece begins at a candidate offset, also where a payload holds that line.
A task knows the lengths of its pieces and thus their offsets within its split;
sums over the splits before give the offsets in the file.  A candidate's
Content-Length names its successor's offset.  Pointer jumping from offset 0,
first within each split and then across splits in doubling steps, marks the
candidates that are reachable; the others lie inside payloads and are rejected.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.scratch import Scratch, bounded_broadcast, small_batches

ship(__name__)

#: Payloads of this many bytes and more are stored once.
LEAST_SHARED = 1000

# Fixed by the format.
VERSION = "WARC/1.0\r\n"
END = "\r\n\r\n"
_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def _record_type() -> F.Column:
    return F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")


def archive_records(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(record): the text of one WARC record per row of ``pages`` (page_id, url, html), without its closing line ends.

    Rows of equal payloads of ``LEAST_SHARED`` bytes or more: that of the largest
    page_id is the response; the others have the headers alone and refer to it.
    Of rows that repeat this page_id every one is a response.
    """
    html = F.coalesce("html", F.lit(""))
    sized = pages.select("page_id", F.octet_length(html).alias("size"), F.sha1(html.cast("binary")).alias("digest"))
    large = scratch.table(sized.where(F.col("size") >= LEAST_SHARED).select("page_id", "digest"), "digests")
    shared = large.groupBy("digest").agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1")
    shared = scratch.table(shared, "shared")  # beside an aggregate in its stage, AQE can't split the join on a hot digest
    revisits = large.join(shared, "digest").where(~F.col("page_id").eqNullSafe(F.col("target")))
    revisits = scratch.table(revisits.select(F.col("page_id").alias("id"), "target", F.col("digest").alias("d")).distinct(), "revisits")
    payload = F.coalesce("html", F.lit("")).alias("payload")
    rows = pages.select(
        "page_id", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ").alias("url"), payload
    ).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    to = bounded_broadcast(revisits, 80)
    joined = rows.join(to, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d")), "left")
    joined = joined.withColumn("refers_to", F.col("target"))
    name = lambda page: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    size = F.octet_length("payload")
    revisit = F.col("refers_to").isNotNull()
    return joined.select(
        F.concat(
            F.lit(VERSION),
            line("WARC-Type", _record_type()),
            line("WARC-Record-ID", name(F.col("page_id"))),
            line("WARC-Target-URI", F.col("url")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            line("WARC-Payload-Length", size.cast("string")),
            F.when(revisit, line("WARC-Refers-To", name(F.col("refers_to")))).otherwise(""),
            line("Content-Type", F.lit("text/html; charset=utf-8")),
            line("Content-Length", F.when(revisit, 0).otherwise(size).cast("string")),
            F.lit("\r\n"),
            F.when(revisit, "").otherwise(F.col("payload")),
        ).alias("record")
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """One archive per input partition under ``path``; see ``archive_records``.  Null html is empty."""
    scratch = Scratch(pages.sparkSession, "warc-write")
    records = archive_records(pages.select("page_id", "url", "html"), scratch)
    records.write.option("lineSep", END).option("compression", "none").text(path)


_PIECE = {
    "file": "string", "split": "long", "at": "long", "size": "long", "next": "long", "exit": "long",
    "type": "string", "id": "string", "refers": "string", "length": "long", "digest": "string",
}
_ARROW = {"string": pa.string(), "long": pa.int64()}
_DDL = ", ".join(f"`{c}` {t}" for c, t in _PIECE.items())


def _headers(piece: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Headers of a piece and the offset of its payload, counted from the version line; None if it's no record."""
    head, blank, _ = piece.partition(b"\r\n\r\n")
    if not blank:
        return None
    return {k.lower(): v.strip() for k, v in _HEADER.findall(head + b"\r\n")}, len(VERSION) + len(head) + 4


def _piece_row(piece: bytes, at: int) -> dict:
    """What a piece says of itself as a record at offset ``at``."""
    row = dict.fromkeys(_PIECE) | {"at": at, "size": len(VERSION) + len(piece)}
    head, start = _headers(piece) or ({}, 0)
    stored = head.get(b"content-length", b"")
    if stored.isdigit():
        text = lambda key: head.get(key, b"").decode("utf-8", "replace") or None
        end = start + int(stored)
        length = head.get(b"warc-payload-length", stored)
        row |= {"next": at + end + len(END), "length": int(length) if length.isdigit() else int(stored)}
        row |= {"type": text(b"warc-type"), "id": text(b"warc-record-id"), "refers": text(b"warc-refers-to")}
        if row["type"] == "revisit":
            row["digest"] = (text(b"warc-payload-digest") or "").removeprefix("sha1:")
        elif end <= row["size"]:
            row["digest"] = hashlib.sha1(piece[start - len(VERSION) : end - len(VERSION)]).hexdigest()
    return row


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, split, at, piece) with offsets counted from the split's first piece, the version line included."""
    here, at = None, 0
    for batch in batches:
        for file, split, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, split) != here:
                here, at = (file, split), 0
            yield file, split, at, piece
            at += len(VERSION) + len(piece)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, split, piece) in file order -> one row per piece.

    ``next``: offset of the successor that a candidate names, null for none.
    ``exit``: where its chain leaves the split.  ``digest``: of the payload;
    null where the piece ends before it does.
    """
    for (file, split), pieces in groupby(_by_split(batches), key=lambda x: x[:2]):
        rows = [_piece_row(piece, at) | {"file": file, "split": split} for _, _, at, piece in pieces]
        place = {row["at"]: i for i, row in enumerate(rows)}
        for row in reversed(rows):  # successors lie behind, so their exits are known
            row["exit"] = rows[place[row["next"]]]["exit"] if row["next"] in place else row["next"]
        columns = [pa.array([r[c] for r in rows], _ARROW[t]) for c, t in _PIECE.items()]
        yield pa.RecordBatch.from_arrays(columns, names=list(_PIECE))


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, split, piece) -> (file, split, at, piece)."""
    for (file, split), pieces in groupby(_by_split(batches), key=lambda x: x[:2]):
        for file, split, at, piece in pieces:
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([split]), pa.array([at]), pa.array([piece], pa.binary())],
                names=["file", "split", "at", "piece"],
            )


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, piece): everything between two version lines, in file order within a split."""
    lines = spark.read.option("lineSep", VERSION).text(path)
    return lines.select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary"))


def _reached(jumps: DataFrame, files: DataFrame, scratch: Scratch) -> DataFrame:
    """(file, at) of the split entries on the chain from offset 0; ``jumps``: (file, at, to) over all entries.

    After round ``k`` the set holds the first ``2 ** k`` entries of every chain.
    """
    reached = scratch.table(files.select("file", F.lit(0).cast("long").alias("at")), "reached")
    known = reached.count()
    while True:
        ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = scratch.table(reached.unionAll(ahead).distinct(), "reached")
        if (now := reached.count()) == known:
            return reached
        known = now
        second = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("then"))
        jumps = scratch.table(jumps.join(second, ["file", "to"]).select("file", "at", F.col("then").alias("to")), "jumps")


def _on_chain(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The records of one split that a chain from one of its reached entries visits."""
    following = dict(zip(rows["at"], rows["next"], strict=True))
    seen: set[int] = set()
    for at in entries["at"]:
        while at in following and at not in seen and pd.notna(following[at]):
            seen.add(at)
            at = following[at]
    return rows[rows["at"].isin(seen)]


def _inside(pieces: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one split that belong to one of the records ``spans`` (at, next), which don't overlap."""
    spans = spans.sort_values("at")
    owner = spans["at"].to_numpy().searchsorted(pieces["at"].to_numpy(), side="right") - 1
    ok = (owner >= 0) & (pieces["at"].to_numpy() < spans["next"].to_numpy()[owner])
    found = pieces[ok]
    return found.assign(record=spans["at"].to_numpy()[owner[ok]])[["file", "record", "at", "piece"]]


def _assembled(rows: pd.DataFrame) -> pd.DataFrame:
    """The digest of one record's payload from all its pieces."""
    whole = VERSION.encode().join(rows.sort_values("at")["piece"])
    head, start = _headers(whole)
    end = start + int(head[b"content-length"])
    digest = hashlib.sha1(whole[start - len(VERSION) : end - len(VERSION)]).hexdigest()
    return pd.DataFrame({"file": [rows["file"].iloc[0]], "at": [rows["record"].iloc[0]], "put": [digest]})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files under ``path``: file, at (offset), next, type, id, refers, length, digest.

    ``length``: of the full payload; ``digest``: SHA-1 of the stored payload, of
    a revisit the one it names.  Version lines inside payloads start no record.
    A file that doesn't begin with a record gives none; what follows a record
    with no readable length, or one whose end no record follows, isn't reached.
    """
    scratch = Scratch(spark, "warc-read")
    small_batches(spark)
    local = scratch.table(_scan(spark, path).mapInArrow(_pieces, _DDL), "pieces")
    sums = local.groupBy("file", "split").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # the first piece of a file is the empty one before its first version line
    base = F.coalesce(F.sum("size").over(before), F.lit(0)) - len(VERSION)
    splits = scratch.table(sums.select("file", "split", base.alias("base"), (base + F.col("size")).alias("stop")), "splits")
    shift = lambda *names: {n: F.col(n) + F.col("base") for n in names}
    pieces = local.join(bounded_broadcast(splits.drop("stop"), F.octet_length("file") + 48), ["file", "split"])
    pieces = scratch.table(pieces.withColumns(shift("at", "next", "exit")).drop("base"), "placed")

    exits = pieces.where("exit IS NOT NULL").select("file", F.col("exit").alias("at")).distinct()
    jumps = pieces.where("next IS NOT NULL").select("file", "at", F.col("exit").alias("to"))
    entry = jumps.join(exits, ["file", "at"], "left_semi").unionAll(jumps.where("at = 0")).distinct()
    reached = _reached(scratch.table(entry, "jumps"), splits.select("file").distinct(), scratch)
    entries = scratch.table(reached.join(pieces.select("file", "split", "at"), ["file", "at"]), "entries")
    key = ["file", "split"]
    records = (
        pieces.where("next IS NOT NULL").groupBy(*key).cogroup(entries.groupBy(*key)).applyInPandas(_on_chain, _DDL)
    )
    records = scratch.table(records, "records")

    cut = scratch.table(records.where("digest IS NULL").select("file", "at", "next"), "cut")
    if cut.isEmpty():
        return records.drop("split", "size", "exit")
    crossed = splits.withColumnRenamed("file", "f")
    spans = cut.join(crossed, (F.col("file") == F.col("f")) & (F.col("at") < F.col("stop")) & (F.col("next") > F.col("base")))
    spans = scratch.table(spans.select("file", "split", "at", "next"), "spans")
    raw = _scan(spark, path).mapInArrow(_raw, "file string, split long, at long, piece binary")
    needed = spans.select(F.col("file").alias("f"), F.col("split").alias("s")).distinct()
    based = splits.select(F.col("file").alias("f"), F.col("split").alias("s"), "base").join(needed, ["f", "s"])
    raw = raw.join(based, (F.col("file") == F.col("f")) & (F.col("split") == F.col("s"))).withColumns(shift("at"))
    raw = scratch.table(raw.select("file", "split", "at", "piece"), "raw")
    parts = raw.groupBy(*key).cogroup(spans.groupBy(*key)).applyInPandas(
        _inside, "file string, record long, at long, piece binary"
    )
    put = parts.groupBy("file", "record").applyInPandas(_assembled, "file string, at long, put string")
    joined = records.join(put, ["file", "at"], "left").withColumn("digest", F.coalesce("digest", "put"))
    return joined.drop("split", "size", "exit", "put")


def archived_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives under ``path`` and read them back; a row per row.

    Columns: page_id, payload_bytes, payload_digest (SHA-1, lower-case hex; both
    of the full payload), record_type (response or revisit), refers_to (the
    response's page_id for revisits).  Null html is an empty payload; a null
    page_id comes back as null and is never referred to; repeated rows are
    records of their own.  An empty table gives no rows.
    """
    write_archives(pages, path)
    page = lambda name: F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda name: F.when(page(name) != "", page(name)).cast("long")
    return read_archives(pages.sparkSession, path).select(
        number("id").alias("page_id"),
        F.col("length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        number("refers").alias("refers_to"),
    )
