from __future__ import annotations

import hashlib
import random

import pytest

from stationflow.llm.scratch import Scratch
from stationflow.llm.warc import LEAST_SHARED, archived_pages, read_archives, write_archives

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    largest = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= LEAST_SHARED and page is not None:
            largest[body] = max(largest.get(body, page), page)
    found = []
    for page, _, html in rows:
        body = (html or "").encode()
        to = largest.get(body)
        to = None if to == page else to
        found.append((page, len(body), hashlib.sha1(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(found, key=str)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "20000")
    spark.conf.set(names[1], "1000")
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def place(spark):
    return Scratch(spark, "test-warc").path("archives")


def found(spark, rows, parts=3):
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS digest", "1 AS file", "2 AS at", "3 AS target")
    return sorted(map(tuple, archived_pages(pages.repartition(parts), place(spark)).collect()), key=str)


def test_version_lines_inside_payloads_over_many_splits(spark, small_splits):
    rng = random.Random(1)
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 7\r\n\r\n1234567\r\n\r\n"
    piece = lambda: rng.choice(["x" * rng.randint(1, 900), "WARC/1.0\r\n", inner, "é\r\n\r\n", "\r\n"])
    rows = [(i, f"http://x/{i}", "".join(piece() for _ in range(rng.randint(0, 6)))) for i in range(300)]
    rows += [(500 + i, "u", rows[i][2]) for i in range(50)]
    rows += [(900, "u", "WARC/1.0\r\n".join("y" * 1000 for _ in range(300)))]  # a payload over many splits
    assert found(spark, rows) == expected(rows)


def test_nulls_ties_and_repeated_rows(spark):
    big = "p" * LEAST_SHARED
    rows = [(1, None, None), (2, "u", ""), (3, "a\r\nb", big), (4, "u", big), (4, "u", big), (5, "u", big[:-1]), (6, "u", big[:-1])]
    rows += [(7, "u", "é" * (LEAST_SHARED // 2)), (8, "u", "é" * (LEAST_SHARED // 2)), (-9, "u", big)]
    assert found(spark, rows) == expected(rows)


def test_null_page_id(spark):
    big = "q" * LEAST_SHARED
    assert {(r[0], r[3], r[4]) for r in found(spark, [(None, "u", big), (3, "u", big), (None, "u", "s")])} == {
        (None, "revisit", 3), (3, "response", None), (None, "response", None)
    }


def test_empty_table(spark):
    assert archived_pages(spark.createDataFrame([], SCHEMA), place(spark)).count() == 0


def test_a_broken_chain_ends_the_file(spark):
    path = place(spark)
    write_archives(spark.createDataFrame([(1, "u", "a" * 50), (2, "u", "b" * 60)], SCHEMA).coalesce(1), path)
    whole = "".join(r.value + "\r\n\r\n" for r in spark.read.option("lineSep", "\r\n\r\n").text(path).collect())
    other = place(spark)
    broken = whole.replace("Content-Length: 60", "Content-Length: x")
    spark.createDataFrame([(broken.removesuffix("\r\n\r\n"),)], "value string").write.option("lineSep", "\r\n\r\n").text(other)
    assert [r.id for r in read_archives(spark, other).collect()] == ["<urn:page:1>"]


def test_offsets_are_byte_offsets(spark):
    path = place(spark)
    rows = [(i, "ü", "ö" * (i + 1)) for i in range(20)]
    write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    records = sorted(read_archives(spark, path).collect(), key=lambda r: r["at"])
    assert records[0]["at"] == 0 and all(a["next"] == b["at"] for a, b in zip(records, records[1:], strict=False))
