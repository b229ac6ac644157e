"""File readers with the fixed reading schema (never ``inferSchema``: no extra
pass over the data, and types do not drift between files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stationflow.operators.enrich import enrich_time
from stationflow.schema import READING


def read_readings_csv(
    spark: SparkSession, path: str, enrich: bool = True, bad_cells: Observation | None = None
) -> DataFrame:
    """CSV files with a header row; ``timestamp`` parsed by :func:`enrich_time`.

    Columns are found by their name in the header, in any order; further ones
    are ignored.  A missing column raises, and so does a file whose header
    differs from the first one's.  A cell that doesn't hold its type is null;
    ``bad_cells`` counts these per column while the result is computed.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    header = reader.csv(path).schema  # text columns, from the first file's header alone
    missing = [f.name for f in READING.fields if f.name not in header.names]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    text = reader.schema(header).option("enforceSchema", False).csv(path)
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in READING.fields}
    if bad_cells is not None:
        wrong = [F.count_if(F.col(f"`{n}`").isNotNull() & c.isNull()).alias(n) for n, c in typed.items()]
        text = text.observe(bad_cells, *wrong)
    df = text.select(*(c.alias(n) for n, c in typed.items()))
    return enrich_time(df) if enrich else df


def read_readings_json(spark: SparkSession, path: str, enrich: bool = True) -> DataFrame:
    """JSON-lines files, one reading per line; unknown keys ignored, bad values null."""
    df = spark.read.schema(READING).option("mode", "PERMISSIVE").json(path)
    return enrich_time(df) if enrich else df
