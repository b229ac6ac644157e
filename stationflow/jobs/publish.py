"""Publish readings as JSON payloads: to a topic, or to JSON-lines files.

    python -m stationflow.jobs.publish --csv <readings.csv> --kafka host:9092 [--topic weather-raw]
    python -m stationflow.jobs.publish --jsonl <folder> --kafka host:9092
    python -m stationflow.jobs.publish --csv <readings.csv> --to-files <folder>

Each reading becomes the UTF-8 JSON text of its 12 wire fields in ``value``;
the write is one distributed batch job (every task produces its own share),
acknowledged by all in-sync replicas.  JSON-lines input is published as is.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from stationflow.operators.feed import encode_payloads
from stationflow.session import build_session
from stationflow.sinks.files import save_text
from stationflow.sources.files import read_readings_csv
from stationflow.sources.topics import DEFAULT_TOPIC, write_kafka


def payloads(spark: SparkSession, csv: str | None = None, jsonl: str | None = None) -> DataFrame:
    if csv:
        return encode_payloads(read_readings_csv(spark, csv, enrich=False))
    return spark.read.text(jsonl)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    src = parser.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="readings CSV file or folder (header row, wire order)")
    src.add_argument("--jsonl", help="folder of JSON-lines payloads")
    dst = parser.add_mutually_exclusive_group(required=True)
    dst.add_argument("--kafka", help="bootstrap servers")
    dst.add_argument("--to-files", help="write JSON-lines payload files here instead")
    parser.add_argument("--topic", default=DEFAULT_TOPIC)
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)

    spark = build_session(args.master, app="stationflow-publish")
    out = payloads(spark, args.csv, args.jsonl)
    if args.kafka:
        write_kafka(out, args.kafka, args.topic)
    else:
        save_text(out, args.to_files)
    spark.stop()


if __name__ == "__main__":
    main()
