"""Feed check: read a topic (or payload files) from the start, decode and summarize.

    python -m stationflow.jobs.feed --kafka host:9092 [--topic weather-raw] [--ending-offsets JSON]
    python -m stationflow.jobs.feed --files <folder of JSON lines>

One bounded batch read replaces a single consumer looping over the topic: the
topic's partitions are read in parallel, and the summary (messages, distinct
stations, labelled anomalies, mean temperature) is one aggregate.
"""

from __future__ import annotations

import argparse

from stationflow.operators.feed import feed_summary
from stationflow.session import build_session
from stationflow.sources.topics import DEFAULT_TOPIC, decode_payload, kafka_batch


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    src = parser.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of JSON-lines payload files")
    parser.add_argument("--topic", default=DEFAULT_TOPIC)
    parser.add_argument("--ending-offsets", default="latest", help="JSON text of an end offset per partition")
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)

    spark = build_session(args.master, app="stationflow-feed")
    if args.kafka:
        raw = kafka_batch(spark, args.kafka, args.topic, ending_offsets=args.ending_offsets)
    else:
        raw = spark.read.text(args.files)
    feed_summary(decode_payload(raw)).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
