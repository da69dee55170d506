"""python -m tidemark -c FILE: runs the ingestion that a properties file describes, until it is stopped."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from tidemark.config import from_args
from tidemark.functions.schema import Registry
from tidemark.streaming import ingest


def main(args: list[str]) -> None:
    config = from_args(args)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    run = ingest.service(spark, config, Registry.from_folder(config.schema_folder, config.capture_database))
    run.start()
    try:
        run.query.awaitTermination()
    finally:
        run.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
