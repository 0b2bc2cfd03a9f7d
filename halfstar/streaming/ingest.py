"""Ingest a folder of rating files a bounded number of files at a time.

Each micro-batch parses, cleans and appends its files; the checkpoint makes a
restarted ingest continue where it stopped instead of loading files twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from halfstar.sources.delimited import parse_rating_lines
from halfstar.sources.ingest import prepare_ids


def ingest_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 64
) -> DataFrame:
    """Load every file now in ``source`` into the parquet table ``target``."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source)
    cleaned = prepare_ids(parse_rating_lines(lines)).select("user", "item", "rating", "timestamp")
    query = (
        cleaned.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return spark.read.schema(cleaned.schema).parquet(target)
