"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; words are the runs between. The same set as ``bytes.split()``.
WHITE = "[\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text of an Arrow column; null reads as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def map_batches(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function of one batch; Spark bounds a batch by rows and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield make(batch)

    return df.mapInArrow(run, schema)


def row_key(df: DataFrame) -> Column:
    """A key for a document that also serves null and repeated ids.

    Rows that agree in id, source and text get the same key: for a decision
    that depends on these alone they are the same row.
    """
    return F.struct(
        F.col("doc_id").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit("")), F.col("source")).alias("h"),
    )


def key_text(key: Column) -> Column:
    """A row key (or a struct holding its fields) as one text without null, to join and group on."""
    return F.concat_ws(":", F.coalesce(key.getField("id").cast("string"), F.lit("none")), key.getField("h"))
