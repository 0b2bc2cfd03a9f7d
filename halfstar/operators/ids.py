"""Dense ids and support counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halfstar.operators.joins import KeyedTable, lookup, support_table
from halfstar.session import materialise


def dense_ids(df: DataFrame, key: str, *extra: Column) -> DataFrame:
    """``(key, n, idx)``: ids 1..m in sorted key order with the rows behind each key.

    ``extra`` aggregates per key are carried along.

    Range partitioning sorts the distinct keys in parallel; a key's id is its
    place in its partition plus the sizes of the partitions before it. Only
    that list of partition sizes passes through a single task.
    """
    keys = df.groupBy(key).agg(F.count("*").alias("n"), *extra)
    placed = keys.repartitionByRange(key).sortWithinPartitions(key).select(
        *keys.columns,
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    )
    written = materialise(placed, f"ids-{key}")
    sizes = written.groupBy("part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    # one row per partition, hence bounded by the partition count
    return written.join(F.broadcast(offsets), "part").select(
        *keys.columns, (F.col("offset") + F.col("place") + 1).cast("int").alias("idx")
    )


def dense_table(df: DataFrame, key: str, *extra: Column) -> KeyedTable:
    return KeyedTable.build(dense_ids(df, key, *extra), key)


def with_dense(df: DataFrame, table: KeyedTable, name: str) -> DataFrame:
    """Attach the dense id of ``table.key`` under ``name``."""
    return lookup(df, table, [F.col("idx").alias(name)])


def support_features(df: DataFrame) -> DataFrame:
    """Add rows per user and rows per movie to every row.

    Aggregate-then-lookup instead of a window: a window would gather all rows
    of a hot user or movie in one task.
    """
    users, movies = support_table(df, "userId"), support_table(df, "movieId")
    df = lookup(df, users, [F.col("n").alias("n_movies_by_user")])
    return lookup(df, movies, [F.col("n").alias("n_users_by_movie")])
