"""Ratings and movies derived from an order/part schema.

An order line is a rating of the part by the customer; a part is the rated item.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfstar.functions import epoch_seconds


#: Order lines that one task groups by user and item.
LINES_PER_TASK = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(userId, movieId, rating, timestamp)``, one row per user and item."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders")
    orders = orders.select(
        "o_orderkey", "o_custkey", epoch_seconds(orders, "o_orderdate").alias("o_epoch")
    )
    rating = ((F.col("l_quantity") - 1) % 10 + 1) / 2
    seconds = F.col("o_epoch") + (F.col("l_orderkey") * 7919) % 86400
    rated = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        rating.alias("rating"),
        seconds.alias("seconds"),
    )
    # nearly every pair occurs once: combined where the join ends, a task would hold a group for each of its rows
    tasks = ceil(lines.count() / LINES_PER_TASK)
    if tasks > spark.sparkContext.defaultParallelism:
        rated = rated.repartition(tasks, "userId", "movieId")
    return rated.groupBy("userId", "movieId").agg(
        F.max("rating").alias("rating"), F.min("seconds").cast("long").alias("timestamp")
    )


def movies_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(movieId, title, genres)``; some titles carry no year and some carry two."""
    key = F.col("p_partkey")
    name = F.col("p_name")
    title = (
        F.when(key % 97 == 0, name)
        .when(key % 89 == 0, F.concat(name, F.lit(" (1984) (2001)")))
        .otherwise(F.concat(name, F.lit(" ("), (1950 + key % 60).cast("string"), F.lit(")")))
    )
    genres = F.concat(F.col("p_type"), F.lit("|"), F.replace(name, F.lit(" "), F.lit("|")))
    return table(spark, sf_dir, "part").select(
        key.cast("int").alias("movieId"), title.alias("title"), genres.alias("genres")
    )
