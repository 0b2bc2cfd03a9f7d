"""Preparing and registering ratings for model training."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfstar.operators.ids import with_dense
from halfstar.operators.joins import KeyedTable

MISSING_ID = -1


def prepare_ids(df: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Add int ``user`` and ``item``; rows where either is missing are dropped."""
    def sentinel(name: str):
        return F.coalesce(F.col(name).try_cast("int"), F.lit(MISSING_ID))

    return df.withColumns({"user": sentinel(user), "item": sentinel(item)}).where(
        (F.col("user") != MISSING_ID) & (F.col("item") != MISSING_ID)
    )


def recode_ids(df: DataFrame, users: KeyedTable, items: KeyedTable) -> DataFrame:
    """Attach dense codes of shared index tables, then drop incomplete rows."""
    coded = with_dense(with_dense(df, users, "user"), items, "item")
    return coded.dropna(how="any")


def ingest_batches(
    batches: list[DataFrame], name: str, partitions: int = 8, key: str = "user"
) -> DataFrame:
    """Append batches, spread them by ``key``, register a view and persist it.

    ``rebalance`` rather than a fixed ``repartition`` lets adaptive execution
    split a key that holds most rows; ``partitions`` is the starting count.
    """
    combined = batches[0]
    for batch in batches[1:]:
        combined = combined.unionByName(batch)
    spread = combined.hint("rebalance", partitions, F.col(key))
    spread.createOrReplaceTempView(name)
    return spread.persist(StorageLevel.MEMORY_AND_DISK)
