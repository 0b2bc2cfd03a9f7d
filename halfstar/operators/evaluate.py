"""RMSE and the comparison table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from time import perf_counter
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

T = TypeVar("T")

STRICT = "strict"
SKIP = "skip"


def rmse_columns(actual: Column, predicted: Column, mode: str = STRICT) -> list[Column]:
    """Aggregates ``n``, ``n_null`` and ``rmse``.

    ``strict`` gives a NULL rmse as soon as one prediction is missing, the way
    a plain mean does; ``skip`` leaves missing predictions out and counts them.
    """
    missing = F.count_if(predicted.isNull() | actual.isNull())
    value = F.sqrt(F.avg(F.pow(actual - predicted, 2)))
    if mode == STRICT:
        value = F.when(missing == 0, value)
    return [F.count("*").alias("n"), missing.alias("n_null"), value.alias("rmse")]


def rmse(
    df: DataFrame, actual: str = "rating", predicted: str = "pred", mode: str = STRICT
) -> DataFrame:
    return df.agg(*rmse_columns(F.col(actual), F.col(predicted), mode))


def result_record(
    df: DataFrame, method: str, actual: str = "rating", predicted: str = "pred",
    mode: str = STRICT, digits: int = 6,
) -> DataFrame:
    """One row ``(method, n, n_null, rmse)``."""
    return rmse(df, actual, predicted, mode).select(
        F.lit(method).alias("method"), "n", "n_null", F.round("rmse", digits).alias("rmse")
    )


def rmse_many(df: DataFrame, predictions: dict[str, Column], mode: str = STRICT) -> DataFrame:
    """One row per method from a single pass over the scored rows."""
    row = df.agg(
        *[
            F.struct(
                F.lit(method).alias("method"), *rmse_columns(F.col("rating"), value, mode)
            ).alias(f"m{i}")
            for i, (method, value) in enumerate(predictions.items())
        ]
    )
    stacked = row.select(
        F.explode(F.array(*[F.col(f"m{i}") for i in range(len(predictions))])).alias("m")
    )
    return stacked.select("m.method", "m.n", "m.n_null", F.round("m.rmse", 6).alias("rmse"))


def timed(action: Callable[[], T]) -> tuple[T, float]:
    """Result and wall seconds of something that runs to completion."""
    start = perf_counter()
    return action(), perf_counter() - start


def comparison(
    records: list[DataFrame], time_sec: dict[str, float] | None = None,
    size_mb: dict[str, float] | None = None,
) -> DataFrame:
    """``Method, RMSE, Time (sec), Size (MB)`` of several result records."""
    table = reduce(lambda a, b: a.unionByName(b), records)

    def measured(values: dict[str, float] | None) -> Column:
        if not values:
            return F.lit(None).cast("double")
        pairs = [F.lit(x) for pair in values.items() for x in pair]
        return F.try_element_at(F.create_map(*pairs), F.col("method"))

    return table.withColumns({"time": measured(time_sec), "size": measured(size_mb)}).select(
        F.col("method").alias("Method"),
        F.col("rmse").alias("RMSE"),
        F.col("time").alias("Time (sec)"),
        F.round("size", 4).alias("Size (MB)"),
    )
