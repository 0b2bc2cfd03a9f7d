"""Lookup joins whose plan depends on a measured size, safe under hot keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halfstar.session import materialise

BROADCAST_BYTES = 64 << 20
# A key is hot when it holds more than this share of all rows, so at most
# 1 / HOT_SHARE keys are hot whatever the data looks like.
HOT_SHARE = 1 / 2000
SALTS = 8192

_WIDTHS = {
    T.LongType: 8,
    T.DoubleType: 8,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.BooleanType: 1,
}
# Row header, pointers and hash-table slot of a broadcast row.
ROW_OVERHEAD = 48


def _width(kind: T.DataType) -> int:
    if isinstance(kind, T.StructType):
        return 16 + sum(_width(f.dataType) for f in kind.fields)
    return _WIDTHS.get(type(kind), 8)


def _measured_bytes(schema: T.StructType) -> Column:
    """Aggregate: bytes of all rows, with strings and arrays counted by content."""
    total = F.count("*") * (ROW_OVERHEAD + sum(_width(f.dataType) for f in schema.fields))
    for field in schema.fields:
        if isinstance(field.dataType, T.StringType):
            total = total + F.coalesce(F.sum(F.octet_length(field.name)), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            cells = F.coalesce(F.sum(F.size(field.name)), F.lit(0))
            total = total + cells * _width(field.dataType.elementType)
    return total


@dataclass(frozen=True)
class KeyedTable:
    """A written table with one row per key, the fact rows behind each key, and its size."""

    df: DataFrame
    key: str
    weight: str
    rows: int
    total: int
    size: int
    broadcast_bytes: int = BROADCAST_BYTES

    @staticmethod
    def build(
        df: DataFrame, key: str, weight: str = "n", broadcast_bytes: int = BROADCAST_BYTES
    ) -> KeyedTable:
        return KeyedTable.of_written(materialise(df, f"by-{key}"), key, weight, broadcast_bytes)

    @staticmethod
    def of_written(
        written: DataFrame, key: str, weight: str = "n", broadcast_bytes: int = BROADCAST_BYTES
    ) -> KeyedTable:
        found = written.agg(
            F.count("*").alias("rows"),
            F.coalesce(F.sum(weight), F.lit(0)).alias("total"),
            _measured_bytes(written.schema).alias("size"),
        ).first()
        return KeyedTable(
            written, key, weight, found["rows"], int(found["total"]), found["size"], broadcast_bytes
        )

    @property
    def is_small(self) -> bool:
        return self.size <= self.broadcast_bytes


def rows_of(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df``, known to hold the rows of ``like`` with more columns, so that keys are counted before its joins."""
    df.counted_rows = getattr(like, "counted_rows", like)
    return df


def heavy_keys(fact: DataFrame, on: str) -> DataFrame:
    """Written table of the keys that hold more than HOT_SHARE of the rows of ``fact``.

    There are at most 1 / HOT_SHARE of them. The counts are combined on the map side.
    After a lookup they are taken from the rows it started from: a chain of lookups
    would otherwise run once more for each of its links.
    """
    rows = getattr(fact, "counted_rows", fact)
    fact = rows if on in rows.columns else fact
    counts = materialise(fact.groupBy(F.col(on).alias("__k")).agg(F.count("*").alias("__n")), f"counts-{on}")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    return materialise(counts.where(F.col("__n") > HOT_SHARE * total).select("__k"), f"heavy-{on}")


def lookup(
    fact: DataFrame, table: KeyedTable, values: list[str | Column] | None = None,
    on: str | None = None,
) -> DataFrame:
    """Left join a unique-key table; a NULL key matches a NULL key.

    A small table is broadcast, so the fact is not shuffled. Beyond the size
    limit the heavy keys of the fact (their number is bounded by HOT_SHARE) are
    counted and broadcast with their values, and the rest is joined by shuffle.
    Rows with a heavy key are salted, whether the table holds the key or not,
    so that they spread evenly instead of meeting in one task.
    """
    on = on or table.key
    if values is None:
        values = [c for c in table.df.columns if c not in (table.key, table.weight)]
    columns = [F.col(v) if isinstance(v, str) else v for v in values]
    keyed = table.df.select(
        F.col(table.key).alias("__k"), F.col(table.weight).alias("__w"), *columns
    )
    names = [c for c in keyed.columns if c not in ("__k", "__w")]
    if table.is_small:
        found = fact.join(F.broadcast(keyed.drop("__w")), F.col(on).eqNullSafe(F.col("__k")), "left")
        return rows_of(found.drop("__k"), fact)

    heavy = heavy_keys(fact, on).withColumnRenamed("__k", "__hk")
    held = keyed.drop("__w").join(F.broadcast(heavy), F.col("__k").eqNullSafe(F.col("__hk")), "left_semi")
    hot = heavy.join(held, F.col("__hk").eqNullSafe(F.col("__k")), "left").select(
        "__hk", F.lit(True).alias("__hot"), *[F.col(n).alias(f"__hot_{n}") for n in names]
    )
    # A remainder by one keeps the constant out of the optimiser's reach: the salt
    # must stay one of the shuffle keys.
    zero = F.pmod(F.xxhash64("__k"), F.lit(1)).cast("int")
    # the hint keeps Spark from gathering the table at the driver all the same, by the size of its files
    cold = keyed.select(F.col("__k").alias("__ck"), zero.alias("__zero"), *names).hint("merge")
    marked = fact.join(F.broadcast(hot), F.col(on).eqNullSafe(F.col("__hk")), "left").withColumn(
        "__salt",
        F.when(F.col("__hot"), 1 + F.pmod(F.xxhash64(*fact.columns), F.lit(SALTS)))
        .otherwise(0)
        .cast("int"),
    )
    joined = marked.join(
        cold,
        F.col(on).eqNullSafe(F.col("__ck")) & (F.col("__salt") == F.col("__zero")),
        "left",
    )
    merged = [
        F.when(F.col("__hot"), F.col(f"__hot_{n}")).otherwise(F.col(n)).alias(n) for n in names
    ]
    return rows_of(joined.select(*fact.columns, *merged), fact)


def anti_join_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that are not in ``right``, compared on every common column.

    The comparison is null-safe: plain equality would keep rows holding a NULL.
    """
    common = [c for c in left.columns if c in right.columns]
    other = right.select(*[F.col(c).alias(f"__r_{c}") for c in common])
    condition = F.lit(True)
    for c in common:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(other, condition, "left_anti")


def support_table(df: DataFrame, key: str) -> KeyedTable:
    """Rows per key."""
    return KeyedTable.build(df.groupBy(key).agg(F.count("*").alias("n")), key)


def keep_keys(fact: DataFrame, table: KeyedTable) -> DataFrame:
    """Rows whose key is in ``table``, with the same plan choice as ``lookup``."""
    return lookup(fact, table, [F.lit(True).alias("__kept")]).where("__kept").drop("__kept")


def semi_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``.

    The right side is reduced to its distinct keys first, so a key that fills
    most of it never has to be shuffled row by row.
    """
    return keep_keys(left, support_table(right, key))


def natural_inner_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on every common column, null-safe; duplicates multiply."""
    common = [c for c in left.columns if c in right.columns]
    other = right.withColumnsRenamed({c: f"__r_{c}" for c in common})
    condition = F.lit(True)
    for c in common:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(other, condition).drop(*[f"__r_{c}" for c in common])
