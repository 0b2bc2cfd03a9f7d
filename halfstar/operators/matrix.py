"""The sparse user x movie matrix in long form: build, cut, compare, reduce."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.linalg import VectorUDT
from pyspark.mllib.linalg.distributed import IndexedRowMatrix, SingularValueDecomposition
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halfstar.operators.blocks import pair_sums
from halfstar.operators.explore import counts_by, exact_quantile
from halfstar.operators.ids import dense_table, with_dense
from halfstar.operators.joins import KeyedTable, keep_keys, lookup
from halfstar.session import packed, scratch_path


def rating_matrix(ratings: DataFrame) -> DataFrame:
    """``(u, i, x)`` on dense ids; repeated cells are summed, absent cells are unrated."""
    users, items = dense_table(ratings, "userId"), dense_table(ratings, "movieId")
    coded = with_dense(with_dense(ratings, users, "u"), items, "i")
    return coded.groupBy("u", "i").agg(F.sum("rating").alias("x"))


def matrix_block(matrix: DataFrame, rows: int, columns: int) -> DataFrame:
    """Upper-left corner of a matrix."""
    return matrix.where((F.col("u") <= rows) & (F.col("i") <= columns))


def dense_corner(matrix: DataFrame, rows: int, columns: int) -> DataFrame:
    """A small corner laid out as a wide table for display."""
    return (
        matrix_block(matrix, rows, columns)
        .groupBy("u")
        .pivot("i", list(range(1, columns + 1)))
        .agg(F.first("x"))
    )


def entries_of(
    ratings: DataFrame, row: str, column: str, value: str, first: int | None = None,
    unit: bool = False,
) -> tuple[DataFrame, KeyedTable, int]:
    """Matrix entries keyed by dense column, optionally scaled to unit columns.

    ``first`` keeps the first so many columns in id order.
    """
    length = F.sqrt(F.sum(F.pow(value, 2)))
    table = dense_table(ratings, column, length.alias("length"))
    attached = lookup(
        ratings.select(F.col(row).alias("row"), F.col(column).alias("id"), F.col(value).alias("x")),
        table, ["idx", "length"], on="id",
    )
    columns = table.rows
    if first is not None and first < columns:
        attached, columns = attached.where(F.col("idx") <= first), first
    if unit:
        attached = attached.withColumn(
            "x", F.coalesce(F.try_divide(F.col("x"), F.col("length")), F.lit(0.0))
        )
    return attached.select("row", "id", "idx", "x"), table, columns


def cosine(
    ratings: DataFrame, row: str, column: str, value: str = "rating", norm: str = "full",
    first: int | None = None,
) -> DataFrame:
    """``(i, j, sim)`` with i < j for every pair of columns that share a row.

    ``full`` divides by the length of the whole columns (unrated = 0),
    ``corated`` by the length over the shared rows only.
    """
    if norm == "full":
        entries, _, columns = entries_of(ratings, row, column, value, first, unit=True)
        return pair_sums(entries, columns, ["xy"]).select("i", "j", F.col("xy").alias("sim"))
    entries, _, columns = entries_of(ratings, row, column, value, first)
    length = F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))
    return pair_sums(entries, columns, ["xy", "xx", "yy"]).select(
        "i", "j", F.try_divide(F.col("xy"), length).alias("sim")
    )


def user_cosine(ratings: DataFrame, norm: str = "full", first: int | None = None) -> DataFrame:
    return cosine(ratings, "movieId", "userId", norm=norm, first=first)


def item_cosine(ratings: DataFrame, norm: str = "full", first: int | None = None) -> DataFrame:
    return cosine(ratings, "userId", "movieId", norm=norm, first=first)


def support_limits(ratings: DataFrame, q_users: float = 0.90, q_movies: float = 0.75):
    """Support tables and the rounded support quantiles of users and movies."""
    out = []
    for key, q in (("userId", q_users), ("movieId", q_movies)):
        counts = KeyedTable.build(counts_by(ratings, key, key).withColumnRenamed("count", "n"), key)
        limit = exact_quantile(counts.df, "n", q)
        out.append((counts, round(limit)))  # half goes to the even number
    return out


def relevant_ratings(
    ratings: DataFrame, q_users: float = 0.90, q_movies: float = 0.75
) -> DataFrame:
    """Ratings by busy users of popular movies.

    Both limits come from the unfiltered matrix and are applied together.
    """
    for counts, limit in support_limits(ratings, q_users, q_movies):
        kept = counts.df.where(F.col("n") > limit)
        ratings = keep_keys(ratings, KeyedTable.of_written(kept, counts.key))
    return ratings


def indexed_rows(matrix: DataFrame, columns: int) -> DataFrame:
    """Written table of ``(index, vector)``, one sparse row per user.

    A vector is stored as a plain struct, so it is put together by column
    functions and read back under the vector type; no row passes through Python.
    """
    profiles = matrix.groupBy("u").agg(
        F.sort_array(F.collect_list(F.struct((F.col("i") - 1).cast("int").alias("i"), "x"))).alias("cells")
    )
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(columns).cast("int").alias("size"),
        F.col("cells.i").alias("indices"),
        F.col("cells.x").cast("array<double>").alias("values"),
    )
    rows = profiles.select((F.col("u") - 1).cast("long").alias("index"), vector.alias("vector"))
    path = scratch_path(matrix.sparkSession, "rows")
    rows.write.parquet(path)
    schema = T.StructType([T.StructField("index", T.LongType()), T.StructField("vector", VectorUDT())])
    return matrix.sparkSession.read.schema(schema).parquet(path)


def svd(
    matrix: DataFrame, values: int, left: bool = True
) -> SingularValueDecomposition:
    """Truncated SVD of the matrix on the cluster; users are the rows.

    At most as many ``values`` as there are columns. Without ``left`` the user
    vectors are not computed, which saves a pass.
    """
    columns = matrix.agg(F.max("i")).first()[0]
    rows = packed(indexed_rows(matrix, columns)).persist(StorageLevel.MEMORY_AND_DISK)
    result = IndexedRowMatrix(rows, numCols=columns).computeSVD(min(values, columns), computeU=left)
    if not left:
        rows.unpersist()
    return result


def factor_tables(spark, found: SingularValueDecomposition, k: int) -> dict[str, DataFrame]:
    """The leading ``k`` left vectors, values and right vectors as tables ``(idx, vector)``.

    The left vectors stay distributed; the right ones are as long as the
    number of movies and lie on the driver, as the solver leaves them.
    """
    left = found.U.rows.toDF().select(
        (F.col("index") + 1).alias("idx"), F.slice(vector_to_array("vector"), 1, k).alias("vector")
    )
    values = [(i + 1, [float(x)]) for i, x in enumerate(found.s.toArray()[:k])]
    right = [(i + 1, row[:k].tolist()) for i, row in enumerate(found.V.toArray())]
    schema = "idx long, vector array<double>"
    return {
        "U": left, "D": spark.createDataFrame(values, schema), "V": spark.createDataFrame(right, schema)
    }


def energy_table(spark, sigma: list[float], total: float | None = None) -> DataFrame:
    """``(k, sigma, share)``: cumulative share of squared singular values.

    The share is taken of the computed values, or of ``total`` (the squared
    norm of the whole matrix) when given.
    """
    whole = total or sum(x * x for x in sigma)
    rows, run = [], 0.0
    for k, x in enumerate(sigma, 1):
        run += x * x
        rows.append((k, float(x), run / whole))
    return spark.createDataFrame(rows, "k int, sigma double, share double")


def choose_k(energy: DataFrame, limit: float = 0.90) -> int:
    """How many leading values stay within ``limit`` of the energy."""
    return energy.where(F.col("share") <= limit).count()
