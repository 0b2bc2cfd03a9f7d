"""Matrix factorisation by alternating least squares, and scoring with the factors."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfstar.operators.evaluate import SKIP, rmse
from halfstar.operators.joins import KeyedTable, lookup
from halfstar.operators.split import fold_of
from halfstar.session import checkpoint_dir, materialise

SEED = 42
# Ratings behind one user or item block of the solver, where cores are not the limit,
# and at most. A vector is sent to every block that needs it, so more blocks than a
# fit can use only add to what is shuffled.
ROWS_PER_BLOCK, MOST_ROWS_PER_BLOCK = 50_000, 5_000_000


def block_count(rows: int, cores: int, at_once: int = 1) -> int:
    """Blocks for the cores that one of ``at_once`` fits has, more where a block would grow too large."""
    most = ceil(max(10, cores) / at_once)
    return max(2, min(most, ceil(rows / ROWS_PER_BLOCK)), ceil(rows / MOST_ROWS_PER_BLOCK))


def estimator(
    df: DataFrame, rank: int = 10, reg: float = 0.1, iterations: int = 5,
    user: str = "userId", item: str = "movieId", rating: str = "rating", at_once: int = 1,
) -> ALS:
    """ALS whose block count follows the data and the cluster, with checkpointed lineage.

    ``at_once`` fits run at the same time and share the cores.
    A pair without a vector scores NaN, which ``scored`` turns into NULL, so
    it is counted and not dropped.
    """
    checkpoint_dir(df.sparkSession)
    rows = df.count()
    blocks = block_count(rows, df.sparkSession.sparkContext.defaultParallelism, at_once)
    return ALS(
        rank=rank, regParam=reg, maxIter=iterations, userCol=user, itemCol=item,
        ratingCol=rating, coldStartStrategy="nan", numUserBlocks=blocks, numItemBlocks=blocks,
        checkpointInterval=5, seed=SEED,
    )


@dataclass
class Factors:
    """User and item vectors with the training rows behind each of them."""

    users: KeyedTable
    items: KeyedTable

    @staticmethod
    def of(model: ALSModel, train: DataFrame, user: str = "userId", item: str = "movieId") -> Factors:
        tables = []
        for key, vectors in ((user, model.userFactors), (item, model.itemFactors)):
            support = train.groupBy(key).agg(F.count("*").alias("n"))
            tables.append(
                KeyedTable.build(
                    vectors.withColumnRenamed("id", key).join(support, key, "left").fillna(0, ["n"]),
                    key,
                )
            )
        return Factors(*tables)

    def score(self, rows: DataFrame, name: str = "pred") -> DataFrame:
        """Dot product of chosen pairs; a user or item without a vector gives NULL."""
        paired = lookup(rows, self.users, [F.col("features").alias("__p")])
        paired = lookup(paired, self.items, [F.col("features").alias("__q")])
        return paired.withColumn(name, dot(F.col("__p"), F.col("__q"))).drop("__p", "__q")


def dot(p: Column, q: Column) -> Column:
    products = F.zip_with(p, q, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def no_gaps(ratings: DataFrame) -> DataFrame:
    """``(userId, movieId, rating)``; as in Spark's ALS a null, or a rating that is no number, is an error when read."""

    def present(c: str, gap: Column) -> Column:
        return F.when(gap, F.raise_error(F.lit(f"{c} MUST NOT be Null or NaN"))).otherwise(F.col(c)).alias(c)

    rated = F.col("rating").isNull() | F.isnan("rating")
    return ratings.select(*(present(c, F.col(c).isNull()) for c in ("userId", "movieId")), present("rating", rated))


def fit(train: DataFrame, **params) -> Factors:
    rows = train.select("userId", "movieId", "rating")
    return Factors.of(estimator(rows, **params).fit(rows), rows)


def scored(model: ALSModel, rows: DataFrame, name: str = "pred") -> DataFrame:
    """``rows`` with the model's prediction; NULL where user or movie has no vector."""
    out = model.transform(rows)
    value = F.when(~F.isnan("prediction"), F.col("prediction").cast("double"))
    return out.withColumn(name, value).drop("prediction")


def grid_search(
    train: DataFrame, ranks: list[int], regs: list[float], iterations: int = 10, folds: int = 3,
    parallelism: int = 4,
) -> tuple[dict, DataFrame]:
    """Cross-validated grid; the best parameters and ``(rank, reg, rmse, n_null, is_best)``.

    A held-out row whose user or movie has no vector has no error; ``n_null``
    counts such rows over all folds. ``parallelism`` fits run at a time. They are sweeps with
    written vectors; where tasks cannot open the shared folder themselves, Spark's ALS.
    """
    from halfstar.operators import sweeps  # it builds on this module

    points = [{"rank": rank, "reg": reg} for rank in ranks for reg in regs]
    if sweeps.can_open(train.sparkSession):
        errors = sweeps.grid_errors(no_gaps(train), points, iterations, folds, parallelism)
    else:
        errors = _als_errors(train, points, iterations, folds, parallelism)
    mean = [sum(e for e, _ in errors[i : i + folds]) / folds for i in range(0, len(errors), folds)]
    missing = [sum(n for _, n in errors[i : i + folds]) for i in range(0, len(errors), folds)]
    least = min(range(len(points)), key=lambda i: mean[i])
    table = [(p["rank"], p["reg"], float(m), n, i == least) for i, (p, m, n) in enumerate(zip(points, mean, missing))]
    return points[least], train.sparkSession.createDataFrame(
        table, "rank int, reg double, rmse double, n_null long, is_best boolean"
    )


def _als_errors(
    train: DataFrame, points: list[dict], iterations: int, folds: int, parallelism: int
) -> list[tuple[float, int]]:
    rows = materialise(train.select("userId", "movieId", "rating", fold_of(folds).alias("fold")), "grid-rows")

    def error(task: tuple[dict, int]) -> tuple[float, int]:
        point, fold = task
        inside = rows.where(F.col("fold") != fold)
        model = estimator(inside, iterations=iterations, at_once=parallelism, **point).fit(inside)
        found = rmse(scored(model, rows.where(F.col("fold") == fold)), mode=SKIP).first()
        return found["rmse"], found["n_null"]

    tasks = [(p, f) for p in points for f in range(folds)]
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(train.sparkSession)(error), tasks)


def objective(factors: Factors, scored: DataFrame, reg: float) -> DataFrame:
    """Training rmse and the penalised squared error the solver minimises."""
    penalty = None
    for table in (factors.users, factors.items):
        part = table.df.agg(F.sum(F.col("n") * dot(F.col("features"), F.col("features")))).first()[0]
        penalty = part if penalty is None else penalty + part
    square = F.pow(F.col("rating") - F.col("pred"), 2)
    return scored.agg(
        F.sqrt(F.avg(square)).alias("tr_rmse"), (F.sum(square) + F.lit(reg * penalty)).alias("obj")
    )


def training_curve(
    train: DataFrame, iterations: list[int], rank: int = 10, reg: float = 0.1, parallelism: int = 6
) -> DataFrame:
    """``(iter, tr_rmse, obj)`` after each number of sweeps.

    One run of sweeps with written vectors passes all points. Where tasks cannot open the shared
    folder themselves, every point is a fit of Spark's ALS, ``parallelism`` of them at a time.
    """
    from halfstar.operators import sweeps  # it builds on this module

    if sweeps.can_open(train.sparkSession):
        points = sweeps.curve(no_gaps(train), iterations, rank, reg)
        return train.sparkSession.createDataFrame(points, "iter int, tr_rmse double, obj double")
    rows = materialise(train.select("userId", "movieId", "rating"), "curve-rows")

    def point(sweeps: int) -> tuple[int, float, float]:
        factors = fit(rows, rank=rank, reg=reg, iterations=sweeps, at_once=parallelism)
        found = objective(factors, factors.score(rows), reg).first()
        return sweeps, found["tr_rmse"], found["obj"]

    with ThreadPool(parallelism) as pool:
        points = pool.map(inheritable_thread_target(train.sparkSession)(point), iterations, chunksize=1)
    return train.sparkSession.createDataFrame(points, "iter int, tr_rmse double, obj double")
