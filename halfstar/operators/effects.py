"""Additive effect models: a global mean plus one residual mean per key.

b_i   mean of r - mu                       by movie
b_u   mean of r - mu - b_i                 by user
b_g, b_y, b_t   mean of r - mu - b_i - b_u by genre combination, year, week

The last three share one residual and are fitted in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfstar.operators.evaluate import SKIP, STRICT, rmse_many
from halfstar.operators.joins import KeyedTable, lookup
from halfstar.session import materialise

# Effect name, key column.
KEYS = {"b_i": "movieId", "b_u": "userId", "b_g": "genres", "b_y": "year", "b_t": "week"}

# Method name and the effects it adds, in the reported order.
METHODS = {
    "Mu": [],
    "Movie Effect": ["b_i"],
    "Movie + User Effects": ["b_i", "b_u"],
    "Movie + User + Time Effects": ["b_i", "b_u", "b_t"],
    "Movie + User + Genre Effects": ["b_i", "b_u", "b_g"],
    "Movie + User + Year Effects": ["b_i", "b_u", "b_y"],
    "Movie + User + Time + Genre + Year Effects": ["b_i", "b_u", "b_g", "b_t", "b_y"],
}


@dataclass
class MovieStats:
    """Per-movie sums; the global mean and every movie effect follow from them."""

    table: KeyedTable
    mu: float

    def effect(self, penalty: float = 0.0) -> Column:
        return shrunken(F.col("s") - F.col("n") * F.lit(self.mu), F.col("n"), penalty)


def shrunken(total: Column, count: Column, penalty: float = 0.0) -> Column:
    """``total / (count + penalty)``, the penalised mean."""
    return total / (count + F.lit(float(penalty)))


def key_stats(train: DataFrame, key: str) -> MovieStats:
    """One scan gives n and sum per key; the mean comes from that small table."""
    table = KeyedTable.build(
        train.groupBy(key).agg(F.count("rating").alias("n"), F.sum("rating").alias("s")), key
    )
    mu = table.df.agg((F.sum("s") / F.sum("n")).alias("mu")).first()["mu"]
    return MovieStats(table, mu)


def global_mean(train: DataFrame) -> DataFrame:
    return train.agg(F.avg("rating").alias("mu"))


@dataclass
class EffectModel:
    mu: float
    tables: dict[str, KeyedTable]

    def score(self, rows: DataFrame, effects: list[str] | None = None) -> DataFrame:
        """Attach the effect columns; a key unseen in training gives NULL."""
        for name in effects or list(self.tables):
            rows = lookup(rows, self.tables[name], [name], on=KEYS[name])
        return rows

    def prediction(self, effects: list[str], missing: str = STRICT) -> Column:
        value = F.lit(self.mu)
        for name in effects:
            part = F.col(name)
            value = value + (F.coalesce(part, F.lit(0.0)) if missing == "zero" else part)
        return value

    def size_mb(self, effects: list[str]) -> float:
        """Measured size of the effect tables a model needs."""
        return sum(self.tables[name].size for name in effects) / (1 << 20)

    def predict(
        self, rows: DataFrame, effects: list[str], missing: str = STRICT
    ) -> DataFrame:
        return self.score(rows, effects).withColumn("pred", self.prediction(effects, missing))


def fit_movie(train: DataFrame) -> EffectModel:
    stats = key_stats(train, "movieId")
    table = stats.table.df.select("movieId", "n", stats.effect().alias("b_i"))
    return EffectModel(stats.mu, {"b_i": KeyedTable.of_written(table, "movieId")})


def fit_movie_user(train: DataFrame, base: EffectModel | None = None) -> EffectModel:
    base = base or fit_movie(train)
    residual = F.col("rating") - base.prediction(["b_i"])
    users = (
        base.score(train.select("userId", "movieId", "rating"), ["b_i"])
        .groupBy("userId")
        .agg(F.count("*").alias("n"), F.avg(residual).alias("b_u"))
    )
    return EffectModel(base.mu, {**base.tables, "b_u": KeyedTable.build(users, "userId")})


def fit_all(train: DataFrame, base: EffectModel | None = None) -> EffectModel:
    """Movie, user, and the three context effects, the latter in a single pass."""
    base = base or fit_movie_user(train)
    residual = F.col("rating") - base.prediction(["b_i", "b_u"])
    context = ["genres", "year", "week"]
    rows = base.score(train.select("userId", "movieId", "rating", *context), ["b_i", "b_u"])
    sums = (
        rows.select(*context, residual.alias("r"))
        .groupingSets([[F.col(c)] for c in context], *[F.col(c) for c in context])
        .agg(
            F.count("*").alias("n"),
            F.avg("r").alias("b"),
            *[F.grouping(c).alias(f"without_{c}") for c in context],
        )
    )
    written = materialise(sums, "context-effects")
    tables = dict(base.tables)
    for name in ("b_g", "b_y", "b_t"):
        key = KEYS[name]
        part = written.where(f"without_{key} = 0").select(key, "n", F.col("b").alias(name))
        tables[name] = KeyedTable.of_written(part, key)
    return EffectModel(base.mu, tables)


def compare_effects(
    model: EffectModel, holdout: DataFrame, methods: dict[str, list[str]] | None = None,
    missing: str = STRICT,
) -> DataFrame:
    """RMSE of several effect models from one scan of the holdout.

    ``missing`` says what a key unseen in training does: ``strict`` voids the
    figure, ``skip`` leaves the row out, ``zero`` counts its effect as nothing.
    """
    methods = methods or METHODS
    needed = [n for n in KEYS if any(n in effects for effects in methods.values())]
    rows = holdout.select("rating", *[KEYS[n] for n in needed])
    scored = model.score(rows, needed) if needed else rows
    return rmse_many(
        scored,
        {name: model.prediction(effects, missing) for name, effects in methods.items()},
        SKIP if missing == SKIP else STRICT,
    )
