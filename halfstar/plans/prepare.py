"""The prepared tables every model starts from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfstar.functions import title_parts, week_start
from halfstar.operators.joins import KeyedTable, lookup
from halfstar.operators.split import flag_holdout
from halfstar.session import materialise
from halfstar.sources.tables import movies_from_tables, ratings_from_tables


@dataclass
class Prepared:
    """Ratings joined with their movies, flagged into train and holdout.

    ``fact`` is written partitioned by ``holdout``, so reading one side prunes
    the other; year, bare title and week are stored columns.
    """

    spark: SparkSession
    fact: DataFrame
    movies: DataFrame
    fits: dict = field(default_factory=dict)

    @property
    def train(self) -> DataFrame:
        return self.fact.where(~F.col("holdout")).drop("holdout")

    @property
    def holdout(self) -> DataFrame:
        return self.fact.where(F.col("holdout")).drop("holdout")

    @cached_property
    def movie_table(self) -> KeyedTable:
        """First title per movie seen in training, with its training support."""
        from halfstar.operators.explore import first_title_per_movie

        return KeyedTable.build(first_title_per_movie(self.train), "movieId")

    def fitted(self, name: str, build):
        """Build a shared intermediate once per prepared data set."""
        if name not in self.fits:
            self.fits[name] = build()
        return self.fits[name]


def enrich(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Left join ratings with movies; hot movies stay spread, listed or not."""
    columns = movies.select("movieId", "title", "genres")
    return lookup(ratings, KeyedTable.build(columns.withColumn("n", F.lit(0)), "movieId"))


def build(spark: SparkSession, ratings: DataFrame, movies: DataFrame) -> Prepared:
    """Write the prepared fact of any ratings / movies pair."""
    ratings = materialise(ratings, "ratings")
    movies = materialise(movies, "movies")
    # flagged before titles and genres join: which keys a split takes away does not hang on these
    flagged = enrich(flag_holdout(ratings), movies).withColumns(
        {"full_title": F.col("title"), "week": week_start(F.col("timestamp"))}
    )
    fact = title_parts(flagged)
    return Prepared(spark, materialise(fact, "fact", ["holdout"]), movies)


_prepared: dict[tuple[str, str, str], Prepared] = {}


def prepare(
    spark: SparkSession, sf_dir: str, ratings: Callable[[SparkSession, str], DataFrame] = ratings_from_tables
) -> Prepared:
    """Prepared tables of one input folder and way to read its ratings, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, ratings.__name__)
    if key not in _prepared:
        _prepared[key] = build(spark, ratings(spark, sf_dir), movies_from_tables(spark, sf_dir))
    return _prepared[key]
