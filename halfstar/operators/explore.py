"""Exploratory questions over the enriched ratings.

Every aggregate is a plain group-by (combined on the map side), so a key that
holds a third of the rows costs one partial row per task. Ranking and binning
run on the aggregated tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halfstar.functions import genre_array, star_class
from halfstar.operators.joins import KeyedTable, keep_keys
from halfstar.session import materialise


def counts_by(df: DataFrame, key: str | Column, name: str) -> DataFrame:
    column = F.col(key) if isinstance(key, str) else key
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("count"))


def by_count(counts: DataFrame, key: str) -> DataFrame:
    return counts.orderBy(F.desc("count"), key)


def genre_combinations(df: DataFrame) -> DataFrame:
    return counts_by(df, "genres", "genres")


def genre_counts(df: DataFrame) -> DataFrame:
    """Ratings per single genre; movies without genres are a NULL group.

    Counting whole combinations first means only distinct combinations are
    exploded, not ratings.
    """
    return (
        genre_combinations(df)
        .select(F.explode_outer(genre_array(F.col("genres"))).alias("genres"), "count")
        .groupBy("genres")
        .agg(F.sum("count").alias("count"))
    )


def top_genres(df: DataFrame) -> DataFrame:
    return by_count(genre_counts(df), "genres")


def top_years(df: DataFrame) -> DataFrame:
    return by_count(counts_by(df, "year", "year"), "year")


def title_counts(df: DataFrame) -> DataFrame:
    """Ratings per bare title; one title released in two years is one row."""
    return counts_by(df, "title", "title")


def top_titles(df: DataFrame) -> DataFrame:
    return by_count(title_counts(df), "title")


def head(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows in a stated order (a top-k without a full sort)."""
    return df.orderBy(*order).limit(n)


def top_n_with_ties(counts: DataFrame, n: int, value: str = "count") -> DataFrame:
    """Rows whose value is at least the n-th largest, ties included.

    The n-th value is a scalar subquery over a bounded top-k, so ties of any
    number never meet in one task as they would in a global rank.
    """
    nth = counts.orderBy(F.desc(value)).limit(n).agg(F.min(value)).scalar()
    return counts.where(F.col(value) >= nth)


def error_bars(df: DataFrame, key: str, min_count: int) -> DataFrame:
    """Mean rating with a band of two standard errors per key, kept by support."""
    n, mean, spread = F.count("*"), F.avg("rating"), F.stddev_samp("rating")
    summary = df.groupBy(key).agg(
        n.alias("n"), mean.alias("avg"), (spread / F.sqrt(n)).alias("se")
    )
    return (
        summary.where(F.col("n") >= min_count)
        .withColumns({"lower": F.col("avg") - 2 * F.col("se"), "upper": F.col("avg") + 2 * F.col("se")})
        .orderBy("avg", key)
    )


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count("userId").alias("n_users"), count("movieId").alias("n_movies"))


def star_class_counts(df: DataFrame) -> DataFrame:
    return counts_by(df, star_class(F.col("rating")), "ratings_group")


def rating_histogram(df: DataFrame, width: float = 0.5) -> DataFrame:
    bucket = F.floor(F.col("rating") / width) * width
    return df.groupBy(
        bucket.alias("bucket"), star_class(F.col("rating")).alias("ratings_group")
    ).agg(F.count("*").alias("count"))


def support_histogram(
    df: DataFrame, key: str, bins: int = 30, below: int | None = None, log: bool = False
) -> DataFrame:
    """Histogram of rows per key in equal bins between the smallest and largest.

    Counts are themselves counted before binning, so the range and the bins
    are computed on one row per distinct count.
    """
    frequency = (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .groupBy("n")
        .agg(F.count("*").alias("keys"))
    )
    if below is not None:
        frequency = frequency.where(F.col("n") < below)
    points = frequency.select((F.log10("n") if log else F.col("n").cast("double")).alias("x"), "keys")
    low, high = points.agg(F.min("x")).scalar(), points.agg(F.max("x")).scalar()
    ranged = points.withColumns({"lo": low, "width": (high - low) / bins})
    place = F.when(F.col("width") == 0, F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide(F.col("x") - F.col("lo"), F.col("width"))), F.lit(bins - 1))
    )
    return ranged.groupBy(place.cast("int").alias("bin")).agg(
        F.round(F.min(F.col("lo") + place * F.col("width")), 6).alias("bin_start"),
        F.sum("keys").alias("frequency"),
    )


def mean_rating(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg("rating").alias("rating"))


def smoothed(series: DataFrame, x: str, y: str, half_width: int) -> DataFrame:
    """Centred moving average of a per-key series over ``x`` +- ``half_width``.

    A range-window trend line, not a loess fit. Input is an aggregated series
    (one row per week or year), hence the single-partition window.
    """
    around = Window.orderBy(x).rangeBetween(-half_width, half_width)
    return series.withColumn("trend", F.avg(y).over(around))


def filter_by_genre_support(df: DataFrame, more_than: int) -> DataFrame:
    """Rows of genre combinations rated more than ``more_than`` times."""
    kept = genre_combinations(df).where(F.col("count") > more_than)
    return keep_keys(df, KeyedTable.build(kept.withColumnRenamed("count", "n"), "genres"))


def cumulative_share(values: DataFrame, order: str, value: str) -> DataFrame:
    """Running share of squared values, largest first.

    The running sum is taken per range partition and shifted by the partitions
    before it, so no global single-task window is needed.
    """
    ranked = materialise(
        values.repartitionByRange(F.desc(value), order)
        .sortWithinPartitions(F.desc(value), order)
        .withColumns(
            {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}
        ),
        "ranked",
    )
    square = F.pow(value, 2)
    sizes = ranked.groupBy("part").agg(F.sum(square).alias("energy"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part",
        F.coalesce(F.sum("energy").over(before), F.lit(0.0)).alias("offset"),
        F.sum("energy").over(Window.partitionBy()).alias("whole"),
    )
    running = Window.partitionBy("part").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # one offset row per range partition
    return ranked.join(F.broadcast(offsets), "part").select(
        order, value, ((F.col("offset") + F.sum(square).over(running)) / F.col("whole")).alias("share")
    )


def first_title_per_movie(df: DataFrame) -> DataFrame:
    """One title, genres and year per movie: the smallest row in a fixed order.

    An aggregate, not a window: it combines on the map side.
    """
    first = F.min(F.struct("title", "genres", "year"))
    return df.groupBy("movieId").agg(F.count("*").alias("n"), first.alias("first")).select(
        "movieId", "n", "first.title", "first.genres", "first.year"
    )


def common_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present on both sides; only distinct keys are shuffled."""
    return left.select(key).distinct().intersect(right.select(key).distinct())


def exact_quantile(counts: DataFrame, value: str, q: float) -> float:
    """Linear-interpolation quantile over counts-of-counts."""
    frequency = counts.groupBy(value).agg(F.count("*").alias("__f"))
    return frequency.agg(F.percentile(value, q, F.col("__f")).alias("q")).first()["q"]
