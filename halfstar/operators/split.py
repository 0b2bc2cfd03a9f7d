"""Reproducible splits. Every choice hangs on a hash of the row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halfstar.functions import split_hash
from halfstar.operators.joins import KeyedTable, lookup, semi_join, support_table
from halfstar.session import materialise


def row_hash(user: str = "userId", item: str = "movieId") -> Column:
    return split_hash(F.col(user), F.col(item))


def candidate_holdout(buckets: int = 10) -> Column:
    """True for one row in ``buckets``."""
    return row_hash() % buckets == 0


def orphan_keys(ratings: DataFrame, in_holdout: Column) -> DataFrame:
    """Users and movies all of whose rows would leave the training set.

    One pass: both groupings are expanded on the map side and combined there.
    """
    flagged = ratings.select("userId", "movieId", in_holdout.alias("__out"))
    return (
        flagged.groupingSets(
            [[F.col("userId")], [F.col("movieId")]], F.col("userId"), F.col("movieId")
        )
        .agg(
            F.count("*").alias("n"),
            F.every("__out").alias("orphan"),
            F.grouping("userId").alias("of_movie"),
        )
        .where("orphan")
    )


def flag_holdout(ratings: DataFrame, buckets: int = 10) -> DataFrame:
    """Add boolean ``holdout``: hashed rows whose user and movie stay in training."""
    picked = candidate_holdout(buckets)
    orphans = materialise(orphan_keys(ratings, picked), "orphans")
    users = KeyedTable.of_written(
        orphans.where("of_movie = 0").select("userId", "n", F.lit(True).alias("lost_user")),
        "userId",
    )
    movies = KeyedTable.of_written(
        orphans.where("of_movie = 1").select("movieId", "n", F.lit(True).alias("lost_movie")),
        "movieId",
    )
    flagged = ratings.withColumn("holdout", picked)
    for table in (users, movies):
        if table.rows:
            flagged = lookup(flagged, table)
        else:
            flagged = flagged.withColumn(f"lost_{table.key[:-2]}", F.lit(None).cast("boolean"))
    keep = F.col("holdout") & F.col("lost_user").isNull() & F.col("lost_movie").isNull()
    return flagged.withColumn("holdout", keep).drop("lost_user", "lost_movie")


def split_holdout(ratings: DataFrame, buckets: int = 10) -> tuple[DataFrame, DataFrame]:
    """Hash split into (rest, candidate holdout); complementary by construction."""
    picked = candidate_holdout(buckets)
    return ratings.where(~picked), ratings.where(picked)


def consistent_holdout(train: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose movie and user both occur in ``train``."""
    return semi_join(semi_join(candidates, train, "movieId"), train, "userId")


def removed_rows(train: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates that did not survive: their movie or their user is not in ``train``."""
    marked = candidates
    for key in ("movieId", "userId"):
        marked = lookup(marked, support_table(train, key), [F.lit(True).alias(f"__has_{key}")])
    lost = F.col("__has_movieId").isNull() | F.col("__has_userId").isNull()
    return marked.where(lost).select(*candidates.columns)


def final_train(train: DataFrame, candidates: DataFrame) -> DataFrame:
    return train.unionByName(removed_rows(train, candidates))


def stratified_exact(df: DataFrame, stratum: str, share: float) -> DataFrame:
    """Exactly ``ceil(share * n)`` rows of each stratum, the smallest hashes first.

    Strata are few and huge, so no stratum is sorted in one task. A row is
    found by counting: rows per (stratum, hash bucket) give the bucket in which
    the cut falls; whole buckets below it are taken and only that one bucket
    (about 1/65536 of the stratum) is ranked.
    """
    bits = 16
    hashed = df.withColumn("__h", row_hash()).withColumn(
        "__b", F.shiftright(F.col("__h"), 32 - bits)
    )
    per_bucket = hashed.groupBy(stratum, "__b").agg(F.count("*").alias("__m"))
    running = Window.partitionBy(stratum).orderBy("__b").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cut = (
        per_bucket.withColumn("__upto", F.sum("__m").over(running))
        .withColumn("__n", F.sum("__m").over(Window.partitionBy(stratum)))
        .withColumn("__want", F.ceil(F.col("__n") * share))
        .where((F.col("__upto") >= F.col("__want")) & (F.col("__upto") - F.col("__m") < F.col("__want")))
        .select(
            stratum,
            F.col("__n").alias("n"),
            F.col("__b").alias("__cut"),
            (F.col("__want") - F.col("__upto") + F.col("__m")).alias("__left"),
        )
    )
    placed = lookup(hashed, KeyedTable.build(cut, stratum))
    whole = placed.where(F.col("__b") < F.col("__cut"))
    edge = placed.where(F.col("__b") == F.col("__cut")).withColumn(
        "__rn",
        F.row_number().over(
            Window.partitionBy(stratum).orderBy("__h", "userId", "movieId")
        ),
    )
    return whole.select(*df.columns).unionByName(
        edge.where(F.col("__rn") <= F.col("__left")).select(*df.columns)
    )


def share_split(df: DataFrame, share: float, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts, the first holding about ``share`` of the rows."""
    h = split_hash(F.col("userId"), F.col("movieId"), F.lit(salt)) if salt else row_hash()
    first = h % 1000 < int(round(share * 1000))
    return df.where(first), df.where(~first)


def fold_of(folds: int) -> Column:
    """Fold number 0..folds-1, independent of the holdout bucket of the same row."""
    return (F.floor(row_hash() / 10) % folds).cast("int")


def user_in_train(share: float = 0.6) -> Column:
    return split_hash(F.col("userId")) % 100 < int(round(share * 100))


def known_unknown(ratings: DataFrame, share: float = 0.6, hidden: int = 2) -> DataFrame:
    """Add ``part``: 'train' users, and 'known' / 'unknown' rows of the others.

    The ``hidden`` smallest hashes of a test user are withheld. Their limit is
    a bounded top-k per user (cut down before the shuffle by the window group
    limit), looked up by the user's rows, so no profile is sorted as a whole.
    """
    tested = ratings.where(~user_in_train(share)).withColumn("__h", row_hash())
    order = Window.partitionBy("userId").orderBy("__h", "movieId")
    withheld = tested.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") <= hidden)
    limits = withheld.groupBy("userId").agg(
        F.max(F.struct("__h", "movieId")).alias("__last"), F.count("*").alias("n")
    )
    table = KeyedTable.build(
        limits.select("userId", "n", F.col("__last.__h").alias("__lh"),
                      F.col("__last.movieId").alias("__lm")),
        "userId",
    )
    marked = lookup(ratings, table).withColumn("__h", row_hash())
    is_hidden = (F.col("__h") < F.col("__lh")) | (
        (F.col("__h") == F.col("__lh")) & (F.col("movieId") <= F.col("__lm"))
    )
    part = (
        F.when(F.col("__lh").isNull(), "train")
        .when(is_hidden, "unknown")
        .otherwise("known")
    )
    return marked.withColumn("part", part).select(*ratings.columns, "part")


def pick_user(ratings: DataFrame) -> int:
    """One user drawn by hash; an empty input is an error."""
    row = ratings.agg(
        F.min_by("userId", F.struct(split_hash(F.col("userId")), F.col("userId"))).alias("u")
    ).first()
    if row["u"] is None:
        raise ValueError("no users found")
    return row["u"]
