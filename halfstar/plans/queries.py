"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfstar import sources as S
from halfstar import streaming
from halfstar.functions import title_parts
from halfstar.operators import descent as D
from halfstar.operators import effects as E
from halfstar.operators import ensemble as T
from halfstar.operators import explore as X
from halfstar.operators import factor as A
from halfstar.operators import latent as L
from halfstar.operators import matrix as M
from halfstar.operators import models
from halfstar.operators import neighbours as N
from halfstar.operators import recommend as K
from halfstar.operators import regularise as R
from halfstar.operators import rsvd as V
from halfstar.operators import serving
from halfstar.operators import split as Z
from halfstar.operators import sweeps
from halfstar.operators.evaluate import SKIP, comparison, result_record, timed
from halfstar.operators.ids import dense_ids, dense_table, support_features, with_dense
from halfstar.operators.inverted import CosineIndex
from halfstar.operators.joins import KeyedTable, anti_join_all, keep_keys, natural_inner_join, semi_join
from halfstar.plans.prepare import Prepared, enrich, prepare
from halfstar.session import materialise, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

SIX = ["userId", "movieId", "rating", "timestamp", "title", "genres"]

# Support thresholds that suit the test tables.
GENRE_MIN, YEAR_MIN, HISTOGRAM_BELOW, GENRE_MORE_THAN = 100, 500, 40, 100
SVD_VALUES, NEIGHBOURS = 100, 350
#: Least cosine of the similar pairs, and neighbours per user of the bounded search.
SIMILAR, NEAREST = 0.3, 10
MF_RANKS, MF_REGS, CURVE_ITERATIONS = [10, 20, 30], [0.1, 0.2], list(range(1, 31))
CORNER = 40
SERVED_BLOCK = 1024
FOLD_PENALTIES = [0.0, 2.0, 5.0, 10.0]
SGD_RATES, SGD_EPOCHS, CURVE_STEP = [0.1, 0.2], 20, 15
FOUR_WEEKS = 4 * 7 * 86400


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def similarity(df: DataFrame) -> DataFrame:
    """Nine digits: shorter roundings of cosines hit exact ties too often."""
    return rounded(df, "sim", digits=9)


def labelled(kind: str, df: DataFrame, name: str = "kind") -> DataFrame:
    return df.select(F.lit(kind).alias(name), *df.columns)


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- sources and sinks ---------------------------------------------------------------


def _lines(df: DataFrame, sep: str) -> DataFrame:
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value"))


def parse_ratings_lines(spark, sf_dir):
    return S.parse_rating_lines(_lines(S.ratings_from_tables(spark, sf_dir), "::"))


def parse_movies_lines(spark, sf_dir):
    return S.parse_movie_lines(_lines(S.movies_from_tables(spark, sf_dir), "::"))


def _triplets(spark, sf_dir) -> DataFrame:
    return S.ratings_from_tables(spark, sf_dir).select(
        F.col("userId").alias("user"), F.col("movieId").alias("item"), "rating"
    )


def space_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "triplets")
    S.write_space_text(_triplets(spark, sf_dir), path)
    return S.read_space_text(spark, path, "user int, item int, rating double")


def training_log_parse(spark, sf_dir):
    per_user = S.ratings_from_tables(spark, sf_dir).groupBy("userId").agg(
        F.round(F.avg("rating"), 4).alias("a"), F.sum("rating").alias("b")
    )
    body = per_user.select(
        F.concat(F.lit("   "), F.concat_ws("      ", F.col("userId"), F.col("a"), F.col("b")), F.lit("  ")).alias("value")
    )
    header = body.limit(1).select(F.lit("iter      tr_rmse          obj").alias("value"))
    return S.parse_training_log(header.unionByName(body))


def ingest_repartitioned(spark, sf_dir):
    rows = _triplets(spark, sf_dir)
    part = Z.row_hash("user", "item") % 4
    return S.ingest_batches([rows.where(part == i) for i in range(4)], "ratings_ingested")


def ingest_files(spark, sf_dir):
    lines = _lines(S.ratings_from_tables(spark, sf_dir), "::")
    source = scratch_path(spark, "rating-files")
    lines.repartition(6).write.text(source)
    return streaming.ingest_files(
        spark, source, scratch_path(spark, "ingested"), scratch_path(spark, "ingest-log"), 2
    )


def prepare_ids(spark, sf_dir):
    rows = S.ratings_from_tables(spark, sf_dir).withColumns(
        {
            # ids go missing on the lowest and highest ratings
            "userId": F.when(F.col("rating") != 0.5, F.col("userId")),
            "movieId": F.when(F.col("rating") != 5.0, F.col("movieId")),
        }
    )
    return S.prepare_ids(rows).select("user", "item", "rating").dropna(how="any")


def result_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "results")
    S.save_result(rmse_all_effects(spark, sf_dir), path)
    return S.load_result(spark, path)


# --- joins and splits ----------------------------------------------------------------


def _enriched(spark, sf_dir) -> DataFrame:
    return _with_movies(spark, sf_dir, S.ratings_from_tables(spark, sf_dir))


def _with_movies(spark, sf_dir, ratings: DataFrame) -> DataFrame:
    """Title and genres join last, so that splits shuffle ids and numbers only."""
    return enrich(ratings, S.movies_from_tables(spark, sf_dir)).select(SIX)


def ratings_enriched(spark, sf_dir):
    return _enriched(spark, sf_dir)


def holdout_consistent(spark, sf_dir):
    return _with_movies(spark, sf_dir, Z.consistent_holdout(*Z.split_holdout(S.ratings_from_tables(spark, sf_dir))))


def holdout_removed(spark, sf_dir):
    return _with_movies(spark, sf_dir, Z.removed_rows(*Z.split_holdout(S.ratings_from_tables(spark, sf_dir))))


def train_final(spark, sf_dir):
    return _with_movies(spark, sf_dir, Z.final_train(*Z.split_holdout(S.ratings_from_tables(spark, sf_dir))))


def holdout_split(spark, sf_dir):
    flagged = Z.flag_holdout(S.ratings_from_tables(spark, sf_dir))
    return flagged.select("userId", "movieId", "holdout")


def dense_movie_join(spark, sf_dir):
    p = prepare(spark, sf_dir)
    full = p.train.unionByName(p.holdout).select(
        "userId", "movieId", "rating", "timestamp", F.col("full_title").alias("title"), "genres"
    )
    dense = with_dense(full, dense_table(full, "movieId"), "movieIdDense")
    return natural_inner_join(dense, full).select("userId", "movieIdDense", "rating", "title", "genres")


def stratified_exact(spark, sf_dir):
    rows = S.ratings_from_tables(spark, sf_dir).drop("timestamp")
    return Z.stratified_exact(rows, "rating", 0.1)


def known_unknown_split(spark, sf_dir):
    return Z.known_unknown(prepare(spark, sf_dir).train.select("userId", "movieId"))


def share_splits(spark, sf_dir):
    """Which side of the 70 / 30 and of the 90 / 10 split a training row is on."""
    rows = prepare(spark, sf_dir).train.select("userId", "movieId")
    parts = []
    for name, share, salt in (("70/30", 0.7, "trees"), ("90/10", 0.9, "latent")):
        for side, df in zip(("first", "second"), Z.share_split(rows, share, salt)):
            parts.append(df.select(F.lit(name).alias("split"), F.lit(side).alias("side"), "userId", "movieId"))
    return union(*parts)


def picked_user(spark, sf_dir):
    return prepare(spark, sf_dir).holdout.groupBy().agg(
        F.count("*").alias("rows"), F.lit(Z.pick_user(prepare(spark, sf_dir).holdout)).alias("userId")
    )


def rekeyed_ratings(spark, sf_dir) -> DataFrame:
    """Every rating, some of them moved to a user, a movie or a week of their own.

    The plain tables have no user, movie or week that a split takes away whole.
    """
    h = Z.row_hash()
    key = h % 50
    return S.ratings_from_tables(spark, sf_dir).select(
        F.when(key == 7, 2_000_000 + h % 100_000_000).otherwise(F.col("userId")).cast("int").alias("userId"),
        F.when(key == 8, 2_000_000 + h % 100_000_000).otherwise(F.col("movieId")).cast("int").alias("movieId"),
        "rating",
        F.when(key == 9, F.col("timestamp") + 604800 * (2000 + h % 500)).otherwise(F.col("timestamp")).alias("timestamp"),
    )


def rekeyed(spark, sf_dir) -> Prepared:
    return prepare(spark, sf_dir, rekeyed_ratings)


def rekeyed_removed(spark, sf_dir):
    return _with_movies(spark, sf_dir, Z.removed_rows(*Z.split_holdout(rekeyed_ratings(spark, sf_dir))))


def rekeyed_anti_join(spark, sf_dir):
    """The same rows as what is left of the candidates once the consistent ones are taken out."""
    train, candidates = Z.split_holdout(rekeyed_ratings(spark, sf_dir))
    return _with_movies(spark, sf_dir, anti_join_all(candidates, Z.consistent_holdout(train, candidates)))


def rekeyed_holdout(spark, sf_dir):
    return rekeyed(spark, sf_dir).fact.select("userId", "movieId", "holdout")


def rekeyed_effect_time(spark, sf_dir):
    """The time effect where some holdout weeks have no training row, in the three ways to count them."""
    p = rekeyed(spark, sf_dir)
    model = p.fitted("all", lambda: E.fit_all(p.train))
    method = "Movie + User + Time Effects"
    return union(
        *[
            labelled(mode, E.compare_effects(model, p.holdout, {method: E.METHODS[method]}, mode), "missing")
            for mode in ("strict", "skip", "zero")
        ]
    )


def rekeyed_top_genres(spark, sf_dir):
    return X.top_genres(rekeyed(spark, sf_dir).train)


def kfold_counts(spark, sf_dir):
    train = prepare(spark, sf_dir).train
    return union(
        *[
            train.groupBy(F.lit(k).alias("folds"), Z.fold_of(k).alias("fold")).agg(
                F.count("*").alias("n"), F.round(F.sum("rating"), 6).alias("sum_rating")
            )
            for k in (3, 20)
        ]
    )


# --- exploration ---------------------------------------------------------------------


def title_year(spark, sf_dir):
    return title_parts(S.movies_from_tables(spark, sf_dir)).select("movieId", "title", "year")


def on_train(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(prepare(spark, sf_dir).train)


def _bars(key: str, at_least: int) -> Query:
    return on_train(lambda t: rounded(X.error_bars(t, key, at_least), "avg", "se", "lower", "upper"))


def _support_histogram(train: DataFrame) -> DataFrame:
    return union(
        labelled("movie", X.support_histogram(train, "movieId")),
        labelled("movie below 40", X.support_histogram(train, "movieId", below=HISTOGRAM_BELOW)),
        labelled("user", X.support_histogram(train, "userId")),
    )


def _support_histogram_log(train: DataFrame) -> DataFrame:
    return union(
        labelled("movie", X.support_histogram(train, "movieId", log=True)),
        labelled("user", X.support_histogram(train, "userId", log=True)),
    )


def _dense_ids(train: DataFrame) -> DataFrame:
    return union(
        *[
            labelled(kind, dense_ids(train, key).select(F.col(key).alias("id"), "idx"))
            for kind, key in (("user", "userId"), ("movie", "movieId"))
        ]
    )


def common_users_items(spark, sf_dir):
    p = prepare(spark, sf_dir)
    return union(
        *[
            labelled(kind, X.common_keys(p.train, p.holdout, key).select(F.col(key).alias("id")))
            for kind, key in (("user", "userId"), ("movie", "movieId"))
        ]
    )


def support_features_query(spark, sf_dir):
    p = prepare(spark, sf_dir)
    columns = ["userId", "movieId", "n_movies_by_user", "n_users_by_movie"]
    return union(
        *[
            labelled(part, support_features(rows.select("userId", "movieId")).select(columns), "part")
            for part, rows in (("train", p.train), ("holdout", p.holdout))
        ]
    )


def weekly_trend(train: DataFrame) -> DataFrame:
    series = X.smoothed(X.mean_rating(train, "week"), "week", "rating", FOUR_WEEKS)
    return rounded(series, "rating", "trend")


# --- effects -------------------------------------------------------------------------


def movie_effects(p: Prepared) -> E.EffectModel:
    return p.fitted("movie", lambda: E.fit_movie(p.train))


def movie_user_effects(p: Prepared) -> E.EffectModel:
    return p.fitted("movie_user", lambda: E.fit_movie_user(p.train, movie_effects(p)))


def all_effects(p: Prepared) -> E.EffectModel:
    return p.fitted("all", lambda: E.fit_all(p.train, movie_user_effects(p)))


def _effect(method: str) -> Query:
    effects = E.METHODS[method]

    def run(spark, sf_dir):
        p = prepare(spark, sf_dir)
        if set(effects) <= {"b_i"}:
            model = movie_effects(p)
        elif set(effects) <= {"b_i", "b_u"}:
            model = movie_user_effects(p)
        else:
            model = all_effects(p)
        return E.compare_effects(model, p.holdout, {method: effects})

    return run


def rmse_all_effects(spark, sf_dir):
    p = prepare(spark, sf_dir)
    return E.compare_effects(all_effects(p), p.holdout)


def model_comparison(spark, sf_dir):
    sweeps = [
        R.best(sweep(prepare(spark, sf_dir), name)).select(
            F.lit(method).alias("method"), "n", "n_null", "rmse"
        )
        for name, method in R.METHODS.items()
    ]
    return comparison([rmse_all_effects(spark, sf_dir), *sweeps])


def model_comparison_measured(spark, sf_dir):
    """The effect models with scoring time and model size, which differ from run to run."""
    p = prepare(spark, sf_dir)
    model = all_effects(p)
    records, times, sizes = [], {}, {}
    for method, effects in E.METHODS.items():
        record, times[method] = timed(
            partial(materialise, E.compare_effects(model, p.holdout, {method: effects}), "record")
        )
        records.append(record)
        sizes[method] = model.size_mb(effects)
    return comparison(records, times, sizes)


def sweep(p: Prepared, name: str) -> DataFrame:
    """Penalty sweep scored on the holdout, as the reported figures are."""
    return p.fitted(f"sweep {name}", lambda: materialise(R.sweep(p.train, p.holdout, name), "sweep"))


def _sweep(name: str) -> Query:
    return lambda spark, sf_dir: rounded(R.mark_best(sweep(prepare(spark, sf_dir), name)), "rmse")


def reg_validated(spark, sf_dir):
    p = prepare(spark, sf_dir)
    return union(*[R.tune_and_score(p.train, p.holdout, name) for name in R.METHODS])


# --- matrix --------------------------------------------------------------------------


def train_matrix(p: Prepared) -> DataFrame:
    return p.fitted("matrix", lambda: materialise(M.rating_matrix(p.train), "matrix"))


def matrix_block(spark, sf_dir):
    return M.matrix_block(train_matrix(prepare(spark, sf_dir)), 10, 10)


def svd_energy(spark, sf_dir):
    """Energy of the leading singular values, within themselves and of the whole matrix."""
    matrix = train_matrix(prepare(spark, sf_dir))
    sigma = M.svd(matrix, SVD_VALUES, left=False).s.toArray().tolist()
    norm = matrix.agg(F.sum(F.pow("x", 2))).first()[0]
    whole = M.energy_table(spark, sigma, norm).select("k", F.col("share").alias("share_of_matrix"))
    return M.energy_table(spark, sigma).join(whole, "k")


def svd_factors(spark, sf_dir):
    """Rows and length of the left vectors, values and right vectors that hold 90 % of the energy."""
    found = M.svd(train_matrix(prepare(spark, sf_dir)), SVD_VALUES)
    k = max(1, M.choose_k(M.energy_table(spark, found.s.toArray().tolist())))
    return union(
        *[
            labelled(name, df.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("k")))
            for name, df in M.factor_tables(spark, found, k).items()
        ]
    )


def svd_randomised(spark, sf_dir):
    """Energy of the leading values, found in a fixed number of passes."""
    matrix = train_matrix(prepare(spark, sf_dir))
    return M.energy_table(spark, V.svd(matrix, SVD_VALUES, oversample=SVD_VALUES).values.tolist())


def svd_invariant(spark, sf_dir):
    """At full width the squared values of a corner of the matrix add up to its squared entries."""
    matrix = train_matrix(prepare(spark, sf_dir)).where((F.col("u") <= CORNER) & (F.col("i") <= CORNER))
    values = V.svd(matrix, CORNER).values
    shown = spark.createDataFrame([(float((values**2).sum()),)], "total double")
    return rounded(shown, "total")


def item_neighbours(spark, sf_dir):
    """The most similar movies of every movie by the cosine of centred ratings."""
    train = prepare(spark, sf_dir).train
    return N.item_similarity(N.center(train.select("userId", "movieId", "rating")), NEIGHBOURS).select("i", "j", "sim")


def user_neighbours(spark, sf_dir):
    """The most similar users of every user by the cosine of centred ratings."""
    train = prepare(spark, sf_dir).train
    return N.user_similarity(N.center(train.select("userId", "movieId", "rating")), NEIGHBOURS).select("i", "j", "sim")


def cosine_index(spark, sf_dir, row: str, column: str) -> CosineIndex:
    train = prepare(spark, sf_dir).train.select("userId", "movieId", "rating")
    return CosineIndex.build(N.center(train).select("userId", "movieId", "centred"), row, column, "centred")


def similar_movies(spark, sf_dir):
    """Pairs of movies whose centred ratings have a cosine of SIMILAR or more."""
    return cosine_index(spark, sf_dir, "userId", "movieId").similar(SIMILAR)


def similar_users(spark, sf_dir):
    """Pairs of users whose centred ratings have a cosine of SIMILAR or more."""
    return cosine_index(spark, sf_dir, "movieId", "userId").similar(SIMILAR)


def similar_nearest_users(spark, sf_dir):
    """The NEAREST most similar users of every user, from lists of ratings with bounds."""
    return cosine_index(spark, sf_dir, "movieId", "userId").nearest(NEAREST)


# --- neighbours and rules ------------------------------------------------------------


def cf_split(p: Prepared) -> DataFrame:
    """Training users plus known / unknown rows of test users."""
    rows = p.train.select("userId", "movieId", "rating")
    return p.fitted("cf split", lambda: materialise(Z.known_unknown(rows), "cf-split", ["part"]))


def _cf(method: str, score: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark, sf_dir):
        parts = cf_split(prepare(spark, sf_dir))
        return rounded(score(parts), "pred")

    return run


CF_METHODS = {
    "popular": N.popular,
    "user based": lambda parts: N.user_based(parts, NEIGHBOURS),
    "item based": lambda parts: N.item_based(parts, NEIGHBOURS),
}


def cf_rmse(spark, sf_dir):
    """The collaborative filters on relevant ratings, scored on the hidden ones."""
    p = prepare(spark, sf_dir)

    def build():
        rows = M.relevant_ratings(p.train.select("userId", "movieId", "rating"))
        return materialise(Z.known_unknown(rows), "cf-relevant", ["part"])

    parts = p.fitted("cf relevant", build)
    return union(*[result_record(score(parts), method) for method, score in CF_METHODS.items()])


def slope_one(spark, sf_dir):
    p = prepare(spark, sf_dir)
    return rounded(N.slope_one(p.train, p.holdout), "pred")


def slope_one_deviations(train: DataFrame) -> DataFrame:
    centred = N.center(train.select("userId", "movieId", "rating"))
    model = N.slope_one_model(centred.drop("rating").withColumnRenamed("centred", "rating"))
    return rounded(model.select("i", "j", "cnt", "dev"), "dev")


# --- factorisation and latent models --------------------------------------------------


def als_model(p: Prepared) -> ALSModel:
    """The rank-10 model that is saved as an ML model."""
    rows = p.train.select("userId", "movieId", "rating")
    return p.fitted("als rank 10 model", lambda: A.estimator(rows).fit(rows))


def als_factors(p: Prepared) -> A.Factors:
    """Rank 10, by sweeps with written vectors."""
    return p.fitted("als rank 10", lambda: sweeps.fit(A.no_gaps(p.train)))


def _record(method: str, scored: DataFrame) -> DataFrame:
    return result_record(scored, method, mode=SKIP)


def als_rank10(spark, sf_dir):
    p = prepare(spark, sf_dir)
    return _record("ALS rank 10", als_factors(p).score(p.holdout))


def als_rank20(spark, sf_dir):
    """Shared dense ids; scored on users and movies present on both sides."""
    p = prepare(spark, sf_dir)
    users, items = dense_table(p.train, "userId"), dense_table(p.train, "movieId")
    coded = [
        S.recode_ids(rows.select("userId", "movieId", "rating"), users, items).select(
            F.col("user").alias("userId"), F.col("item").alias("movieId"), "rating"
        )
        for rows in (p.train, p.holdout)
    ]
    train, holdout = coded
    factors = sweeps.fit(train, rank=20, reg=0.1, iterations=10)
    # every user and movie of the training rows has a vector
    common = keep_keys(keep_keys(holdout, factors.users), factors.items)
    return _record("ALS rank 20", factors.score(common))


MF_ITERATIONS = 20


def tuned(p: Prepared) -> tuple[dict, DataFrame]:
    """Best rank and penalty, and the grid they come from."""
    return p.fitted("mf grid", lambda: A.grid_search(p.train, MF_RANKS, MF_REGS))


def tuned_factors(p: Prepared) -> A.Factors:
    """Fit with the tuned parameters, save, reload: the model that is scored and served."""

    def build():
        path = scratch_path(p.spark, "mf-model")
        fitted = sweeps.fit(A.no_gaps(p.train), iterations=MF_ITERATIONS, **tuned(p)[0])
        S.save_tables({"users": fitted.users.df, "items": fitted.items.df}, path)
        loaded = S.load_tables(p.spark, path, ["users", "items"])
        return A.Factors(KeyedTable.of_written(loaded["users"], "userId"), KeyedTable.of_written(loaded["items"], "movieId"))

    return p.fitted("mf tuned", build)


def mf_als(spark, sf_dir):
    p = prepare(spark, sf_dir)
    return _record("MF", tuned_factors(p).score(p.holdout))


def mf_grid(spark, sf_dir):
    return rounded(tuned(prepare(spark, sf_dir))[1], "rmse")


def mf_from_text(spark, sf_dir):
    """Train and holdout written as text triplets, read back, fitted and scored."""
    p = prepare(spark, sf_dir)
    sides = []
    for name, rows in (("train", p.train), ("valid", p.holdout)):
        path = scratch_path(spark, f"{name}-text")
        S.write_space_text(rows.select("userId", "movieId", "rating"), path)
        sides.append(S.read_space_text(spark, path, "userId int, movieId int, rating double"))
    factors = sweeps.fit(A.no_gaps(sides[0]), iterations=MF_ITERATIONS, **tuned(p)[0])
    return _record("MF from text", factors.score(sides[1]))


def als_training_curve(spark, sf_dir):
    curve = A.training_curve(prepare(spark, sf_dir).train, CURVE_ITERATIONS)
    return rounded(curve, "tr_rmse", "obj")


def sgd_grid(p: Prepared) -> tuple[D.Params, DataFrame]:
    """Best rank and learning rate of the first tuning, and the grid."""
    return p.fitted("sgd grid", lambda: D.grid_search(p.train, MF_RANKS, SGD_RATES, epochs=10, folds=5))


def sgd_tuned(p: Prepared) -> D.Trained:
    """Refit with the tuned parameters; it goes on for the curve's epochs once it is scored."""
    return p.fitted("sgd tuned", lambda: D.fit(p.train, sgd_grid(p)[0], epochs=SGD_EPOCHS))


def sgd_curve(p: Prepared) -> DataFrame:
    """All points from one run."""
    return p.fitted("sgd curve", lambda: D.fit(p.train, sgd_grid(p)[0], epochs=len(CURVE_ITERATIONS)).curve_table())


def mf_sgd(spark, sf_dir):
    p = prepare(spark, sf_dir)
    return _record("MF by SGD", sgd_tuned(p).score(p.holdout))


def mf_sgd_grid(spark, sf_dir):
    return rounded(sgd_grid(prepare(spark, sf_dir))[1], "rmse")


def mf_sgd_curve(spark, sf_dir):
    return rounded(sgd_curve(prepare(spark, sf_dir)).drop("model"), "tr_rmse", "obj")


def mf_curve_step(spark, sf_dir):
    """The curve's value at one step."""
    curve = sgd_curve(prepare(spark, sf_dir))
    return rounded(curve.where(F.col("iter") == CURVE_STEP).select("iter", "tr_rmse"), "tr_rmse")


def _biased_sgd(method: str, bounded: bool) -> Query:
    """Biases and factors fitted jointly, with a linear or a bounded link."""

    def run(spark, sf_dir):
        p = prepare(spark, sf_dir)
        columns = ["userId", "movieId", "rating"]
        full = p.train.select(columns).unionByName(p.holdout.select(columns))
        train, valid = Z.share_split(full, 0.9, "latent")
        bounds = L.rating_range(train) if bounded else None
        return _record(method, D.fit(train, D.Params(rank=50, rate=0.1, bounds=bounds), epochs=10).score(valid))

    return run


def factor_score(spark, sf_dir):
    p = prepare(spark, sf_dir)
    scored = als_factors(p).score(p.holdout.select("userId", "movieId", "rating"))
    return rounded(scored, "pred")


def model_roundtrip(spark, sf_dir):
    p = prepare(spark, sf_dir)
    path = scratch_path(spark, "als-model")
    S.save_als(als_model(p), path)
    scored = A.scored(S.load_als(path), p.holdout.select("userId", "movieId", "rating"))
    return _record("ALS rank 10, reloaded", scored)


def _biased(method: str, bounded: bool) -> Query:
    def run(spark, sf_dir):
        p = prepare(spark, sf_dir)
        columns = ["userId", "movieId", "rating"]
        full = p.train.select(columns).unionByName(p.holdout.select(columns))
        train, valid = Z.share_split(full, 0.9, "latent")
        return _record(method, L.fit(train, bounded=bounded).score(valid))

    return run


def latent_logit_biases(spark, sf_dir):
    """Biases of the bounded model, fitted on log-odds of the rating's place in its range."""
    columns = ["userId", "movieId", "rating"]
    p = prepare(spark, sf_dir)
    full = p.train.select(columns).unionByName(p.holdout.select(columns))
    _, biases, _ = L.fit_biases(Z.share_split(full, 0.9, "latent")[0], bounded=True)
    parts = [
        labelled(name, biases.tables[name].df.select(F.col(E.KEYS[name]).alias("id"), F.col(name).alias("bias")))
        for name in ("b_i", "b_u")
    ]
    return rounded(union(*parts), "bias")


# --- models saved and tuned as ML estimators -------------------------------------------


def _reloaded(fit: Callable[[], models.Estimator]) -> Query:
    """Fit, save, load, and score the holdout with what was loaded."""

    def run(spark, sf_dir):
        p = prepare(spark, sf_dir)
        model = fit().fit(p.train.select("userId", "movieId", "rating"))
        path = scratch_path(spark, "saved-model")
        model.write().save(path)
        scored = type(model).load(path).transform(p.holdout.select("userId", "movieId", "rating"))
        return rounded(scored.withColumnRenamed("prediction", "pred"), "pred")

    return run


def effect_folds(spark, sf_dir):
    """Penalties of the effect model tuned by cross-validation: mean RMSE of the folds."""
    rows = prepare(spark, sf_dir).train.select("userId", "movieId", "rating", Z.fold_of(3).alias("fold"))
    estimator = models.MovieUserEffects(missing="zero")
    grid = ParamGridBuilder().addGrid(estimator.penalty, FOLD_PENALTIES).build()
    fitted = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="rating"),
        numFolds=3, foldCol="fold", parallelism=len(grid),
    ).fit(rows)
    best = fitted.bestModel.getOrDefault("penalty")
    table = [(x, float(m), x == best) for x, m in zip(FOLD_PENALTIES, fitted.avgMetrics)]
    return rounded(spark.createDataFrame(table, "penalty double, rmse double, best boolean"), "rmse")


# --- trees and ensemble --------------------------------------------------------------


def tree_split(p: Prepared) -> tuple[DataFrame, DataFrame, DataFrame]:
    """70 / 30 split of the training rows, and the holdout, with support counts."""

    def build():
        rows = materialise(T.tree_rows(p.train), "tree-rows")
        return (*Z.share_split(rows, 0.7, "trees"), materialise(T.tree_rows(p.holdout), "tree-rows"))

    return p.fitted("tree split", build)


TREE_MODELS = {
    "gbt_support": (T.boosted, [*T.IDS, *T.SUPPORT]),
    "gbt_ids": (T.boosted, T.IDS),
    "rf_support": (T.forest, [*T.IDS, "timestamp", *T.SUPPORT]),
    "rf_ids": (T.forest, T.IDS),
}
STACKED = {"gbt": "gbt_ids", "rf": "rf_ids"}


def tree_encoder(p: Prepared) -> T.TargetEncoder:
    return p.fitted("tree encoder", lambda: T.TargetEncoder.fit(tree_split(p)[0]))


def tree_fit(p: Prepared, name: str) -> T.TreeFit:
    make, features = TREE_MODELS[name]
    return p.fitted(name, lambda: T.fit_trees(tree_split(p)[0], make, features, tree_encoder(p)))


def fold_inputs(p: Prepared) -> T.FoldInputs:
    return p.fitted("fold inputs", lambda: T.FoldInputs.of(tree_split(p)[0], tree_encoder(p)))


def tree_folds(p: Prepared, name: str) -> tuple[list, list[str]]:
    """Models per fold and their features."""
    make, features = TREE_MODELS[name]
    return p.fitted(f"{name} folds", lambda: (T.fold_models(fold_inputs(p), make, features), features))


def _tree(name: str, cross_validated: bool) -> Query:
    def run(spark, sf_dir):
        p = prepare(spark, sf_dir)
        train, test, holdout = tree_split(p)
        tree_encoder(p)
        if cross_validated:
            fold_inputs(p)
            T.together(spark, [lambda: tree_fit(p, name), lambda: tree_folds(p, name)])
        out = T.performance(
            tree_fit(p, name), {"train": train, "test": test, "holdout": holdout}, name
        )
        if cross_validated:
            oof = result_record(T.score_folds(fold_inputs(p), {"pred": tree_folds(p, name)}), name)
            out = out.unionByName(oof.withColumn("part", F.lit("out of fold")))
        return out

    return run


def _both_oof(p: Prepared) -> DataFrame:
    for name in STACKED.values():
        tree_folds(p, name)
    return T.score_folds(fold_inputs(p), {k: tree_folds(p, name) for k, name in STACKED.items()})


def tree_importances(spark, sf_dir):
    """How much each feature adds to the boosted model with support counts."""
    found = tree_fit(prepare(spark, sf_dir), "gbt_support").importances()
    return rounded(spark.createDataFrame(found, "feature string, importance double"), "importance")


def oof_predictions(spark, sf_dir):
    return rounded(_both_oof(prepare(spark, sf_dir)), "gbt", "rf")


def _encoded(p: Prepared) -> DataFrame:
    """Rows of every fold with the encodings learnt outside it."""
    return reduce(DataFrame.unionByName, fold_inputs(p).score)


def tree_features(spark, sf_dir):
    encoded = _encoded(prepare(spark, sf_dir))
    return rounded(encoded.select("userId", "movieId", "fold", "te_movieId", "te_userId"), "te_movieId", "te_userId")


def oof_coverage(spark, sf_dir):
    """Every row is scored by both models, once, in its own fold."""
    return _both_oof(prepare(spark, sf_dir)).groupBy("fold").agg(
        F.count("*").alias("n"), F.count("gbt").alias("n_gbt"), F.count("rf").alias("n_rf"),
        F.count_distinct("userId", "movieId").alias("n_pairs"), F.round(F.sum("rating"), 6).alias("sum_rating"),
    )


def stack_fixed(spark, sf_dir):
    """The linear blend, with the two encodings in place of model scores."""
    columns = ["te_movieId", "te_userId"]
    blend = T.stack(_encoded(prepare(spark, sf_dir)), columns)
    table = [("intercept", float(blend.intercept)), *zip(columns, blend.coefficients.toArray().tolist())]
    return rounded(spark.createDataFrame(table, "term string, weight double"), "weight")


def stacked_nonnegative(spark, sf_dir):
    """Blends by weights that are not below 0; in the second one the second column has to stay out."""
    encoded = _encoded(prepare(spark, sf_dir)).withColumn("turned", -F.col("te_userId"))
    table = [
        (name, term, float(w))
        for name, columns in (("both", ["te_movieId", "te_userId"]), ("one", ["te_movieId", "turned"]))
        for term, w in T.stack_nonnegative(encoded, columns).items()
    ]
    return rounded(spark.createDataFrame(table, "blend string, term string, weight double"), "weight")


def stacked_ensemble(spark, sf_dir):
    p = prepare(spark, sf_dir)
    blend = T.stack(_both_oof(p), list(STACKED))
    scored = T.stacked_score(
        blend, {k: tree_fit(p, name) for k, name in STACKED.items()}, tree_split(p)[2]
    )
    return _record("Stacked GBT + RF", scored)


# --- serving -------------------------------------------------------------------------


def recommend_top_bottom(spark, sf_dir):
    p = prepare(spark, sf_dir)
    user = Z.pick_user(p.holdout)
    return K.top_bottom(tuned_factors(p), [user], p.movie_table)


def effect_factors(p: Prepared) -> A.Factors:
    """The movie + user effect model as factors: (b_u, mu, 1) times (1, 1, b_i)."""
    model = movie_user_effects(p)
    one = F.lit(1.0)
    users = model.tables["b_u"].df.select("userId", "n", F.array("b_u", F.lit(model.mu), one).alias("features"))
    items = model.tables["b_i"].df.select("movieId", "n", F.array(one, one, F.col("b_i")).alias("features"))
    return A.Factors(KeyedTable.build(users, "userId"), KeyedTable.build(items, "movieId"))


def _picks(p: Prepared, item_block: int) -> DataFrame:
    factors = p.fitted("effect factors", lambda: effect_factors(p))
    seen = p.train.select("userId", "movieId")
    served = {
        kind: serving.recommend_pruned(factors, p.movie_table, seen=left_out, item_block=item_block)
        for kind, left_out in (("all", None), ("unseen", seen))
    }
    return union(
        *[labelled(kind, s.picks, "among").drop("title", "genres", "year") for kind, s in served.items()]
    )


def recommend_batch(spark, sf_dir):
    """Picks of every user among all movies, and among those not yet rated."""
    return _picks(prepare(spark, sf_dir), K.ITEM_BLOCK)


def recommend_pruned(spark, sf_dir):
    """The rows of ``recommend_batch``, by smaller blocks of items that can still hold a pick."""
    return _picks(prepare(spark, sf_dir), SERVED_BLOCK)


def factor_score_effects(spark, sf_dir):
    p = prepare(spark, sf_dir)
    factors = p.fitted("effect factors", lambda: effect_factors(p))
    return rounded(factors.score(p.holdout.select("userId", "movieId", "rating")), "pred")


def recommend_effects(spark, sf_dir):
    p = prepare(spark, sf_dir)
    return K.effect_picks(movie_user_effects(p), p.movie_table)


def queries() -> dict[str, Query]:
    return {
        "parse_ratings_lines": parse_ratings_lines,
        "parse_movies_lines": parse_movies_lines,
        "space_text_roundtrip": space_text_roundtrip,
        "training_log_parse": training_log_parse,
        "ingest_repartitioned": ingest_repartitioned,
        "ingest_files": ingest_files,
        "prepare_ids": prepare_ids,
        "result_roundtrip": result_roundtrip,
        "ratings_enriched": ratings_enriched,
        "holdout_consistent": holdout_consistent,
        "holdout_removed": holdout_removed,
        "train_final": train_final,
        "holdout_split": holdout_split,
        "dense_movie_join": dense_movie_join,
        "stratified_exact": stratified_exact,
        "known_unknown_split": known_unknown_split,
        "kfold_counts": kfold_counts,
        "title_year": title_year,
        "star_class_counts": on_train(X.star_class_counts),
        "rating_histogram": on_train(X.rating_histogram),
        "top_genres": on_train(X.top_genres),
        "top5_genres": on_train(lambda t: X.head(X.genre_counts(t), 5, F.desc("count"), "genres")),
        "top_years": on_train(X.top_years),
        "top_titles": on_train(X.top_titles),
        "top20_titles": on_train(lambda t: X.top_n_with_ties(X.title_counts(t), 20)),
        "genre_error_bars": _bars("genres", GENRE_MIN),
        "year_error_bars": _bars("year", YEAR_MIN),
        "distinct_counts": on_train(X.distinct_counts),
        "counts_per_movie": on_train(lambda t: X.counts_by(t, "movieId", "movieId")),
        "counts_per_user": on_train(lambda t: X.counts_by(t, "userId", "userId")),
        "support_histogram": on_train(_support_histogram),
        "support_histogram_log": on_train(_support_histogram_log),
        "weekly_mean_rating": on_train(lambda t: rounded(X.mean_rating(t, "week"), "rating")),
        "weekly_trend": on_train(weekly_trend),
        "genre_mean_rating": on_train(lambda t: rounded(X.mean_rating(t, "genres"), "rating")),
        "year_mean_rating": on_train(lambda t: rounded(X.mean_rating(t, "year"), "rating")),
        "filter_by_genre_support": on_train(
            lambda t: X.filter_by_genre_support(t, GENRE_MORE_THAN).select(
                "userId", "movieId", "rating", "genres"
            )
        ),
        "cumulative_share": on_train(
            lambda t: rounded(
                X.cumulative_share(X.counts_by(t, "movieId", "movieId"), "movieId", "count"), "share"
            )
        ),
        "dense_ids": on_train(_dense_ids),
        "first_title_per_movie": on_train(lambda t: X.first_title_per_movie(t).drop("n")),
        "common_users_items": common_users_items,
        "support_features": support_features_query,
        "effect_mu": _effect("Mu"),
        "effect_movie": _effect("Movie Effect"),
        "effect_movie_user": _effect("Movie + User Effects"),
        "effect_time": _effect("Movie + User + Time Effects"),
        "effect_genre": _effect("Movie + User + Genre Effects"),
        "effect_year": _effect("Movie + User + Year Effects"),
        "effect_all": _effect("Movie + User + Time + Genre + Year Effects"),
        "rmse_all_effects": rmse_all_effects,
        "reg_movie_user": _sweep("movie_user"),
        "reg_user_movie": _sweep("user_movie"),
        "reg_all": _sweep("all"),
        "reg_validated": reg_validated,
        "model_comparison": model_comparison,
        "model_comparison_measured": model_comparison_measured,
        "rating_matrix": on_train(M.rating_matrix),
        "matrix_block": matrix_block,
        "user_cosine": on_train(lambda t: similarity(M.user_cosine(t))),
        "item_cosine": on_train(lambda t: similarity(M.item_cosine(t))),
        "item_cosine_corated": on_train(lambda t: similarity(M.item_cosine(t, norm="corated"))),
        "svd_energy": svd_energy,
        "svd_randomised": svd_randomised,
        "svd_invariant": svd_invariant,
        "item_neighbours": item_neighbours,
        "user_neighbours": user_neighbours,
        "similar_movies": similar_movies,
        "similar_users": similar_users,
        "similar_nearest_users": similar_nearest_users,
        "center_ratings": on_train(
            lambda t: rounded(N.center(t.select("userId", "movieId", "rating")), "mean", "centred")
        ),
        "cf_popular": _cf("popular", N.popular),
        "cf_user_based": _cf("user based", lambda parts: N.user_based(parts, NEIGHBOURS)),
        "cf_item_based": _cf("item based", lambda parts: N.item_based(parts, NEIGHBOURS)),
        "slope_one_deviations": on_train(slope_one_deviations),
        "slope_one": slope_one,
        "mf_als": mf_als,
        "mf_grid": mf_grid,
        "mf_from_text": mf_from_text,
        "als_rank10": als_rank10,
        "als_rank20": als_rank20,
        "als_training_curve": als_training_curve,
        "mf_sgd_grid": mf_sgd_grid,
        "mf_sgd": mf_sgd,
        "mf_sgd_curve": mf_sgd_curve,
        "mf_curve_step": mf_curve_step,
        "biased_sgd_bounded": _biased_sgd("Biased factors by SGD, bounded", True),
        "biased_sgd_linear": _biased_sgd("Biased factors by SGD, linear", False),
        "factor_score": factor_score,
        "model_roundtrip": model_roundtrip,
        "gbt_support": _tree("gbt_support", True),
        "tree_importances": tree_importances,
        "gbt_ids": _tree("gbt_ids", True),
        "rf_support": _tree("rf_support", False),
        "rf_ids": _tree("rf_ids", True),
        "latent_logit_biases": latent_logit_biases,
        "effect_roundtrip": _reloaded(models.MovieUserEffects),
        "slope_one_roundtrip": _reloaded(models.SlopeOne),
        "item_model_roundtrip": _reloaded(partial(models.ItemNeighbours, k=NEIGHBOURS)),
        "effect_folds": effect_folds,
        "tree_features": tree_features,
        "oof_coverage": oof_coverage,
        "stack_fixed": stack_fixed,
        "stacked_nonnegative": stacked_nonnegative,
        "oof_predictions": oof_predictions,
        "stacked_ensemble": stacked_ensemble,
        "biased_factor_bounded": _biased("Biased factors, bounded", True),
        "biased_factor_linear": _biased("Biased factors, linear", False),
        "recommend_top_bottom": recommend_top_bottom,
        "recommend_effects": recommend_effects,
        "recommend_batch": recommend_batch,
        "recommend_pruned": recommend_pruned,
        "factor_score_effects": factor_score_effects,
        "svd_factors": svd_factors,
        "cf_rmse": cf_rmse,
        "share_splits": share_splits,
        "picked_user": picked_user,
        "rating_range": on_train(lambda t: t.agg(F.min("rating").alias("least"), F.max("rating").alias("most"))),
        "rekeyed_removed": rekeyed_removed,
        "rekeyed_anti_join": rekeyed_anti_join,
        "rekeyed_holdout": rekeyed_holdout,
        "rekeyed_effect_time": rekeyed_effect_time,
        "rekeyed_top_genres": rekeyed_top_genres,
        "relevant_ratings": on_train(
            lambda t: M.relevant_ratings(t.select("userId", "movieId", "rating"))
        ),
    }
