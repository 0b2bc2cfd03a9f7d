import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from halfstar.functions import week_start
from halfstar.operators import effects as E
from halfstar.operators import regularise as R
from halfstar.operators import split as Z
from halfstar.operators.evaluate import comparison, rmse

SCHEMA = "userId int, movieId int, rating double, genres string, year int, week long"


@pytest.fixture(scope="module")
def tiny(spark):
    data = [
        (1, 1, 4.0, "A", 1990, 0), (1, 2, 2.0, "B", None, 0),
        (2, 1, 5.0, "A", 1990, 7), (2, 2, 3.0, "B", None, 7), (3, 1, 3.0, "A", 1990, 7),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_hand_computed_effects(spark, tiny):
    model = E.fit_all(tiny)
    mu = 17 / 5
    assert model.mu == pytest.approx(mu)
    b_i = {1: 4 - mu, 2: 2.5 - mu}
    got = dict(rows(model.tables["b_i"].df, "movieId", "b_i"))
    assert got == pytest.approx(b_i)
    b_u = {1: -0.25, 2: 0.75, 3: -1.0}
    assert dict(rows(model.tables["b_u"].df, "userId", "b_u")) == pytest.approx(b_u)
    year = {r["year"]: r["b_y"] for r in model.tables["b_y"].df.collect()}
    residual = {(1, 1): 0.25, (2, 1): 0.25, (3, 1): 0.0, (1, 2): -0.25, (2, 2): -0.25}
    assert year[1990] == pytest.approx(sum(residual[u, 1] for u in (1, 2, 3)) / 3)
    # titles without a year form a group of their own
    assert year[None] == pytest.approx(-0.25)


def test_missing_week(spark, tiny):
    model = E.fit_all(tiny)
    holdout = spark.createDataFrame([(1, 1, 4.0, "A", 1990, 99), (2, 1, 4.0, "A", 1990, 7)], SCHEMA)
    methods = {"time": ["b_i", "b_u", "b_t"]}
    strict = E.compare_effects(model, holdout, methods).first()
    assert (strict["n"], strict["n_null"], strict["rmse"]) == (2, 1, None)
    zero = E.compare_effects(model, holdout, methods, missing="zero").first()
    assert zero["n_null"] == 0 and zero["rmse"] is not None


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 5.0)], "rating double, pred double")
    assert rmse(df).first()["rmse"] == pytest.approx(math.sqrt(2.5))


def prepared(skewed):
    full = skewed.withColumns(
        {"genres": F.when(F.col("movieId") % 5 != 0, F.concat(F.lit("g"), F.col("movieId") % 4)),
         "year": F.when(F.col("movieId") % 7 != 0, 1990 + F.col("movieId") % 9),
         "week": week_start(F.col("timestamp"))}
    )
    flagged = Z.flag_holdout(full)
    return flagged.where("not holdout"), flagged.where("holdout")


def test_penalty_zero_is_the_plain_model(spark, skewed):
    train, holdout = prepared(skewed)
    plain = E.compare_effects(E.fit_movie_user(train), holdout, {"m": ["b_i", "b_u"]}).first()["rmse"]
    swept = R.sweep(train, holdout, "movie_user", [0.0, 5.0]).collect()
    assert [r["penalty"] for r in swept] == [0.0, 5.0]
    assert swept[0]["rmse"] == pytest.approx(plain, abs=1e-6)


@pytest.mark.parametrize("name", list(R.METHODS))
def test_sweep_against_brute_force(spark, skewed, name):
    train, holdout = (df.toPandas() for df in prepared(skewed))
    first, others = R.CHAINS[name]
    expected = []
    for x in (0.0, 2.5):
        mu = train.rating.mean()
        pen = lambda g: g.sum() / (g.count() + x)
        e0 = (train.rating - mu).groupby(train[first]).agg(pen)
        res = train.rating - mu - train[first].map(e0)
        pred = mu + holdout[first].map(e0)
        for key in others:
            t, h = train[key].astype(str), holdout[key].astype(str)
            pred = pred + h.map(res.groupby(t).agg(pen))
        expected.append(math.sqrt(((holdout.rating - pred) ** 2).mean()) if pred.notna().all() else None)
    got = [r["rmse"] for r in R.sweep(*prepared(skewed), name, [0.0, 2.5]).collect()]
    assert got == pytest.approx(expected)


def test_tuning_modes(spark, skewed):
    train, holdout = prepared(skewed)
    grid = [0.0, 1.0, 4.0]
    leaky = R.tune_and_score(train, holdout, "movie_user", "holdout", grid).first()
    fair = R.tune_and_score(train, holdout, "movie_user", "validation", grid).first()
    assert leaky["rmse"] <= fair["rmse"]


def test_comparison_names(spark):
    record = spark.createDataFrame([("m", 1, 0, 0.5)], "method string, n long, n_null long, rmse double")
    got = comparison([record], {"m": 1.25}, {"m": 0.00123})
    assert got.columns == ["Method", "RMSE", "Time (sec)", "Size (MB)"]
    assert tuple(got.first()) == ("m", 0.5, 1.25, 0.0012)
