import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from halfstar.operators import effects as E
from halfstar.operators import ensemble as T
from halfstar.operators import explore as X
from halfstar.operators import factor as A
from halfstar.operators import latent as L
from halfstar.operators import recommend as K
from halfstar.operators import split as Z
from halfstar.operators.evaluate import SKIP, rmse
from halfstar.operators.joins import KeyedTable
from halfstar.sources import load_als, save_als


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings with a rank-2 signal on a 0.5..5 scale and a little noise."""
    rng = np.random.default_rng(42)
    p, q = rng.normal(size=(60, 2)), rng.normal(size=(40, 2))
    value = np.clip(2.75 + p @ q.T + rng.normal(scale=0.1, size=(60, 40)), 0.5, 5.0)
    data = [
        (u + 1, i + 1, float(value[u, i]), 1_000_000_000 + 1000 * u + i)
        for u in range(60) for i in range(40) if rng.random() < 0.7
    ]
    df = spark.createDataFrame(data, "userId int, movieId int, rating double, timestamp long")
    flagged = Z.flag_holdout(df).cache()
    return flagged.where("not holdout").drop("holdout"), flagged.where("holdout").drop("holdout")


def error(scored):
    return rmse(scored, mode=SKIP).first()["rmse"]


@pytest.fixture(scope="module")
def baseline(planted):
    train, holdout = planted
    mu = train.agg(F.avg("rating")).first()[0]
    return error(holdout.withColumn("pred", F.lit(mu)))


def test_als_recovers_signal_and_scores_like_the_model(spark, planted, baseline, tmp_path):
    train, holdout = planted
    model = A.estimator(train, rank=4, reg=0.02, iterations=10).fit(train)
    factors = A.Factors.of(model, train)
    ours = factors.score(holdout)
    assert error(ours) < 0.5 * baseline
    save_als(model, str(tmp_path / "m"))
    theirs = load_als(str(tmp_path / "m")).transform(holdout)
    both = ours.join(theirs.select("userId", "movieId", "prediction"), ["userId", "movieId"])
    assert both.agg(F.max(F.abs(F.col("pred") - F.col("prediction")))).first()[0] < 1e-4
    cold = factors.score(spark.createDataFrame([(999, 1)], "userId int, movieId int")).first()
    assert cold["pred"] is None


def test_grid_and_curve(planted):
    train, _ = planted
    _, table = A.grid_search(train, [1, 3], [0.05], iterations=5)
    got = table.collect()
    assert [r["rank"] for r in got if r["is_best"]] == [3]
    curve = A.training_curve(train, [1, 6], rank=3, reg=0.02).collect()
    assert curve[1]["tr_rmse"] < curve[0]["tr_rmse"] and curve[1]["obj"] < curve[0]["obj"]


@pytest.mark.parametrize("bounded", [False, True])
def test_biased_factors(planted, baseline, bounded):
    train, holdout = planted
    scored = L.fit(train, rank=4, reg=0.05, bounded=bounded).score(holdout)
    assert error(scored) < 0.6 * baseline
    if bounded:
        assert scored.where("pred < 0.5 or pred > 5").count() == 0


def test_encoder_never_sees_its_own_fold(spark):
    data = [(1, 1, 5.0, 0), (1, 1, 3.0, 1), (1, 1, 1.0, 2)]
    df = spark.createDataFrame(data, "userId int, movieId int, rating double, fold int")
    enc = T.TargetEncoder.fit(df)
    shrunk = lambda total, n: (total + T.PENALTY * 3.0) / (n + T.PENALTY)
    own = {r["fold"]: r["te_userId"] for r in enc.encode(df, own_fold=True).collect()}
    assert own == pytest.approx({0: shrunk(4, 2), 1: shrunk(6, 2), 2: shrunk(8, 2)})
    both = {r["fold"]: r["te_userId"] for r in enc.encode(df, hide_fold=0, own_fold=True).collect()}
    assert both == pytest.approx({0: shrunk(4, 2), 1: shrunk(1, 1), 2: shrunk(3, 1)})
    new = enc.encode(spark.createDataFrame([(8, 8)], "userId int, movieId int")).first()
    assert new["te_userId"] == pytest.approx(3.0)


def test_out_of_fold_and_stack(planted, baseline):
    train, holdout = (T.tree_rows(df) for df in planted)
    small = lambda: T.boosted(trees=5, depth=3)
    wood = lambda: T.forest(trees=5, depth=4)
    oof = None
    for name, make in (("gbt", small), ("rf", wood)):
        part = T.out_of_fold(train, make, T.IDS, name)
        assert part.count() == train.count()
        assert part.select("userId", "movieId").distinct().count() == train.count()
        keep = part.select("userId", "movieId", "rating", name)
        oof = keep if oof is None else oof.join(keep.drop("rating"), ["userId", "movieId"])
    fits = {"gbt": T.fit_trees(train, small, T.IDS), "rf": T.fit_trees(train, wood, [*T.IDS, "timestamp", *T.SUPPORT])}
    scored = T.stacked_score(T.stack(oof, ["gbt", "rf"]), fits, holdout)
    assert scored.count() == holdout.count() and error(scored) < 1.05 * baseline
    assert abs(sum(v for _, v in fits["rf"].importances()) - 1) < 1e-6


@pytest.fixture(scope="module")
def titles(planted):
    train, _ = planted
    named = train.withColumns({"title": F.concat(F.lit("m"), "movieId"), "genres": F.lit("g"), "year": F.lit(1990)})
    return KeyedTable.build(X.first_title_per_movie(named), "movieId")


def test_picks_against_brute_force(planted, titles):
    train, _ = planted
    factors = A.fit(train, rank=3)
    users = {r["userId"]: np.array(r["features"], float) for r in factors.users.df.collect()}
    items = {r["movieId"]: np.array(r["features"], float) for r in factors.items.df.collect()}
    seen = {(r[0], r[1]) for r in train.select("userId", "movieId").collect()}
    for exclude in (False, True):
        got = K.top_bottom(factors, [3, 9], titles, 4, train if exclude else None).collect()
        for u in (3, 9):
            scores = sorted(
                (round(float(users[u] @ v), 9), i) for i, v in items.items() if not exclude or (u, i) not in seen)
            for pick, expected in (
                ("bottom", [i for _, i in scores[:4]]),
                ("top", [i for _, i in sorted(scores, key=lambda s: (-s[0], s[1]))[:4]]),
            ):
                mine = sorted((r["rank"], r["movieId"]) for r in got if r["userId"] == u and r["pick"] == pick)
                assert [m for _, m in mine] == expected
    with pytest.raises(ValueError):
        K.top_bottom(factors, [12345], titles)


def test_batch_serves_every_user_in_any_blocks(planted, titles, monkeypatch):
    train, _ = planted
    factors = A.fit(train, rank=3)
    columns = ["userId", "pick", "rank", "movieId"]
    for seen in (None, train):
        whole = rows(K.recommend_all(factors, titles, 4, seen), *columns)
        assert len(whole) == 8 * factors.users.rows
        monkeypatch.setattr(K, "USER_BLOCK", 7)
        monkeypatch.setattr(K, "ITEM_BLOCK", 9)
        assert rows(K.recommend_all(factors, titles, 4, seen), *columns) == whole
        listed = K.top_bottom(factors, [3, 9, 777], titles, 4, seen)
        assert rows(listed, *columns) == [r for r in whole if r[0] in (3, 9)]
        monkeypatch.undo()


def test_a_pick_without_title_keeps_its_rank(spark, planted):
    train, _ = planted
    factors = A.fit(train, rank=2)
    bare = factors.items.df.select("movieId", "n", *[F.lit(None).cast(t).alias(c) for c, t in (("title", "string"), ("genres", "string"), ("year", "int"))])
    got = K.top_bottom(factors, [3], KeyedTable.build(bare, "movieId"), 4)
    assert got.count() == 8 and got.where("title is null").count() == 8


def test_effect_picks(planted, titles):
    train, _ = planted
    model = E.fit_movie_user(train)
    picks = K.effect_picks(model, titles, 3)
    assert picks.count() == 6 * model.tables["b_u"].rows
    best = model.tables["b_i"].df.orderBy(F.desc("b_i")).first()["movieId"]
    assert {r[0] for r in picks.where("pick = 'top' and rank = 1").select("movieId").collect()} == {best}


def test_cf_scores_every_hidden_row(skewed):
    from halfstar.operators import neighbours as N

    split = Z.known_unknown(skewed.drop("timestamp"))
    hidden = rows(split.where("part = 'unknown'"), "userId", "movieId")
    for scored in (N.popular(split), N.user_based(split, 5), N.item_based(split, 5)):
        assert rows(scored, "userId", "movieId") == hidden
        assert scored.where("pred is null").count() == 0


def test_fits_at_once_share_the_blocks():
    """Vectors go to every block, so a fit among several takes only its share of the cores."""
    assert A.block_count(40_000_000, 12) == 12
    assert A.block_count(12_000_000, 12, at_once=4) == 3
    assert A.block_count(12_000_000, 12, at_once=6) == 3
    assert A.block_count(10, 12) == 2
    assert A.block_count(100_000_000, 12, at_once=4) == 20
