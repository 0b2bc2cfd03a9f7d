"""Blocked gradient descent against a plain loop, planted signals and hot keys."""

import math
import random

import numpy as np
import pytest
from conftest import rows

from halfstar.operators import descent as D

SCHEMA = "userId int, movieId int, rating double"


def planted(n_users=120, n_items=80, rank=2, share=0.4, seed=3):
    rng = np.random.default_rng(seed)
    p, q = rng.normal(size=(n_users, rank)), rng.normal(size=(n_items, rank))
    bu, bi = rng.normal(size=n_users) * 0.4, rng.normal(size=n_items) * 0.4
    return [
        (u, i, float(3 + bu[u] + bi[i] + 0.7 * p[u] @ q[i])) for u in range(n_users) for i in range(n_items) if rng.random() < share
    ]


def twin(trained, data, p, epochs, hashes):
    """The same visits in one process: cells in rounds, dictionaries of rows, a loop over ratings."""
    state = {}

    def row(kind, key):
        if (kind, key) not in state:
            vector = D.first_vectors(np.array([key]), p.rank, p.seed + (kind == "i"))[0]
            state[kind, key] = [vector.copy(), 0.0, 1.0]
        return state[kind, key]

    cells = {}
    for u, i, r in data:
        cells.setdefault((hashes["u", u], hashes["i", i]), []).append((hashes[u, i], u, i, r))
    curve = []
    for _ in range(epochs):
        sse = 0.0
        for s in range(trained.blocks):
            for b in range(trained.blocks):
                visits = sorted(cells.get((b, (b + s) % trained.blocks), []))
                for at in range(0, len(visits), D.BATCH):
                    sums = {}
                    for _, u, i, r in visits[at : at + D.BATCH]:
                        (pu, bu, _), (qi, bi, _) = row("u", u), row("i", i)
                        e = r - (trained.mean + bu + bi + float(pu @ qi))
                        sse += e * e
                        for key, own, other, bias in ((("u", u), pu, qi, bu), (("i", i), qi, pu, bi)):
                            g = np.append(e * other - p.reg * own, e - p.reg * bias)
                            total = sums.setdefault(key, [np.zeros(p.rank + 1), 0.0])
                            total[0] += g
                            total[1] += float((g * g).mean())
                    for key, (g, squares) in sums.items():
                        mine = state[key]
                        mine[2] += squares
                        mine[0] = mine[0] + p.rate / math.sqrt(mine[2]) * g[:-1]
                        mine[1] += p.rate / math.sqrt(mine[2]) * g[-1]
        curve.append(math.sqrt(sse / len(data)))
    return state, curve


def test_epochs_equal_a_plain_loop(spark):
    data = planted(30, 20)
    p = D.Params(rank=3, rate=0.2, reg=0.05)
    done = D.fit(spark.createDataFrame(data, SCHEMA).repartition(3), p, epochs=3, rows_per_cell=70)
    assert done.blocks == 2 and not done.codings["u"].hot
    pairs = spark.createDataFrame([(u, i) for u, i, _ in data], "u long, i long")
    hashes = {(r.u, r.i): r.h for r in pairs.selectExpr("u", "i", "xxhash64(u, i) h").collect()}
    for side, n in (("u", 30), ("i", 20)):
        found = spark.range(n).selectExpr("id", f"pmod(xxhash64(id), {done.blocks}) b").collect()
        hashes |= {(side, r.id): r.b for r in found}
    state, curve = twin(done, data, p, 3, hashes)
    assert [c[2] for c in done.curve] == pytest.approx(curve, rel=1e-9)
    for kind, table in zip("ui", done.tables()):
        for r in table.df.collect():
            assert r.features == pytest.approx(state[kind, r[0]][0].tolist(), rel=1e-7, abs=1e-9)
            assert r.bias == pytest.approx(state[kind, r[0]][1], rel=1e-7, abs=1e-9)


def test_planted_factors_are_found_and_the_curve_falls(spark):
    data = planted()
    rnd = random.Random(1)
    rnd.shuffle(data)
    train, held = (spark.createDataFrame(part, SCHEMA) for part in (data[300:], data[:300]))
    done = D.fit(train, D.Params(rank=4, rate=0.2, reg=0.01), epochs=25)
    curve = done.curve_table().orderBy("iter").collect()
    assert [r.iter for r in curve] == list(range(1, 26))
    assert curve[-1].tr_rmse < 0.35 * curve[0].tr_rmse and curve[-1].obj < curve[0].obj
    spread = np.std([r for _, _, r in data])
    error = math.sqrt(np.mean([(r.rating - r.pred) ** 2 for r in done.score(held).collect()]))
    assert error < 0.5 * spread
    # going on from a state is the same as having gone further at once
    more = D.fit(train, D.Params(rank=4, rate=0.2, reg=0.01), epochs=10).run(15)
    assert [c[2] for c in more.curve] == pytest.approx([c[2] for c in done.curve], rel=1e-6)


def test_hot_keys_are_split_and_averaged(spark):
    rng = np.random.default_rng(5)
    data = [(u, 0, 4.5 if u % 2 else 4.0) for u in range(600)] + [(u, int(rng.integers(1, 60)), 2.0 + u % 2 / 2) for u in range(600)]
    done = D.fit(spark.createDataFrame(data, SCHEMA), D.Params(rank=2, rate=0.3, reg=0.01), epochs=12, rows_per_cell=50)
    hot = done.codings["i"].hot
    assert set(hot) == {0} and hot[0][1] > 1 and done.blocks > 3
    users, items = done.tables()
    assert items.rows == len({i for _, i, _ in data}) and users.rows == 600
    assert sorted(r[0] for r in items.df.select("movieId").collect()) == sorted({i for _, i, _ in data})
    scored = done.score(spark.createDataFrame(data, SCHEMA)).collect()
    assert math.sqrt(np.mean([(r.rating - r.pred) ** 2 for r in scored])) < 0.3


def test_bounded_scores_stay_inside(spark):
    data = [(u, i, 5.0 if (u + i) % 2 else 0.5) for u in range(40) for i in range(30)]
    df = spark.createDataFrame(data, SCHEMA)
    done = D.fit(df, D.Params(rank=3, rate=0.3, reg=0.001, bounds=(0.5, 5.0)), epochs=20)
    pred = [r.pred for r in done.score(df).collect()]
    assert 0.5 <= min(pred) < 1.2 and 4.3 < max(pred) <= 5.0
    unseen = spark.createDataFrame([(1, 999, 3.0), (999, 1, 3.0), (1, 1, 3.0)], SCHEMA)
    assert rows(done.score(unseen).selectExpr("pred is null as n")) == [(False,), (True,), (True,)]


def test_grid_trains_all_models_in_the_same_jobs(spark):
    df = spark.createDataFrame(planted(60, 40), SCHEMA)
    best, table = D.grid_search(df, [1, 4], [0.02, 0.2], epochs=8, folds=3, reg=0.01)
    found = {(r["rank"], r.rate): r for r in table.collect()}
    assert len(found) == 4 and sum(r.is_best for r in found.values()) == 1
    assert (best.rank, best.rate) == min(found, key=lambda k: found[k].rmse)
    # one point, fitted by itself without a fold, scores that fold alike
    fold = D.fold_of(3)
    parts = df.withColumn("fold", fold)
    alone = []
    for f in range(3):
        one = D.fit(parts.where(parts.fold != f), best, epochs=8)
        got = one.score(parts.where(parts.fold == f)).dropna().collect()
        alone.append(math.sqrt(np.mean([(r.rating - r.pred) ** 2 for r in got])))
    assert found[best.rank, best.rate].rmse == pytest.approx(np.mean(alone), rel=0.1)


def test_empty_input(spark):
    done = D.fit(spark.createDataFrame([], SCHEMA), D.Params(rank=2), epochs=2)
    assert done.curve == [] and done.score(spark.createDataFrame([(1, 1, 3.0)], SCHEMA)).first().pred is None


def test_cells_have_tasks_of_their_own(spark):
    from pyspark.sql import functions as F

    done = D.prepare(spark.createDataFrame(planted(60, 40), SCHEMA), [D.Params(rank=2)], rows_per_cell=15)
    assert done.blocks >= 8
    after = D._round(done.state, done.cells, 0, done.models, done.mean, done.blocks, done.groups, {}, True)
    places = after.where("kind = 'u'").select("block", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in places}) == len({r.block for r in places}) == done.blocks


def test_several_epochs_in_one_job_equal_single_ones(spark):
    data = spark.createDataFrame(planted(30, 20), SCHEMA)
    models = [D.Params(rank=2, fold=f, rate=r) for r in (0.1, 0.2) for f in (0, 1)]
    one, many = (D.prepare(data, models, folds=2, rows_per_cell=70) for _ in range(2))
    for _ in range(6):
        one.epoch()
    written = []
    materialise = D.materialise
    D.materialise = lambda df, label: written.append(label) or materialise(df, label)
    try:
        many.run(6)
    finally:
        D.materialise = materialise
    assert many.blocks == 2 and len(written) < 6
    assert [c[:2] for c in many.curve] == [c[:2] for c in one.curve]
    for a, b in zip(many.curve, one.curve):
        assert a[2:] == pytest.approx(b[2:], rel=1e-12)
    for a, b in zip(many.held_out(), one.held_out()):
        assert a == pytest.approx(b, rel=1e-12)
