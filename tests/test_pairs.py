import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from halfstar.operators import blocks as B
from halfstar.operators import matrix as M
from halfstar.operators import neighbours as N


def brute(skewed):
    dense = skewed.toPandas().pivot(index="userId", columns="movieId", values="rating")
    return dense


@pytest.mark.parametrize("block", [37, 5000])
def test_pair_sums_against_brute_force(spark, skewed, block):
    entries, _, columns = M.entries_of(skewed, "userId", "movieId", "rating")
    got = {
        (r["i"], r["j"]): (r["n"], r["xy"], r["sx"], r["sy"], r["xx"], r["yy"])
        for r in B.pair_sums(entries, columns, ["n", "xy", "sx", "sy", "xx", "yy"], block).collect()
    }
    dense = brute(skewed)
    x, m = dense.fillna(0).to_numpy(), dense.notna().to_numpy().astype(float)
    mats = (m.T @ m, x.T @ x, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x))
    ids = list(dense.columns)
    expected = {
        (ids[a], ids[b]): tuple(q[a, b] for q in mats)
        for a, b in itertools.combinations(range(len(ids)), 2) if mats[0][a, b]
    }
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in expected)


@pytest.mark.parametrize("outer", [0, 1 << 40])
@pytest.mark.parametrize("same", [True, False])
def test_kernel_long_and_short_rows(monkeypatch, outer, same):
    monkeypatch.setattr(B, "OUTER_PAIRS", outer)
    rng = np.random.default_rng(1)
    left, right = rng.random((9, 20)) * (rng.random((9, 20)) < 0.6), rng.random((9, 20)) * (rng.random((9, 20)) < 0.6)
    cells = [(r, 0, c, left[r, c]) for r, c in zip(*np.nonzero(left))]
    if not same:
        cells += [(r, 1, c, right[r, c]) for r, c in zip(*np.nonzero(right))]
    cells.sort()
    row, side, loc, x = (np.array(v) for v in zip(*cells))
    batch = pa.RecordBatch.from_pydict(
        {"row": row, "loc": loc, "side": side, "id": loc + 100 * side, "x": x})
    kernel = B._pair_kernel(["xy"], 20, True, None)
    out = kernel((pa.scalar(0), pa.scalar(0 if same else 1)), (batch.slice(i, 7) for i in range(0, len(row), 7)))
    got = {}
    for b in out:
        got.update({(i, j): v for i, j, v in zip(*(b.column(k).to_pylist() for k in ("i", "j", "xy")))})
    full = left.T @ (left if same else right)
    share = (left > 0).T.astype(int) @ ((left if same else right) > 0).astype(int)
    expected = {
        (i, j if same else j + 100): full[i, j]
        for i in range(20) for j in range(20) if share[i, j] and (not same or i < j)
    }
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k]) for k in got)


def test_chunks_never_split_a_row():
    row = np.sort(np.random.default_rng(0).integers(0, 50, 500_000))
    batch = pa.RecordBatch.from_pydict({"row": row})
    seen = [set(c["row"]) for c in B.whole_rows((batch.slice(i, 9_999) for i in range(0, 500_000, 9_999)), ["row"])]
    assert len(seen) > 1 and sum(map(len, seen)) == 50


def test_kept_pairs_hold_the_best(spark, skewed):
    centred = N.center(skewed).drop("rating").withColumnRenamed("centred", "rating")
    entries, _, columns = M.entries_of(centred, "userId", "movieId", "rating", unit=True)
    whole, cut = (
        N.nearest(N.both_ways(B.pair_sums(entries, columns, ["xy"], 60, keep).withColumnRenamed("xy", "sim")), 3)
        for keep in (None, 3)
    )
    assert rows(whole) == rows(cut) and whole.count() > 0
    assert B._best(np.array([[3.0, 1.0, 3.0, 0.0]]), np.array([[True, True, True, False]]), 1).tolist() == [[True, False, True, False]]


def test_cosine_small(spark):
    data = [(1, 1, 3.0), (1, 2, 4.0), (2, 1, 3.0), (2, 2, 4.0), (3, 3, 5.0), (4, 2, 2.0), (4, 3, 2.0)]
    df = spark.createDataFrame(data, "userId int, movieId int, rating double")
    full = {(r["i"], r["j"]): r["sim"] for r in M.user_cosine(df).collect()}
    assert full[(1, 2)] == pytest.approx(1.0) and (1, 3) not in full
    assert full[(1, 4)] == pytest.approx(8 / (5 * math.sqrt(8)))
    part = {(r["i"], r["j"]): r["sim"] for r in M.user_cosine(df, norm="corated").collect()}
    assert part[(1, 4)] == pytest.approx(1.0)
    assert {r["j"] for r in M.user_cosine(df, first=2).collect()} == {2}


def test_slope_one_by_hand(spark):
    data = [(1, 1, 5.0), (1, 2, 3.0), (1, 3, 2.0), (2, 1, 3.0), (2, 2, 4.0), (3, 2, 2.0), (3, 3, 5.0)]
    df = spark.createDataFrame(data, "userId int, movieId int, rating double")
    dev = {(r["i"], r["j"]): (r["cnt"], r["dev"]) for r in N.slope_one_model(df).collect()}
    assert dev == {(1, 2): (2, 0.5), (1, 3): (1, 3.0), (2, 3): (2, -1.0)}
    got = N.slope_one(df, spark.createDataFrame([(3, 1, 4.0), (9, 9, 1.0)], "userId int, movieId int, rating double"))
    pred = {r["userId"]: r["pred"] for r in got.collect()}
    means = {1: 10 / 3, 2: 3.5, 3: 3.5}
    c = {(u, i): r - means[u] for u, i, r in data}
    d12 = ((c[1, 1] - c[1, 2]) + (c[2, 1] - c[2, 2])) / 2
    d13 = c[1, 1] - c[1, 3]
    assert pred[3] == pytest.approx(3.5 + (2 * (d12 + c[3, 2]) + (d13 + c[3, 3])) / 3)
    assert pred[9] is None


@pytest.mark.parametrize("block", [41, 4000])
def test_block_score_against_brute_force(spark, skewed, block, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", block)
    rng = np.random.default_rng(3)
    w, v = rng.random((300, 300)), rng.random((300, 300))
    cells = spark.createDataFrame(
        [(p + 1, q + 1, float(w[p, q]), float(v[p, q])) for p in range(300) for q in range(300)],
        "p int, q int, w double, v double")
    known = skewed.select(F.col("userId").alias("row"), F.col("movieId").alias("idx"), F.col("rating").alias("x"))
    targets = spark.createDataFrame([(1, 5, 5), (1, 299, 299), (4, 7, 7), (30, 1, 1)], "row int, id int, idx int")
    got = {(r["row"], r["id"]): (r["num"], r["den"]) for r in B.block_score(cells, known, targets, 300, block).collect()}
    mine = skewed.toPandas()
    for u, i in ((1, 5), (1, 299), (4, 7), (30, 1)):
        has = mine[mine.userId == u]
        q = has.movieId.to_numpy() - 1
        expected = ((v[i - 1, q] + w[i - 1, q] * has.rating.to_numpy()).sum(), w[i - 1, q].sum())
        assert got[(u, i)] == pytest.approx(expected)


def test_svd_rebuilds_the_matrix(spark):
    rng = np.random.default_rng(2)
    a = np.round(rng.random((12, 2)) @ rng.random((2, 9)) * 5 + 0.5, 1)
    df = spark.createDataFrame(
        [(int(u) + 1, int(i) + 1, float(a[u, i])) for u in range(12) for i in range(9)], "u int, i int, x double")
    errors = []
    for k in (1, 3):
        result = M.svd(df, k)
        u = np.zeros((12, k))
        for r in result.U.rows.collect():
            u[r.index] = r.vector.toArray()
        errors.append(np.abs(u @ np.diag(result.s.toArray()) @ result.V.toArray().T - a).max())
    assert errors[1] < errors[0]
    energy = M.energy_table(spark, [3.0, 2.0, 1.0])
    assert M.choose_k(energy, 0.95) == 2


def test_relevant_ratings_uses_unfiltered_limits(spark, skewed):
    kept = M.relevant_ratings(skewed, 0.5, 0.5).toPandas()
    pdf = skewed.toPandas()
    users, movies = pdf.userId.value_counts(), pdf.movieId.value_counts()
    limits = [round(users.quantile(0.5)), round(movies.quantile(0.5))]
    expected = pdf[pdf.userId.map(users).gt(limits[0]) & pdf.movieId.map(movies).gt(limits[1])]
    assert len(kept) == len(expected) > 0


def test_matrix_sums_repeated_cells(spark):
    df = spark.createDataFrame([(7, 3, 1.0), (7, 3, 2.0), (9, 1, 4.0)], "userId int, movieId int, rating double")
    matrix = M.rating_matrix(df)
    assert rows(matrix) == [(1, 2, 3.0), (2, 1, 4.0)]
    assert rows(M.dense_corner(matrix, 2, 2).fillna(0)) == [(1, 0.0, 3.0), (2, 4.0, 0.0)]


def test_top_pairs_survive_cutting_into_segments(spark, monkeypatch):
    """Sums of segments are pruned only once they are whole."""
    rng = np.random.default_rng(9)
    data = [(r, c + 100, c + 1, float(rng.normal())) for r in range(60) for c in range(40) if rng.random() < 0.7]
    entries = spark.createDataFrame(data, "row int, id int, idx int, x double")
    best = {}
    for limit in (B.SEGMENT_ENTRIES, 50):
        monkeypatch.setattr(B, "SEGMENT_ENTRIES", limit)
        pairs = [tuple(r) for r in B.pair_sums(entries, 40, ["xy"], block=16, keep=1).collect()]
        both = [(i, j, s) for i, j, s in pairs] + [(j, i, s) for i, j, s in pairs]
        best[limit] = {i: max((round(s, 6), -j) for k, j, s in both if k == i) for i in range(100, 140)}
    assert best[50] == best[B.SEGMENT_ENTRIES] and len(set(map(str, best.values()))) == 1


@pytest.mark.parametrize("short", [0, 6, 512])
def test_short_and_long_rows_add_up(spark, monkeypatch, short):
    monkeypatch.setattr(B, "SHORT_ROW", short)
    monkeypatch.setattr(B, "RANGE_PAIRS", 20)
    cells = [(r, 10 * c, c, float(1 + (r * c) % 5)) for r in range(1, 30) for c in range(1, 41) if (r * 7 + c * c) % (2 + r) < 3]
    entries = spark.createDataFrame(cells, "row int, id int, idx int, x double")
    got = {(r["i"], r["j"]): (r["n"], r["xy"]) for r in B.pair_sums(entries, 40, ["n", "xy"], 16).collect()}
    other = {(r["i"], r["j"]): r["xy"] for r in B.cross_sums(
        entries.where("id <= 200"), 20, entries.where("id > 200").withColumn("idx", F.col("idx") - 20), 20, ["xy"], 8).collect()}
    pairs = {}
    for a, b in itertools.product(cells, cells):
        if a[0] == b[0] and a[1] < b[1]:
            n, xy = pairs.get((a[1], b[1]), (0, 0.0))
            pairs[a[1], b[1]] = (n + 1, xy + a[3] * b[3])
    assert got.keys() == pairs.keys() and all(got[k] == pytest.approx(v) for k, v in pairs.items())
    crossed = {k: v[1] for k, v in pairs.items() if k[0] <= 200 < k[1]}
    assert other.keys() == crossed.keys() and all(other[k] == pytest.approx(v) for k, v in crossed.items())


def test_rows_go_only_where_their_columns_are(spark, monkeypatch):
    """Entries sent to block groups grow with the rows, not with the number of blocks."""
    sent = []
    real = B._sent
    monkeypatch.setattr(B, "_sent", lambda bounds, square: sent.append(bounds) or real(bounds, square))
    monkeypatch.setattr(B, "_each_block", lambda blocks: pytest.fail("a row was sent to every block"))
    cells = [(r, c, c, 1.0) for r in range(50) for c in range(8 * r + 1, 8 * r + 9)]
    entries = spark.createDataFrame(cells, "row int, id int, idx int, x double")
    assert B.pair_sums(entries, 400, ["n"], 8).count() == 50 * 28
    assert len(sent) == 1
