import pytest
from conftest import rows

from halfstar.operators import explore as X


def test_top_n_keeps_ties(spark):
    counts = [(f"t{i:02d}", 100 - i) for i in range(19)] + [("x", 50), ("y", 50), ("z", 50), ("w", 1)]
    df = spark.createDataFrame(counts, "title string, count int")
    assert X.top_n_with_ties(df, 20).count() == 22


def test_single_rating_has_no_spread(spark):
    df = spark.createDataFrame([("A", 3.0), ("B", 2.0), ("B", 4.0)], "genres string, rating double")
    got = {r["genres"]: r for r in X.error_bars(df, "genres", 1).collect()}
    assert got["A"]["se"] is None and got["B"]["se"] == pytest.approx(1.0)


def test_cumulative_share_over_partitions(spark, skewed):
    counts = X.counts_by(skewed, "movieId", "movieId").repartition(5)
    got = X.cumulative_share(counts, "movieId", "count").orderBy("share", "movieId").collect()
    values = sorted((r["count"] for r in counts.collect()), reverse=True)
    run, whole, expected = 0.0, sum(v * v for v in values), []
    for v in values:
        run += v * v
        expected.append(run / whole)
    assert [r["share"] for r in got] == pytest.approx(expected)


def test_histogram_counts_every_key(spark, skewed):
    for log in (False, True):
        h = X.support_histogram(skewed, "userId", log=log).collect()
        assert sum(r["frequency"] for r in h) == 301
        assert max(r["bin"] for r in h) == 29


def test_histogram_of_equal_counts(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "userId int")
    assert [(r["bin"], r["frequency"]) for r in X.support_histogram(df, "userId").collect()] == [(0, 3)]


def test_trend_window(spark):
    df = spark.createDataFrame([(0, 1.0), (7, 3.0), (14, 5.0), (40, 9.0)], "week long, rating double")
    assert [r[2] for r in rows(X.smoothed(df, "week", "rating", 7))] == [2.0, 3.0, 4.0, 9.0]


def test_genres_split_and_filter(spark):
    df = spark.createDataFrame([("A|B",), ("A|B",), ("B",), (None,)], "genres string")
    assert {(r[0], r[1]) for r in X.top_genres(df).collect()} == {("A", 2), ("B", 3), (None, 1)}
    assert rows(X.filter_by_genre_support(df, 1)) == [("A|B",), ("A|B",)]


def test_quantile_is_interpolated(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 10)], "n int")
    assert X.exact_quantile(df, "n", 0.75) == pytest.approx(4.75)


def test_scan_is_pruned(spark, tmp_path, skewed):
    skewed.write.parquet(str(tmp_path / "r"))
    plan = X.counts_by(spark.read.parquet(str(tmp_path / "r")), "movieId", "movieId")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<movieId:int>" in text and text.count("Exchange") == 1
