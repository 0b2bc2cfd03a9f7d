import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from halfstar import functions as H
from halfstar import sources as S


def epoch(*parts):
    return int(datetime.datetime(*parts, tzinfo=datetime.timezone.utc).timestamp())


def test_titles(spark):
    data = [
        (1, "Plain"), (2, "One (1999)"), (3, "Two (1984) (2001)"),
        (4, "Mid (1977) Story"), (5, None), (6, "Short (199)"),
    ]
    got = rows(H.title_parts(spark.createDataFrame(data, "id int, title string")))
    assert got == [
        (1, "Plain", None), (2, "One", 1999), (3, "Two (2001)", 1984),
        (4, "Mid Story", 1977), (5, None, None), (6, "Short (199)", None),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_week_rounds_to_nearest_sunday(spark, zone):
    sunday = epoch(2024, 1, 7)
    cases = {
        sunday: sunday,
        epoch(2024, 1, 10, 11, 59, 59): sunday,
        epoch(2024, 1, 10, 12): sunday + 7 * 86400,
        epoch(2024, 1, 13, 23, 59, 59): sunday + 7 * 86400,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in cases], "ts long")
        assert dict(rows(df.select("ts", H.week_start(F.col("ts"))))) == cases
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_half_even_and_stars(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (4.0,)], "x double")
    got = rows(df.select(H.round_half_even(F.col("x"), 0), H.star_class(F.col("x"))))
    assert got == [(2.0, "Half Star"), (4.0, "Half Star"), (4.0, "Whole Star")]


def test_bad_lines(spark):
    lines = ["1::2::3.5::99", "1::2", "x::2::3::4", "1::2::bad::5::extra"]
    df = S.parse_rating_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [tuple(r) for r in df.collect()]
    assert got == [(1, 2, 3.5, 99), (1, 2, None, None), (None, 2, 3.0, 4), (1, 2, None, 5)]


def test_movie_lines_keep_quotes(spark):
    df = spark.createDataFrame([('7::"Quoted", (1990)::A|B',)], "value string")
    assert rows(S.parse_movie_lines(df)) == [(7, '"Quoted", (1990)', "A|B")]


def test_training_log(spark):
    text = ["iter      tr_rmse          obj", "   0       0.9800   1.0e+06", "   1       0.91   9e+05"]
    df = S.parse_training_log(spark.createDataFrame([(x,) for x in text], "value string"))
    assert rows(df) == [(0, 0.98, 1.0e6), (1, 0.91, 9.0e5)]


def test_prepare_ids_drops_missing(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "userId int, movieId int")
    assert rows(S.prepare_ids(df), "user", "item") == [(1, 2)]


def test_file_ingest_resumes(spark, tmp_path):
    from halfstar.streaming import ingest_files

    source = tmp_path / "in"
    source.mkdir()
    for k in range(5):
        (source / f"{k}.dat").write_text(f"{k}::1::2.5::10\nbad::1::2.5::10\n")
    args = (spark, str(source), str(tmp_path / "out"), str(tmp_path / "log"), 2)
    assert ingest_files(*args).count() == 5
    (source / "late.dat").write_text("9::1::4.0::11\n")
    assert rows(ingest_files(*args), "user") == [(0,), (1,), (2,), (3,), (4,), (9,)]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    from halfstar.session import scratch_dir

    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: None),
        sparkContext=SimpleNamespace(master="spark://host:7077"),
    )
    with pytest.raises(ValueError):
        scratch_dir(cluster)


def test_many_order_lines_are_grouped_by_more_tasks(spark, monkeypatch):
    """Rows per grouping task are bounded by the code, whatever the session's partitions; the ratings stay the same."""
    from conftest import TESTDATA, rows

    from halfstar.sources import tables

    few = rows(tables.ratings_from_tables(spark, TESTDATA))
    monkeypatch.setattr(tables, "LINES_PER_TASK", 500)
    many = tables.ratings_from_tables(spark, TESTDATA)
    assert many.rdd.getNumPartitions() >= 10
    assert rows(many) == few
