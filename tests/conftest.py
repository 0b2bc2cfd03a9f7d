import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from halfstar.session import get_session

    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    picked = df.select(*order) if order else df
    return sorted(tuple(r) for r in picked.collect())


@pytest.fixture(scope="session")
def skewed(spark):
    """Ratings in which one user and one movie each hold a large share of all rows."""
    import random

    rnd = random.Random(7)
    cells = {}
    for i in range(1, 301):
        cells[(1, i)] = rnd.randint(1, 10) / 2
    for u in range(2, 302):
        cells[(u, 1)] = rnd.randint(1, 10) / 2
        if u % 3 == 0:
            cells[(u, rnd.randint(2, 300))] = rnd.randint(1, 10) / 2
            cells[(u, rnd.randint(2, 300))] = rnd.randint(1, 10) / 2
    data = [(u, i, r, 1_000_000_000 + 86_400 * ((u * 31 + i) % 200)) for (u, i), r in cells.items()]
    return spark.createDataFrame(data, "userId int, movieId int, rating double, timestamp long")
