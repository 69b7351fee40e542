import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from stargauge.session import build_session  # noqa: E402
from support import PROCESSED_SCHEMA, random_processed  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "stargauge-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Fixture rows that asserted numbers belong to.
RATINGS = [
    (1, 1, 4.0, 964982703),
    (1, 2, 3.5, 964982931),
    (2, 2, 5.0, 964983194),
    (2, 4, 2.0, 964983445),
    (3, 1, 4.5, 964983674),
]
MOVIES = [
    (1, "Toy Story (1995)", "Adventure|Animation|Children|Comedy|Fantasy"),
    (2, "Jumanji (1995)", "Adventure|Children|Fantasy"),
    (3, "No Genre Movie (1995)", "(no genres listed)"),
    (4, "Deadpool (2016)", "Action|Comedy"),
    (5, "Matrix, The (1999)", "Action|Sci-Fi"),
]
PROCESSED = [
    (0, 1, 1, 4.0, 964982703, "Action|Adventure"),
    (1, 1, 2, 5.0, 964982704, "Comedy|Drama"),
    (2, 2, 1, 3.0, 964982705, "Action"),
    (3, 2, 3, 4.5, 964982706, "Action"),
    (4, 3, 2, 2.5, 964982707, "Comedy|Drama"),
    (5, 3, 4, 3.5, 964982708, "Action|Adventure"),
]


@pytest.fixture(scope="session")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "userId long, movieId long, rating double, timestamp long")


@pytest.fixture(scope="session")
def movies(spark):
    return spark.createDataFrame(MOVIES, "movieId long, title string, genres string")


@pytest.fixture(scope="session")
def processed(spark):
    return spark.createDataFrame(PROCESSED, PROCESSED_SCHEMA)


@pytest.fixture(scope="session")
def random_rows(spark):
    return random_processed(spark)
