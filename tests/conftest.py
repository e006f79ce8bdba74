import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from edgeflow import get_session  # noqa: E402

MICRO_EDGES = [
    (1, 2), (1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (2, 4), (4, 2), (6, 6), (5, 9),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("checkpoints"))
    session = get_session(
        "edgeflow-tests", "local[8]", spark__sql__shuffle__partitions=4,
        spark__checkpoint__dir=shared, spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def edges_from(spark):
    return lambda pairs: spark.createDataFrame(pairs, "src bigint, dst bigint")


@pytest.fixture(scope="session")
def micro(edges_from):
    return edges_from(MICRO_EDGES)


@pytest.fixture(scope="session")
def micro_nodes(spark):
    return spark.createDataFrame([(i,) for i in range(1, 9)], "id bigint")


def sf(scale):
    return f"/root/testdata/sf{scale}"
