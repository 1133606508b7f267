import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from feldspark.session import clear_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture()
def counting(spark):
    """i, i, 2i, 3i, 4i, i mod 2 for i = 0..99."""
    return spark.range(100).selectExpr(
        "id", "double(id) AS feature_1_norm", "double(2 * id) AS feature_2_norm",
        "double(3 * id) AS feature_3", "double(4 * id) AS feature_4", "id % 2 AS target",
    )
