import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from telewarden.session import Staging, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    Staging.drop_all()


def frame(spark, rows):
    """Readings (timestamp, sensor, value) numbered in the given order."""
    return spark.createDataFrame(
        [(ts, sensor, float(value), seq) for seq, (ts, sensor, value) in enumerate(rows)],
        "timestamp string, sensor_id string, value double, seq bigint",
    )
