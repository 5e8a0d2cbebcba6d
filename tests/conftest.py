import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridpulse.session import get_session  # noqa: E402
from helpers import POINTS, READINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    def build(*rows):
        """Rows of (time, point, value[, quality[, reading type]]) as double values."""
        full = [
            (t, p, (rest[1] if len(rest) > 1 else "raw"), None, v, None, (rest[0] if rest else "online"))
            for t, p, v, *rest in rows
        ]
        return spark.createDataFrame(full, READINGS)

    return build


@pytest.fixture
def points(spark):
    def build(*rows):
        """Rows of (point[, uom, rollup_uom[, site]])."""
        full = [
            (p, rest[2] if len(rest) > 2 else "s", p, "float64", rest[0] if rest else "kW", rest[1] if len(rest) > 1 else "kWh")
            for p, *rest in rows
        ]
        return spark.createDataFrame(full, POINTS)

    return build
