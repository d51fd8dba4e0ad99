import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", 4)
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """Build a series table from {(metric, geo): {pidx: value}}."""

    def build(data, cadence="monthly", level="municipality"):
        rows = [(m, g, level, cadence, p, v) for (m, g), points in data.items() for p, v in points.items()]
        schema = "metric_id string, geo_id string, geo_level string, cadence string, pidx int, value double"
        return spark.createDataFrame(rows, schema)

    return build
