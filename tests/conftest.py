import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from schoolzones.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4, "tests", **{"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}
    )
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate an expression over one column of values."""

    def run(values, make, type_="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
        rows = df.select("i", make("v").alias("out")).collect()
        return [r["out"] for r in sorted(rows, key=lambda r: r["i"])]

    return run
