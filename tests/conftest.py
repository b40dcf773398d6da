import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from marketloom.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def prices(spark):
    """A frame (id, price_min, category) from plain lists."""

    def build(values, categories=None):
        categories = categories or ["all"] * len(values)
        rows = [(i, None if v is None else float(v), c) for i, (v, c) in enumerate(zip(values, categories))]
        return spark.createDataFrame(rows, "id long, price_min double, category string")

    return build
