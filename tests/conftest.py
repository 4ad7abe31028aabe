import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridstats.schemas import TABLES  # noqa: E402
from gridstats.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "gridstats-tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def table(spark):
    """Build a star table from dicts; absent columns are null."""

    def build(name, *rows):
        fields = [f.name for f in TABLES[name]]
        return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], TABLES[name])

    return build
