import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from civicpanel.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": "/tmp/civicpanel-warehouse",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULLs last."""
    found = df.select(*columns) if columns else df
    return sorted(map(tuple, found.collect()), key=lambda r: [(v is None, str(type(v)) if v is None else v) for v in r])
