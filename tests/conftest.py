import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meltemi.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "meltemi-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """frame(ddl, rows) -> DataFrame"""

    def make(ddl, rows):
        return spark.createDataFrame(rows, ddl)

    return make


def rows_of(df, *columns):
    """Sorted tuples of a frame, nulls first."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
