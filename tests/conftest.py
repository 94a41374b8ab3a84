import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from clickloom import build_session  # noqa: E402
from clickloom.schema import RAW_SCHEMA  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions=4,
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="4g",
        spark_sql_warehouse_dir=str(warehouse),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log(spark):
    """Build a behaviour log from (user, item, category, behaviour, epoch seconds) rows."""
    from clickloom.operators.cleaning import with_datetime

    def build(rows):
        raw = spark.createDataFrame([tuple(row) for row in rows], RAW_SCHEMA)
        return with_datetime(raw)

    return build


@pytest.fixture
def folder():
    if not os.path.isdir(DATA):
        pytest.skip(f"no test data in {DATA}")
    return DATA


def rows_of(df, *columns):
    names = columns or df.columns
    return sorted(tuple(row[name] for name in names) for row in df.collect())
