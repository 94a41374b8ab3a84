"""Every registered query against its SQL on DuckDB, and the shape of the plans."""

import contextlib
import io
import subprocess
import sys

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, normal
from clickloom.catalog import QUERIES
from clickloom.oracle import ORACLE
from tests.conftest import DATA, ROOT

# These write tables or run streams while they are built; their plans are those of what they return.
EAGER = {name for name in QUERIES if name.startswith(("cf_", "stream_", "incremental_"))} | {"late_rows"}


@pytest.fixture(scope="module")
def duck(request):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    cursor = duck.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.collect(), df.columns) == normal(cursor.fetchall(), columns)


def test_entry_runs(spark, folder):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()


@pytest.mark.parametrize("missing", ["zstandard", "corpus_pipeline", "clickloom.llm"])
def test_entry_stands_without_the_text_part(missing):
    """A library or module that only text queries need is missing: all others are registered."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES))] * 2


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - EAGER))
def test_plans_have_no_pairwise_joins_and_no_python(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in text


def test_scans_read_only_needed_columns_and_push_filters(spark, folder):
    text = plan(QUERIES["top_buyers"](spark, folder))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text
    assert "PushedFilters: [In(event_type, [click,purchase,signup,view])]" in text
    assert "TakeOrderedAndProject" in text
    orders = plan(QUERIES["gmv_daily"](spark, folder))
    assert "EqualTo(o_orderstatus,F)" in orders


def test_distinct_users_cost_no_expansion(spark, folder):
    for name in ("funnel_wide", "daily_metrics", "overall_kpis", "kpi_delta", "tumbling_5m", "clean_report"):
        assert "Expand" not in plan(QUERIES[name](spark, folder))


def test_sliding_windows_spread_only_summed_rows(spark, folder):
    text = plan(QUERIES["sliding_30_1"](spark, folder))
    assert "Expand" not in text
    tree = text.split("\n\n")[0].splitlines()
    spread = max(i for i, line in enumerate(tree) if "Generate" in line)
    # below the spreading: combined per range, per user's pane in order, per (pane, user)
    assert sum("Exchange" in line for line in tree[spread:]) >= 3


def test_sliding_windows_scan_the_log_once(spark, folder):
    for name in ("sliding_15_5", "sliding_30_1"):
        tree = plan(QUERIES[name](spark, folder)).split("\n\n")[0]
        assert tree.count("Scan parquet") == 1


def test_tumbling_windows_have_no_generator(spark, folder):
    text = plan(QUERIES["tumbling_5m"](spark, folder))
    assert "Generate" not in text and "Expand" not in text


def test_folder_without_events_fails(spark, tmp_path):
    with pytest.raises(Exception):
        QUERIES["overall_kpis"](spark, str(tmp_path))
