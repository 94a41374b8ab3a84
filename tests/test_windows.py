from collections import Counter, defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickloom.operators import windows
from tests.conftest import rows_of

EPOCH = datetime(1970, 1, 1)


def sliding_by_hand(rows, size, slide):
    """From the events' side: each event names the windows that hold it."""
    size, slide = size * 60, slide * 60
    held = defaultdict(list)
    for row in rows:
        newest = row[4] // slide * slide
        for start in range(newest, newest - size, -slide):
            held[start].append(row)
    first = min(row[4] for row in rows) // slide * slide
    out = []
    for start in range(first, max(row[4] for row in rows) + 1, slide):
        kinds = Counter(row[3] for row in held[start])
        users = {row[0] for row in held[start]} - {None}
        out.append((EPOCH + timedelta(seconds=start), kinds["pv"], len(users), kinds["cart"], kinds["buy"], len(held[start])))
    return out


event = st.tuples(
    st.one_of(st.none(), st.integers(1, 4)),
    st.integers(1, 3),
    st.just(1),
    st.sampled_from(["pv", "fav", "cart", "buy"]),
    st.integers(0, 3 * 3600),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(event, min_size=1, max_size=60), shape=st.sampled_from([(15, 5), (30, 1), (10, 10)]))
def test_sliding_equals_counting_by_hand(spark, log, rows, shape):
    found = windows.sliding_windows(log(rows), *shape)
    assert rows_of(found, "window_start", "pv", "uv", "cart", "buy", "events") == sliding_by_hand(rows, *shape)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(event, min_size=1, max_size=60))
def test_tumbling_windows_partition_the_rows(spark, log, rows):
    found = windows.tumbling_windows(log(rows)).collect()
    assert sum(row["events"] for row in found) == len(rows)
    assert sum(row["pv"] for row in found) == sum(r[3] == "pv" for r in rows)
    assert len({row["window_start"] for row in found}) == len(found)
    users = windows.user_windows(log(rows)).collect()
    assert sum(row["events"] for row in users) == len(rows)


def test_boundary_event_opens_the_next_window(log):
    found = windows.tumbling_windows(log([(1, 1, 1, "pv", 299), (1, 1, 1, "pv", 300)]))
    assert rows_of(found, "window", "pv") == [("00:00~00:05", 1), ("00:05~00:10", 1)]


def test_stray_early_event_builds_a_long_spine_in_days(log):
    df = log([(1, 1, 1, "pv", 0), (1, 1, 1, "pv", 86400 * 40)])
    found = windows.sliding_windows(df, 15, 5)
    assert found.count() == 40 * 288 + 1 and found.where("events > 0").count() == 4  # one slide of the first event, three of the last


def test_peak_takes_the_earlier_window(log):
    rows = [(1, 1, 1, "pv", 0), (1, 1, 1, "pv", 600), (1, 1, 1, "buy", 900), (2, 1, 1, "buy", 901)]
    found = windows.peak_windows(windows.tumbling_windows(log(rows)))
    assert rows_of(found, "kind", "window") == [("busiest_buy", "00:15~00:20"), ("peak_pv", "00:00~00:05")]


def test_empty_log_has_no_windows(log):
    assert windows.tumbling_windows(log([])).collect() == []
    assert windows.sliding_windows(log([])).collect() == []
    assert windows.peak_windows(windows.tumbling_windows(log([]))).collect() == []


def test_span_in_minutes(log):
    assert windows.time_span(log([(1, 1, 1, "pv", 0), (1, 1, 1, "pv", 90)])).first()["span_minutes"] == 1.5
