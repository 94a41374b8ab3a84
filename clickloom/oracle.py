"""The registered queries as SQL over the given tables, written independently of the Spark code.

Rounding is exact half-up on whole numbers, sums are bigint, ties are settled by id."""

from __future__ import annotations

from clickloom.schema import BEHAVIOR_NAMES, BEHAVIOR_WEIGHTS, BEHAVIORS, RECENCY_EDGES, UNKNOWN_BEHAVIOR, VOLUME_EDGES
from clickloom.sources.adapters import EVENT_BEHAVIORS


def _case(key: str, pairs, otherwise: str, comparison: str = "=") -> str:
    """CASE over a constant table; text is quoted, numbers are not."""

    def literal(value):
        return f"'{value}'" if isinstance(value, str) else str(value)

    branches = " ".join(f"WHEN {key} {comparison} {literal(a)} THEN {literal(b)}" for a, b in pairs)
    return f"CASE {branches} ELSE {otherwise} END"


_LEGAL = "behavior_type IN (" + ", ".join(f"'{kind}'" for kind in BEHAVIORS) + ")"
_EVENTS = f"""
e_all AS (
  SELECT event_id, user_id, item_id, item_id % 20 AS category_id, behavior_type, timestamp, datetime FROM (
    SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
      {_case('event_type', EVENT_BEHAVIORS.items(), 'event_type')} AS behavior_type,
      CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, date_trunc('second', ts) AS datetime
    FROM events) x),
e AS (SELECT * FROM e_all WHERE {_LEGAL})"""

_ODS = f"""{_EVENTS},
ods AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(item_id AS VARCHAR) END AS item_id,
    CAST(category_id AS VARCHAR) AS category_id, behavior_type, CAST(timestamp AS VARCHAR) AS timestamp
  FROM (SELECT * FROM e_all UNION ALL SELECT * FROM e_all WHERE event_id % 50 = 0) x)"""

_FILLED = " AND ".join(f"length({name}) > 0" for name in ("user_id", "item_id", "category_id", "timestamp"))
_DWD = f"""{_ODS},
distinct_text AS (SELECT DISTINCT * FROM ods WHERE {_LEGAL} AND {_FILLED}),
dwd AS (
  SELECT CAST(user_id AS BIGINT) AS user_id, CAST(item_id AS BIGINT) AS item_id, CAST(category_id AS BIGINT) AS category_id,
    behavior_type, {_case('behavior_type', BEHAVIOR_NAMES.items(), f"'{UNKNOWN_BEHAVIOR}'")} AS behavior_name,
    strftime(epoch_ms(CAST(timestamp AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S') AS datetime,
    strftime(epoch_ms(CAST(timestamp AS BIGINT) * 1000), '%Y-%m-%d') AS dt
  FROM distinct_text)"""

_RAW = f"""{_ODS},
raw AS (
  SELECT TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(item_id AS BIGINT) AS item_id,
    TRY_CAST(category_id AS BIGINT) AS category_id, behavior_type, TRY_CAST(timestamp AS BIGINT) AS timestamp
  FROM ods),
n1 AS (SELECT * FROM raw WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND category_id IS NOT NULL
  AND behavior_type IS NOT NULL AND timestamp IS NOT NULL),
n2 AS (SELECT *, epoch_ms(timestamp * 1000) AS datetime FROM n1 WHERE {_LEGAL}),
n3 AS (SELECT * FROM n2 WHERE datetime >= TIMESTAMP '2024-01-03' AND datetime < TIMESTAMP '2024-01-28'),
n4 AS (SELECT DISTINCT * FROM n3)"""

_SALES = """
s AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
    CASE WHEN l_returnflag = 'R' THEN 'buy' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'cart'
      WHEN l_returnflag = 'A' THEN 'fav' ELSE 'pv' END AS behavior_type
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def _cells(log: str) -> str:
    return f"""
top_items AS (SELECT item_id FROM {log} GROUP BY item_id HAVING count(DISTINCT user_id) >= 2),
kept AS (SELECT * FROM {log} WHERE item_id IN (SELECT item_id FROM top_items)),
top_users AS (SELECT user_id FROM kept GROUP BY user_id HAVING count(*) >= 2),
cells AS (SELECT user_id, item_id,
    CAST(max({_case('behavior_type', BEHAVIOR_WEIGHTS.items(), 'NULL')}) AS BIGINT) AS weight
  FROM kept WHERE user_id IN (SELECT user_id FROM top_users) GROUP BY user_id, item_id)"""


def _similar(cells: str, entity: str, shared: str, name: str) -> str:
    """Cosine of all ordered pairs, by the plain self-join."""
    return f"""
{name}_norm AS (SELECT {entity} AS id, CAST(sum(weight * weight) AS DOUBLE) AS square FROM {cells} GROUP BY 1),
{name}_dot AS (SELECT a.{entity} AS a, b.{entity} AS b, CAST(sum(a.weight * b.weight) AS DOUBLE) AS dot
  FROM {cells} a JOIN {cells} b ON a.{shared} = b.{shared} AND a.{entity} <> b.{entity} GROUP BY 1, 2),
{name} AS (SELECT a, b, dot / sqrt(x.square * y.square) AS sim
  FROM {name}_dot JOIN {name}_norm x ON a = x.id JOIN {name}_norm y ON b = y.id)"""


def _scores(cells: str) -> str:
    """Both scores by their definitions; the user-based one from user similarities."""
    return f"""{_similar(cells, "item_id", "user_id", "isim")},{_similar(cells, "user_id", "item_id", "usim")},
item_scores AS (SELECT c.user_id, i.b AS item_id, sum(c.weight * i.sim) AS score
  FROM {cells} c JOIN isim i ON c.item_id = i.a GROUP BY 1, 2),
user_scores AS (SELECT u.a AS user_id, c.item_id, sum(u.sim * c.weight) AS score
  FROM usim u JOIN {cells} c ON c.user_id = u.b GROUP BY 1, 2),
unseen AS (
  SELECT 'ItemCF' AS algorithm, x.* FROM item_scores x ANTI JOIN {cells} c ON x.user_id = c.user_id AND x.item_id = c.item_id
  UNION ALL
  SELECT 'UserCF', x.* FROM user_scores x ANTI JOIN {cells} c ON x.user_id = c.user_id AND x.item_id = c.item_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, algorithm ORDER BY round(score, 6) DESC, item_id) AS rank
  FROM unseen WHERE score > 0)"""


_MODEL = f"{_SALES},{_cells('s')}"
_EVENT_MODEL = f"{_EVENTS},{_cells('e')}"
_HOT = """
hot AS (SELECT item_id, interactions, row_number() OVER (ORDER BY interactions DESC, item_id) AS rank FROM (
  SELECT item_id, count(*) AS interactions FROM s WHERE behavior_type IN ('buy', 'cart')
  GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 20) x)"""
_HIDDEN = """
hidden AS (SELECT user_id, item_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, item_id) AS rn,
    count(*) OVER (PARTITION BY user_id) AS n FROM cells) x WHERE rn = 1 AND n >= 3)"""


def _half_up(part: str, whole: str, places: int, factor: int = 1) -> str:
    """part * factor / whole, rounded half up on whole numbers; NULL for a zero denominator."""
    scale = 10**places
    return (
        f"(CAST(({part}) AS BIGINT) * {2 * scale * factor} + NULLIF({whole}, 0)) // (2 * NULLIF({whole}, 0)) / {scale}.0"
    )


def _count(kind: str) -> str:
    return f"CAST(count(*) FILTER (WHERE behavior_type = '{kind}') AS BIGINT)"


PV, FAV, CART, BUY = (_count(kind) for kind in ("pv", "fav", "cart", "buy"))
_USERS = "count(DISTINCT user_id)"


def _users(*kinds: str) -> str:
    listed = ", ".join(f"'{kind}'" for kind in kinds)
    return f"count(DISTINCT CASE WHEN behavior_type IN ({listed}) THEN user_id END)"


_FUNNEL = f"SELECT {_users('pv')} AS a, {_users('cart', 'fav')} AS b, {_users('buy')} AS c FROM"
_RATIO = "CAST({0} AS DOUBLE) / NULLIF({1}, 0)".format


def _or_zero(part: str, whole: str) -> str:
    return f"coalesce({_RATIO(part, whole)}, 0.0)"


_SLICE = "extract(hour FROM datetime) BETWEEN 8 AND 20"
_BEHAVIOR_ROWS = """(VALUES ('pv', '浏览', 0), ('fav', '收藏', 1), ('cart', '加购', 2), ('buy', '购买', 3))
  AS k(behavior_type, behavior_name, place)"""


def _funnel_layers(source: str) -> str:
    rows = (("1-浏览", "a"), ("2-加购或收藏", "b"), ("3-购买", "c"))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS layer_name, {c} AS user_cnt, {_half_up(c, 'a', 2, 100)} AS pct_of_pv FROM ({_FUNNEL} {source}) x"
        for name, c in rows
    )


# --- fixed values: segment by high marks for recency, frequency and breadth ---
_SEGMENT_NAMES = """(VALUES (true, true, true, '重要价值客户'), (true, false, true, '重要发展客户'),
  (false, true, true, '重要保持客户'), (false, false, true, '重要挽留客户'), (true, true, false, '一般价值客户'),
  (true, false, false, '一般发展客户'), (false, true, false, '一般保持客户'), (false, false, false, '一般挽留客户'))
  AS g(recent, often, broad, customer_layer)"""
# --- end of fixed values ---

# Purchases by user and item first; a user's figures are sums over the items bought.
_RFM = f"""{_EVENTS},
bought AS (SELECT user_id, item_id, count(*) AS times, max(datetime) AS latest FROM e WHERE behavior_type = 'buy' GROUP BY user_id, item_id),
buyers AS (SELECT user_id, date_sub('hour', max(latest), (SELECT max(datetime) FROM e)) AS r_hours,
    CAST(sum(times) AS BIGINT) AS f_cnt, count(item_id) AS m_items FROM bought WHERE user_id IS NOT NULL GROUP BY user_id),
marks AS (SELECT buyers.*, CAST({_case('r_hours', RECENCY_EDGES, '1', '<=')} AS BIGINT) AS r_score,
    CAST({_case('f_cnt', VOLUME_EDGES, '2', '>=')} AS BIGINT) AS f_score,
    CAST({_case('m_items', VOLUME_EDGES, '2', '>=')} AS BIGINT) AS m_score FROM buyers),
layered AS (SELECT marks.*, customer_layer FROM marks JOIN {_SEGMENT_NAMES}
  ON recent = (r_score >= 3) AND often = (f_score >= 3) AND broad = (m_score >= 3))"""

_WINDOW_COUNTS = f"{PV} AS pv, {_USERS} AS uv, {CART} AS cart, {BUY} AS buy, count(*) AS events"
_TUMBLING = f"""{_EVENTS},
w AS (SELECT time_bucket(INTERVAL 5 MINUTE, datetime) AS window_start,
    time_bucket(INTERVAL 5 MINUTE, datetime) + INTERVAL 5 MINUTE AS window_end, {_WINDOW_COUNTS}
  FROM e GROUP BY 1, 2)"""
# A stream emits a window once the watermark, five seconds behind the newest event, has passed its end.
_CLOSED = "window_end <= (SELECT max(datetime) FROM e) - INTERVAL 5 SECOND"


_TURNOVER = f"""WITH {_EVENTS},
w AS (SELECT time_bucket(INTERVAL 5 MINUTE, datetime) AS window_start, time_bucket(INTERVAL 5 MINUTE, datetime) + INTERVAL 5 MINUTE AS window_end,
    count(*) AS buys, CAST(coalesce(sum(CAST(p_retailprice AS DECIMAL(18, 2))), 0) AS DOUBLE) AS turnover,
    count(*) FILTER (WHERE p_retailprice IS NULL) AS unpriced
  FROM e LEFT JOIN part ON item_id = p_partkey WHERE behavior_type = 'buy' GROUP BY 1, 2)"""


def _sliding(size: int, slide: int) -> str:
    return f"""WITH {_EVENTS},
starts AS (SELECT unnest(generate_series(time_bucket(INTERVAL {slide} MINUTE, (SELECT min(datetime) FROM e)),
  (SELECT max(datetime) FROM e), INTERVAL {slide} MINUTE)) AS window_start),
spread AS (SELECT e.*, unnest(generate_series(0, {size // slide - 1})) AS back FROM e),
hits AS (SELECT time_bucket(INTERVAL {slide} MINUTE, datetime) - back * INTERVAL {slide} MINUTE AS window_start,
    user_id, behavior_type FROM spread),
counted AS (SELECT window_start, {_WINDOW_COUNTS} FROM hits GROUP BY 1)
SELECT s.window_start, s.window_start + INTERVAL {size} MINUTE AS window_end, strftime(s.window_start, '%H:%M') AS "window",
  coalesce(pv, 0) AS pv, coalesce(uv, 0) AS uv, coalesce(cart, 0) AS cart, coalesce(buy, 0) AS buy, coalesce(events, 0) AS events
FROM starts s LEFT JOIN counted c ON s.window_start = c.window_start"""


_LABEL = "strftime(window_start, '%H:%M') || '~' || strftime(window_end, '%H:%M')"
_STREAM_COLUMNS = "window_start, window_end, pv, uv, cart, buy, events, CAST(buy AS DOUBLE) / events AS buy_rate"

ORACLE: dict[str, str] = {
    "ods_line_audit": f"""WITH {_ODS},
c AS (SELECT behavior_type, count(*) AS cnt FROM ods WHERE item_id IS NOT NULL GROUP BY 1)
SELECT behavior_type, cnt, CAST(sum(cnt) OVER () AS BIGINT) AS total FROM c""",
    "ods_landing_counts": f"WITH {_ODS} SELECT behavior_type, count(*) AS cnt FROM ods GROUP BY 1",
    "clean_report": f"""WITH {_RAW},
c AS (SELECT (SELECT count(*) FROM raw) AS a, (SELECT count(*) FROM n1) AS b, (SELECT count(*) FROM n2) AS c,
  (SELECT count(*) FROM n3) AS d, (SELECT count(*) FROM n4) AS e)
SELECT a AS raw_rows, b AS after_missing, c AS after_enum, d AS after_range, e AS after_dedup, a - b AS removed_missing,
  b - c AS removed_enum, c - d AS removed_range, d - e AS removed_dedup, CAST(e AS DOUBLE) / a AS retention FROM c""",
    "clean_log": f"WITH {_RAW} SELECT * FROM n4",
    "clean_profile": f"""WITH {_RAW} SELECT count(*) AS row_cnt, min(datetime) AS first_time, max(datetime) AS last_time,
  (max(timestamp) - min(timestamp)) / 60.0 AS span_minutes, {_USERS} AS users, count(DISTINCT item_id) AS items,
  count(DISTINCT category_id) AS categories FROM n4""",
    "missing_by_column": "WITH "
    + _RAW
    + " UNION ALL ".join(
        f" SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS missing FROM raw"
        for name in ("user_id", "item_id", "category_id", "behavior_type", "timestamp")
    ),
    "duplicate_rows": f"""WITH {_ODS} SELECT (SELECT count(*) FROM ods) AS row_cnt,
  (SELECT count(*) FROM ods) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ods) x) AS duplicate_rows""",
    "describe_values": "WITH "
    + _EVENTS
    + " UNION ALL ".join(
        f""" SELECT '{name}' AS column_name, count({name}) AS "count", round(avg({name}), 3) AS mean,
  round(stddev_samp({name}), 3) AS std, CAST(min({name}) AS DOUBLE) AS "min", quantile_cont({name}, 0.25) AS p25,
  quantile_cont({name}, 0.5) AS p50, quantile_cont({name}, 0.75) AS p75, CAST(max({name}) AS DOUBLE) AS "max" FROM e"""
        for name in ("user_id", "item_id", "category_id", "timestamp")
    ),
    "raw_csv_roundtrip": f"""WITH {_ODS} SELECT behavior_type, count(*) AS cnt, count(TRY_CAST(user_id AS BIGINT)) AS with_user,
  count(item_id) AS with_item, CAST(sum(CAST(timestamp AS BIGINT)) AS BIGINT) AS time_sum FROM ods GROUP BY 1""",
    "export_roundtrip": f"""WITH {_EVENTS} SELECT user_id, item_id, category_id, behavior_type, datetime FROM e
WHERE {_SLICE} AND behavior_type IN ('pv', 'buy')""",
    "sample_roundtrip": f"""WITH {_EVENTS} SELECT behavior_type, count(*) AS cnt, count(item_id) AS with_item,
  CAST(sum(timestamp) AS BIGINT) AS time_sum FROM e GROUP BY 1""",
    "clean_table": f"WITH {_RAW} SELECT * FROM n4",
    "replaced_table": f"WITH {_EVENTS} SELECT item_id, count(*) AS cnt FROM e GROUP BY 1",
    "partition_overwrite": f"""WITH {_DWD} SELECT dt, count(*) AS cnt FROM dwd
WHERE dt <> '2024-01-10' OR behavior_type = 'buy' GROUP BY dt""",
    "load_verification": f"""WITH {_EVENTS}, c AS (SELECT behavior_type, count(*) AS cnt FROM e GROUP BY 1)
SELECT behavior_type, cnt, CAST(sum(cnt) OVER () AS BIGINT) AS total FROM c""",
    "source_fallback": "SELECT event_type, count(*) AS cnt, 'events' AS source FROM events GROUP BY 1",
    "dwd_detail": f"WITH {_DWD} SELECT * FROM dwd",
    "dwd_reconcile": f"""WITH {_EVENTS},
src AS (SELECT extract(hour FROM datetime) AS hour, count(*) AS cnt FROM e WHERE behavior_type = 'pv' GROUP BY 1),
d AS (SELECT extract(hour FROM epoch_ms(timestamp * 1000)) AS hour, count(*) AS cnt FROM (
  SELECT DISTINCT user_id, item_id, category_id, behavior_type, timestamp FROM e) x WHERE behavior_type = 'pv' GROUP BY 1)
SELECT CAST(coalesce(src.hour, d.hour) AS BIGINT) AS hour, src.cnt AS left_cnt, d.cnt AS right_cnt,
  coalesce(src.cnt = d.cnt, false) AS matches FROM src FULL JOIN d ON src.hour = d.hour""",
    "dwd_layer_audit": f"""WITH {_DWD}, c AS (SELECT (SELECT count(*) FROM ods) AS a, (SELECT count(*) FROM dwd) AS b)
SELECT a AS ods_rows, b AS dwd_rows, a - b AS removed_rows FROM c""",
    "frame_equality": f"""WITH {_ODS} SELECT user_id, item_id, category_id, behavior_type, timestamp, count(*) - 1 AS surplus
FROM ods GROUP BY ALL HAVING count(*) > 1""",
    "ads_hourly_by_day": f"""WITH {_DWD} SELECT dt, CAST(extract(hour FROM CAST(datetime AS TIMESTAMP)) AS BIGINT) AS hour, {PV} AS pv,
  {_USERS} AS uv, {BUY} AS buy_cnt, {_half_up(BUY, PV, 4)} AS buy_rate FROM dwd GROUP BY 1, 2""",
    "ads_hourly": f"""WITH {_DWD} SELECT CAST(extract(hour FROM CAST(datetime AS TIMESTAMP)) AS BIGINT) AS hour, {PV} AS pv,
  {_USERS} AS uv, {BUY} AS buy_cnt, {_half_up(BUY, PV, 4)} AS buy_rate FROM dwd GROUP BY 1""",
    "ads_category": f"""WITH {_DWD} SELECT category_id, {PV} AS pv, {BUY} AS buy_cnt, {_half_up(BUY, PV, 4)} AS buy_rate
FROM dwd GROUP BY 1 HAVING {PV} > 100 ORDER BY 2 DESC, 1 LIMIT 20""",
    "ads_funnel": f"WITH {_EVENTS} {_funnel_layers('e')}",
    "overall_kpis": f"""WITH {_EVENTS} SELECT count(*) AS total_records, {_USERS} AS uv, {PV} AS pv, {FAV} AS fav_cnt, {CART} AS cart_cnt,
  {BUY} AS buy_cnt, {_half_up(CART, PV, 4)} AS cart_rate, {_half_up(BUY, PV, 4)} AS buy_rate FROM e""",
    "demo_kpis": f"""WITH {_EVENTS} SELECT {PV} AS pv, {_USERS} AS uv, {FAV} AS fav_cnt, {CART} AS cart_cnt, {BUY} AS buy_cnt,
  {_or_zero(CART, PV)} AS cart_rate, {_or_zero(BUY, PV)} AS buy_rate, {_or_zero(BUY, CART)} AS cart2buy_rate,
  {_or_zero('count(*)', _USERS)} AS actions_per_user, {_or_zero(PV, _USERS)} AS pv_per_user FROM e""",
    "real_kpis": f"""WITH {_EVENTS} SELECT {PV} AS pv, {_USERS} AS uv, {FAV} AS fav, {CART} AS cart, {BUY} AS buy,
  {_RATIO(CART, PV)} AS cart_rate, {_RATIO(FAV, PV)} AS fav_rate, {_RATIO(BUY, PV)} AS buy_rate,
  {_RATIO(PV, _USERS)} AS pv_per_user FROM e""",
    "core_metrics_slice": f"""WITH {_EVENTS} SELECT {PV} AS pv, {_USERS} AS uv, {FAV} AS fav, {CART} AS cart, {BUY} AS buy,
  {_or_zero(CART, PV)} AS cart_rate, {_or_zero(BUY, PV)} AS buy_rate, {_or_zero('count(*)', _USERS)} AS actions_per_user
FROM e WHERE {_SLICE} AND behavior_type IN ('pv', 'buy')""",
    "kpi_delta": f"""WITH {_EVENTS},
cur AS (SELECT {PV} AS pv, {_USERS} AS uv, {CART} AS cart, {BUY} AS buy, {_RATIO(CART, PV)} AS cart_rate, {_RATIO(BUY, PV)} AS buy_rate
  FROM e WHERE {_SLICE} AND behavior_type IN ('pv', 'cart')),
base AS (SELECT {_or_zero(CART, PV)} AS base_cart_rate, {_or_zero(BUY, PV)} AS base_buy_rate FROM e),
d AS (SELECT *, (cart_rate - base_cart_rate) * 100 AS cart_rate_delta, (buy_rate - base_buy_rate) * 100 AS buy_rate_delta FROM cur, base)
SELECT *, printf('%+.2fpct', cart_rate_delta) AS cart_rate_label, printf('%+.2fpct', buy_rate_delta) AS buy_rate_label FROM d""",
    "slice_coverage": f"""WITH {_EVENTS}, c AS (
  SELECT count(*) FILTER (WHERE {_SLICE} AND behavior_type IN ('pv', 'buy')) AS rows_hit, count(*) AS row_cnt FROM e)
SELECT *, CAST(rows_hit AS DOUBLE) / row_cnt AS share FROM c""",
    "hourly_traffic": f"""WITH {_EVENTS} SELECT CAST(extract(hour FROM datetime) AS BIGINT) AS hour_of_day, {PV} AS pv, {_USERS} AS uv,
  {BUY} AS buy_cnt FROM e GROUP BY 1""",
    "hourly_long": f"""WITH {_EVENTS}, h AS (SELECT CAST(extract(hour FROM datetime) AS BIGINT) AS hour, {PV} AS pv, {_USERS} AS uv FROM e GROUP BY 1)
SELECT hour, 'PV 浏览量' AS metric, pv AS value FROM h UNION ALL SELECT hour, 'UV 独立访客', uv FROM h""",
    "hour_behavior": f"""WITH {_EVENTS} SELECT CAST(extract(hour FROM datetime) AS BIGINT) AS hour, behavior_name, count(*) AS cnt
FROM e JOIN {_BEHAVIOR_ROWS} USING (behavior_type) GROUP BY 1, 2""",
    "behavior_mix": f"""WITH {_EVENTS}, c AS (SELECT * FROM e)
SELECT k.behavior_type, k.behavior_name, count(c.event_id) AS cnt, CAST(k.place AS BIGINT) AS place
FROM {_BEHAVIOR_ROWS} LEFT JOIN c USING (behavior_type) GROUP BY ALL""",
    "funnel_wide": f"WITH {_EVENTS} SELECT a AS pv_users, b AS intent_users, c AS buy_users FROM ({_FUNNEL} e) x",
    "funnel_long": f"WITH {_EVENTS} {_funnel_layers('e')}",
    "funnel_rates": f"""WITH {_EVENTS}, f AS ({_FUNNEL} e)
SELECT '1. 浏览用户' AS stage, a AS users, CAST(1.0 AS DOUBLE) AS rate, format('{{:,}}', a) || ' 人' AS label FROM f
UNION ALL SELECT '2. 意向用户（加购/收藏）', b, {_or_zero('b', 'a')}, format('{{:,}}', b) || ' 人（' || printf('%.1f', {_or_zero('b', 'a')} * 100) || '%）' FROM f
UNION ALL SELECT '3. 购买用户', c, {_or_zero('c', 'a')}, format('{{:,}}', c) || ' 人（' || printf('%.1f', {_or_zero('c', 'a')} * 100) || '%）' FROM f""",
    "count_funnel": f"""WITH {_EVENTS}, c AS (SELECT {PV} AS pv, {FAV} AS fav, {CART} AS cart, {BUY} AS buy FROM e)
SELECT CAST(1 AS BIGINT) AS place, '浏览 pv' AS stage, pv AS cnt FROM c UNION ALL SELECT 2, '加购 cart', cart FROM c
UNION ALL SELECT 3, '收藏 fav', fav FROM c UNION ALL SELECT 4, '购买 buy', buy FROM c""",
    "count_funnel_merged": f"""WITH {_EVENTS}, c AS (SELECT {PV} AS pv, {FAV} AS fav, {CART} AS cart, {BUY} AS buy FROM e)
SELECT CAST(1 AS BIGINT) AS place, '浏览' AS stage, pv AS cnt FROM c UNION ALL SELECT 2, '收藏+加购', fav + cart FROM c
UNION ALL SELECT 3, '购买', buy FROM c""",
    "category_top": f"""WITH {_EVENTS} SELECT category_id, {PV} AS pv, {BUY} AS buy_cnt, {_half_up(BUY, PV, 4)} AS buy_rate
FROM e GROUP BY 1 HAVING {PV} > 100 ORDER BY 2 DESC, 1 LIMIT 10""",
    "category_heat": f"""WITH {_EVENTS} SELECT category_id, {PV} AS pv, {BUY} AS buy_cnt, {_RATIO(BUY, PV)} AS buy_rate
FROM e GROUP BY 1 HAVING {PV} > 100 ORDER BY 2 DESC, 1 LIMIT 20""",
    "top_buyers": f"""WITH {_EVENTS} SELECT user_id, count(*) AS total_actions, {BUY} AS buy_cnt FROM e GROUP BY 1
ORDER BY 3 DESC, 2 DESC, 1 LIMIT 10""",
    "user_behavior_pivot": f"WITH {_EVENTS} SELECT user_id, {PV} AS pv, {FAV} AS fav, {CART} AS cart, {BUY} AS buy FROM e GROUP BY 1",
    "behavior_stack": f"""WITH {_EVENTS},
g AS (SELECT u.user_id, k.behavior_type, k.place, count(e.event_id) AS cnt FROM (SELECT DISTINCT user_id FROM e) u
  CROSS JOIN {_BEHAVIOR_ROWS} LEFT JOIN e ON e.user_id = u.user_id AND e.behavior_type = k.behavior_type GROUP BY ALL)
SELECT user_id, behavior_type, cnt, CAST(coalesce(sum(cnt) OVER (PARTITION BY user_id ORDER BY place
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS bottom FROM g""",
    "buy_detail": f"WITH {_EVENTS} SELECT user_id, item_id, category_id, datetime FROM e WHERE behavior_type = 'buy'",
    "detail_preview": f"""WITH {_EVENTS} SELECT user_id, item_id, category_id, behavior_name, datetime FROM e
JOIN {_BEHAVIOR_ROWS} USING (behavior_type) WHERE {_SLICE} AND behavior_type IN ('pv', 'buy')
ORDER BY user_id, datetime, item_id, behavior_name LIMIT 1000""",
    "gmv_daily": """WITH d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS gmv,
  count(DISTINCT o_orderkey) AS order_cnt, count(DISTINCT o_custkey) AS pay_users FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT dt, CAST(gmv AS DOUBLE) AS gmv, order_cnt, pay_users,
  (CAST(gmv * 100 AS BIGINT) * 2 + pay_users) // (2 * pay_users) / 100.0 AS avg_order_value FROM d""",
    "rfm_users": f"WITH {_RFM} SELECT * FROM layered",
    "rfm_segments": f"""WITH {_RFM}, g AS (SELECT customer_layer, count(*) AS user_cnt FROM layered GROUP BY 1),
t AS (SELECT *, CAST(sum(user_cnt) OVER () AS BIGINT) AS total FROM g)
SELECT customer_layer, user_cnt, {_half_up('user_cnt', 'total', 1, 100)} AS pct FROM t""",
    "rfm_report": f"""WITH {_RFM}, g AS (SELECT customer_layer, count(*) AS user_cnt FROM layered GROUP BY 1),
t AS (SELECT *, user_cnt / CAST(sum(user_cnt) OVER () AS DOUBLE) AS pct FROM g)
SELECT customer_layer, user_cnt, pct, starts_with(customer_layer, '重要') AS is_key,
  format('{{:,}}', user_cnt) || ' 人（' || printf('%.1f', pct * 100) || '%）' AS label FROM t""",
    "tumbling_5m": f"""WITH {_TUMBLING} SELECT window_start, window_end, {_LABEL} AS "window", pv, uv, cart, buy, events,
  CAST(buy AS DOUBLE) / events AS buy_rate FROM w""",
    "sliding_15_5": _sliding(15, 5),
    "sliding_30_1": _sliding(30, 1),
    "user_windows": f"""WITH {_EVENTS} SELECT time_bucket(INTERVAL 5 MINUTE, datetime) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, datetime) + INTERVAL 5 MINUTE AS window_end, user_id, {PV} AS pv, {CART} AS cart, {BUY} AS buy,
  count(*) AS events FROM e GROUP BY 1, 2, 3""",
    "peak_windows": f"""WITH {_TUMBLING} SELECT * FROM (SELECT 'peak_pv' AS kind, window_start, {_LABEL} AS "window", pv, uv, buy
  FROM w ORDER BY pv DESC, window_start LIMIT 1) a UNION ALL SELECT * FROM (
  SELECT 'busiest_buy', window_start, {_LABEL}, pv, uv, buy FROM w ORDER BY buy DESC, window_start LIMIT 1) b""",
    "time_span": f"""WITH {_EVENTS} SELECT count(*) AS row_cnt, min(datetime) AS first_time, max(datetime) AS last_time,
  (max(timestamp) - min(timestamp)) / 60.0 AS span_minutes FROM e""",
    "stream_tumbling": f"WITH {_TUMBLING} SELECT {_STREAM_COLUMNS} FROM w WHERE {_CLOSED}",
    "stream_sliding": f"""WITH {_EVENTS}, spread AS (SELECT e.*, unnest([0, 1, 2]) AS back FROM e),
hits AS (SELECT time_bucket(INTERVAL 5 MINUTE, datetime) - back * INTERVAL 5 MINUTE AS window_start, user_id, behavior_type FROM spread),
w AS (SELECT window_start, window_start + INTERVAL 15 MINUTE AS window_end, {_WINDOW_COUNTS} FROM hits GROUP BY 1, 2)
SELECT {_STREAM_COLUMNS} FROM w WHERE {_CLOSED}""",
    "stream_user_windows": f"""WITH {_EVENTS}, w AS (SELECT time_bucket(INTERVAL 5 MINUTE, datetime) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, datetime) + INTERVAL 5 MINUTE AS window_end, user_id, {PV} AS pv, {CART} AS cart, {BUY} AS buy,
  count(*) AS events FROM e GROUP BY 1, 2, 3) SELECT * FROM w WHERE {_CLOSED}""",
    "stream_reconcile": f"""WITH {_TUMBLING}, c AS (SELECT *, {_CLOSED} AS closed FROM w)
SELECT window_start, """
    + ", ".join(
        f"CASE WHEN closed THEN {name} ELSE -1 END AS left_{name}, {name} AS right_{name}" for name in ("pv", "uv", "cart", "buy")
    )
    + ", closed AS matches FROM c",
    "stream_upsert": f"WITH {_TUMBLING} SELECT {_STREAM_COLUMNS} FROM w WHERE {_CLOSED}",
    "decoded_messages": f"""WITH {_EVENTS} SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
  CAST(category_id AS VARCHAR) AS category_id, behavior_type, datetime FROM e""",
    "stream_messages": f"""WITH {_EVENTS} SELECT behavior_type, count(*) AS cnt, min(datetime) AS first_time,
  max(datetime) AS last_time FROM e GROUP BY 1""",
    "late_rows": f"""WITH {_EVENTS},
arrived AS (SELECT *, (event_id * 4) // (SELECT max(event_id) + 1 FROM events) + CASE WHEN event_id % 37 = 0 THEN 1 ELSE 0 END AS batch FROM e_all),
known AS (SELECT batch, max(max(timestamp)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
  FROM arrived GROUP BY batch)
SELECT event_id, user_id, behavior_type, datetime, CAST(batch AS BIGINT) AS batch FROM arrived JOIN known USING (batch)
WHERE timestamp - timestamp % 300 + 300 <= newest - 5""",
    "stream_late_orders": """WITH o AS (SELECT o_orderdate, o_orderkey * 4 // (SELECT max(o_orderkey) + 1 FROM orders) AS part FROM orders),
known AS (SELECT part, max(max(o_orderdate)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM o GROUP BY part)
SELECT CAST(part AS BIGINT) AS part, count(*) AS rows_in, count(*) FILTER (WHERE o_orderdate <= newest - INTERVAL 400 DAY) AS late
FROM o JOIN known USING (part) GROUP BY part""",
    "stream_early": f"""WITH {_TUMBLING},
r AS (SELECT time_bucket(INTERVAL 5 MINUTE, datetime) AS window_start,
  count(DISTINCT event_id * 2 // (SELECT max(event_id) + 1 FROM events)) AS revisions FROM e GROUP BY 1)
SELECT {_STREAM_COLUMNS}, revisions FROM w JOIN r USING (window_start)""",
    "stream_sliding_30_1": f"""WITH s AS ({_sliding(30, 1)})
SELECT * FROM s WHERE window_end <= (WITH {_EVENTS} SELECT max(time_bucket(INTERVAL 1 MINUTE, datetime)) + INTERVAL 1 MINUTE FROM e
  WHERE time_bucket(INTERVAL 1 MINUTE, datetime) + INTERVAL 1 MINUTE <= (SELECT max(datetime) FROM e) - INTERVAL 5 SECOND)""",
    "stream_corrected": f"WITH {_TUMBLING} SELECT {_STREAM_COLUMNS} FROM w",
    "turnover_5m": f"{_TURNOVER} SELECT * FROM w",
    "stream_turnover": f"""{_TURNOVER} SELECT * FROM w
WHERE window_end <= (SELECT max(datetime) FROM e WHERE behavior_type = 'buy') - INTERVAL 5 SECOND""",
    "stream_distinct": f"""WITH {_ODS} SELECT behavior_type, count(*) AS cnt, count(item_id) AS with_item FROM (SELECT DISTINCT * FROM ods) x GROUP BY 1""",
    "cf_matrix_stats": f"""WITH {_MODEL}, c AS (SELECT {_USERS} AS n_users, count(DISTINCT item_id) AS n_items, count(*) AS cells FROM cells)
SELECT *, CAST(cells AS DOUBLE) / (n_users * n_items) AS density FROM c""",
    "cf_rating_cells": f"WITH {_MODEL} SELECT * FROM cells",
    "cf_item_similarity": f"""WITH {_EVENT_MODEL},{_similar('cells', 'item_id', 'user_id', 'sims')}
SELECT a AS item_id, rank, b AS neighbour, sim FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(sim, 6) DESC, b) AS rank FROM sims) x
WHERE rank <= 10""",
    "cf_user_similarity": f"""WITH {_EVENT_MODEL},{_similar('cells', 'user_id', 'item_id', 'sims')}
SELECT a AS user_id, rank, b AS neighbour, sim FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(sim, 6) DESC, b) AS rank FROM sims) x
WHERE rank <= 10""",
    "cf_scores": f"""WITH {_EVENT_MODEL},{_scores('cells')}
SELECT user_id, item_id, round(max(score) FILTER (WHERE algorithm = 'ItemCF'), 6) AS item_score,
  round(max(score) FILTER (WHERE algorithm = 'UserCF'), 6) AS user_score FROM unseen WHERE score > 0 GROUP BY 1, 2""",
    "cf_recommendations": f"""WITH {_MODEL},{_scores('cells')}
SELECT user_id, algorithm, rank, item_id, round(score, 6) AS score FROM ranked WHERE rank <= 5""",
    "cf_recommendation_table": f"""WITH {_MODEL},{_scores('cells')}
SELECT user_id, algorithm, rank, item_id, round(score, 4) AS score FROM ranked
WHERE rank <= 3""",
    "cf_leave_one_out": f"WITH {_MODEL},{_HIDDEN} SELECT * FROM hidden",
    "cf_hit_rate": f"""WITH {_MODEL},{_HIDDEN},
train AS (SELECT c.* FROM cells c ANTI JOIN hidden h ON c.user_id = h.user_id AND c.item_id = h.item_id),{_scores('train')},
h AS (SELECT a.algorithm, (SELECT count(*) FROM ranked k JOIN hidden h ON k.user_id = h.user_id AND k.item_id = h.item_id
    WHERE k.rank <= 5 AND k.algorithm = a.algorithm) AS hits FROM (VALUES ('UserCF'), ('ItemCF')) a(algorithm)),
pools AS (SELECT user_id, (SELECT count(DISTINCT item_id) FROM cells) - count(*) AS pool FROM train
  WHERE user_id IN (SELECT user_id FROM hidden) GROUP BY 1),
b AS (SELECT count(*) AS evaluated_users, 5 / avg(pool) AS random_hit_rate FROM pools)
SELECT algorithm, CAST(5 AS BIGINT) AS k, evaluated_users, hits, CAST(hits AS DOUBLE) / evaluated_users AS hit_rate, random_hit_rate,
  CAST(hits AS DOUBLE) / evaluated_users / random_hit_rate AS lift FROM h, b""",
    "hot_items": f"WITH {_SALES},{_HOT} SELECT item_id, interactions, rank FROM hot",
    "cf_fallback": f"""WITH {_MODEL},{_scores('cells')},{_HOT},
listed AS (SELECT user_id, algorithm AS source, rank, item_id FROM ranked WHERE rank <= 3)
SELECT * FROM listed UNION ALL
SELECT u.user_id, 'Hot', rank, item_id FROM (SELECT DISTINCT user_id FROM s) u CROSS JOIN hot
WHERE u.user_id NOT IN (SELECT user_id FROM listed)""",
    "cf_examples": f"""WITH {_MODEL},{_scores('cells')},{_HOT},
sizes AS (SELECT user_id, count(*) AS cells FROM cells GROUP BY 1),
firsts AS (SELECT * FROM sizes ORDER BY user_id LIMIT 3), cold AS (SELECT * FROM sizes ORDER BY cells, user_id LIMIT 1)
SELECT 'first' AS example, user_id, cells, algorithm, rank, item_id FROM firsts JOIN ranked USING (user_id) WHERE rank <= 5
UNION ALL SELECT 'cold', user_id, cells, 'Hot', rank, item_id FROM cold CROSS JOIN hot WHERE rank <= 5""",
}

_DAILY = f"""SELECT dt, {PV} AS pv, {_USERS} AS uv, {FAV} AS fav_cnt, {CART} AS cart_cnt, {BUY} AS buy_cnt, {_users('buy')} AS buy_users,
  {_half_up(CART, PV, 4)} AS cart_rate, {_half_up(BUY, PV, 4)} AS buy_rate, {_half_up(BUY, CART, 4)} AS cart2buy_rate FROM dwd GROUP BY 1"""
ORACLE["daily_metrics"] = ORACLE["warehouse_build"] = f"WITH {_DWD} {_DAILY}"
ORACLE["incremental_daily"] = ORACLE["daily_metrics"]
ORACLE["incremental_category"] = ORACLE["ads_category"]
ORACLE["incremental_funnel"] = f"WITH {_DWD} {_funnel_layers('dwd')}"
_TRAILING = f"""WITH {_EVENTS},
d AS (SELECT DISTINCT CAST(datetime AS DATE) AS day, user_id, behavior_type = 'buy' AS bought FROM e),
t AS (SELECT * FROM (SELECT DISTINCT day AS until FROM d) u JOIN d ON day BETWEEN until - 6 AND until)"""
ORACLE["trailing_users"] = f"""{_TRAILING} SELECT strftime(until, '%Y-%m-%d') AS until, {_USERS} AS users,
  count(DISTINCT user_id) FILTER (WHERE bought) AS buyers FROM t GROUP BY 1"""
ORACLE["trailing_estimate"] = f"{_TRAILING} SELECT strftime(until, '%Y-%m-%d') AS until, {_USERS} AS users, true AS within FROM t GROUP BY 1"
