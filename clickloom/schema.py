"""Declared schemas and the fixed values of the behaviour model."""

from pyspark.sql import types as T

_IDS = ("user_id", "item_id", "category_id")


def _fields(*pairs):
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


RAW_SCHEMA = _fields(
    *[(name, T.LongType()) for name in _IDS],
    ("behavior_type", T.StringType()),
    ("timestamp", T.LongType()),
)
CLEAN_SCHEMA = T.StructType(RAW_SCHEMA.fields + [T.StructField("datetime", T.TimestampType(), True)])
ODS_SCHEMA = _fields(*[(field.name, T.StringType()) for field in RAW_SCHEMA])
SAMPLE_SCHEMA = _fields(
    *[(name, T.LongType()) for name in _IDS],
    ("behavior_type", T.IntegerType()),
    ("timestamp", T.LongType()),
)
STREAM_SCHEMA = _fields(
    *[(name, T.StringType()) for name in _IDS],
    ("behavior_type", T.IntegerType()),
    ("ts", T.TimestampType()),
)

ODS_COLUMNS = ODS_SCHEMA.fieldNames()
DWD_COLUMNS = ["user_id", "item_id", "category_id", "behavior_type", "behavior_name", "datetime", "dt"]
EXPORT_COLUMNS = ["user_id", "item_id", "category_id", "behavior_type", "datetime"]

# --- Fixed values: codes, labels, weights and score edges that results must equal ---
BEHAVIORS = ("pv", "fav", "cart", "buy")
BEHAVIOR_NAMES = {"pv": "浏览", "fav": "收藏", "cart": "加购", "buy": "购买"}
UNKNOWN_BEHAVIOR = "未知"
BEHAVIOR_CODES = {1: "pv", 2: "fav", 3: "cart", 4: "buy"}
BEHAVIOR_WEIGHTS = {"pv": 1, "fav": 2, "cart": 3, "buy": 4}

FUNNEL_LAYERS = ("1-浏览", "2-加购或收藏", "3-购买")
FUNNEL_STAGES = ("1. 浏览用户", "2. 意向用户（加购/收藏）", "3. 购买用户")
COUNT_FUNNEL_STAGES = (("浏览 pv", "pv"), ("加购 cart", "cart"), ("收藏 fav", "fav"), ("购买 buy", "buy"))
MERGED_FUNNEL_STAGES = ("浏览", "收藏+加购", "购买")
TRAFFIC_METRICS = {"pv": "PV 浏览量", "uv": "UV 独立访客"}

RECENCY_EDGES = ((1, 5), (3, 4), (6, 3), (9, 2))  # hours at most -> score, otherwise 1
VOLUME_EDGES = ((5, 5), (3, 4), (2, 3))  # count at least -> score, otherwise 2
HIGH_SCORE = 3
# (M high, R high, F high) -> segment, in the order of presentation
SEGMENTS = (
    ((True, True, True), "重要价值客户"),
    ((True, True, False), "重要发展客户"),
    ((True, False, True), "重要保持客户"),
    ((True, False, False), "重要挽留客户"),
    ((False, True, True), "一般价值客户"),
    ((False, True, False), "一般发展客户"),
    ((False, False, True), "一般保持客户"),
    ((False, False, False), "一般挽留客户"),
)
KEY_SEGMENT_PREFIX = "重要"
PEOPLE_UNIT = "人"

CLEAN_FROM = "2017-11-25"
CLEAN_UNTIL = "2017-12-04"

DETAIL_ROWS = 1000
MIN_ITEM_USERS = 2
MIN_USER_ACTIONS = 2
TOP_K = 5
TABLE_TOP_K = 3
NEIGHBOURS = 10
HOT_ITEMS = 20
# --- end of fixed values ---
