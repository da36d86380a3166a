"""Explicit schemas of the datasets that jobs exchange."""

from __future__ import annotations

from pyspark.sql import types as T

ID_PAIR = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("id1", T.StringType()),
    T.StructField("id1_type", T.StringType()),
    T.StructField("id2", T.StringType()),
    T.StructField("id2_type", T.StringType()),
])

IDENTITY = T.StructType([
    T.StructField("cid_hash", T.LongType()),
    T.StructField("uid", T.LongType()),
    T.StructField("cid", T.StringType()),
    T.StructField("id_type", T.IntegerType()),
    T.StructField("minute", T.LongType()),
    T.StructField("num", T.LongType()),
])

# Daily base table: uid is the 14-character code, there is no hash column.
DAILY_BASE = T.StructType([
    T.StructField("uid_code", T.StringType()),
    T.StructField("cid", T.StringType()),
    T.StructField("id_type", T.IntegerType()),
    T.StructField("minute", T.LongType()),
    T.StructField("num", T.LongType()),
])

UID_CHANGE = T.StructType([
    T.StructField("old_uid", T.LongType()),
    T.StructField("new_uid", T.LongType()),
    T.StructField("minute", T.LongType()),
])

CHANNEL_MAP = T.StructType([
    T.StructField("cid", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("id_type", T.IntegerType()),
    T.StructField("minute", T.LongType()),
])

CELL = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("version", T.LongType()),
])

# Id type codes.
ID_TYPES = {"aguid": 0, "agsid": 1, "adx": 2, "baidu": 3, "tanx": 4, "agfid": 5}

# Sizing rules of the identity job.
RECENT_PER_GROUP = 50
GROUP_SIZE_LIMIT = 5000
WINDOW_MINUTES = 480
CHANNEL_HISTORY_DAYS = 15
