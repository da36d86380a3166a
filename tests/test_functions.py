import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from clickloom.functions import compact_id_decode, compact_id_encode, epoch_minute, md5_hex, md5_signed64
from clickloom.functions import safe_map, times
from clickloom.functions.hashing import CODE_DIGITS

EDGES = [0, 1, -1, 31, 32, 2**63 - 1, -(2**63), -8925578992189951322, 1234567890123456789]


def test_codec_round_trip_and_digits(spark):
    rows = spark.createDataFrame([(v,) for v in EDGES], "v bigint").select(
        "v", compact_id_encode(F.col("v")).alias("c")
    ).withColumn("back", compact_id_decode(F.col("c"))).collect()
    for row in rows:
        unsigned = row.v % 2**64
        digits = "".join(CODE_DIGITS[(unsigned >> (5 * i)) & 31] for i in range(12, -1, -1))
        assert row.c == digits + "u"
        assert row.back == row.v


def test_hashes(spark):
    words = ["", "a", "abc", "Ünï", "null", "x" * 100, "234"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", md5_hex(F.col("w")).alias("h"), md5_signed64(F.col("w")).alias("n")).collect()
    for row in rows:
        digest = hashlib.md5(row.w.encode()).digest()
        assert row.h == digest.hex().upper()
        assert row.n == struct.unpack("<q", digest[:8])[0]
    assert any(r.n < 0 for r in rows) and any(r.n > 0 for r in rows)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_epoch_minute_ignores_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([("2016-03-20 16:05:59",), ("1970-01-01 00:00:00",), ("nope",), (None,)], "t string")
        got = [r[0] for r in rows.select(epoch_minute(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [times.slot_minute("2016-03-20-16") + 5, 0, None, None]


def test_hour_lists():
    assert times.hour_list("2016-03-20-22", 4) == ["2016-03-20-22", "2016-03-20-23", "2016-03-21-00", "2016-03-21-01"]
    assert times.previous_hour("2016-03-01-00") == "2016-02-29-23"
    assert times.previous_day("2016-03-01") == "2016-02-29"
    assert times.history_floor("2016-01-16", 15) == times.day_minute("2016-01-01")


def test_safe_map_keeps_the_last_entry(spark):
    rows = spark.sql("select array(named_struct('key','a','value','1'), named_struct('key','b','value','2'),"
                     " named_struct('key','a','value','3')) as e")
    assert rows.select(safe_map(F.col("e")).alias("m")).first().m == {"a": "3", "b": "2"}
