"""Bloom reduction and the stitch that uses it."""

import re

import pytest
from pyspark.sql import functions as F

from clickloom.operators import bloom, joins


def test_no_member_is_lost_and_most_others_are(spark):
    members = spark.range(0, 60_000, 3).select(F.col("id").alias("k"), F.concat(F.lit("r"), "id").alias("r"))
    rows = spark.range(60_000).select(F.col("id").alias("k"), F.concat(F.lit("r"), "id").alias("r"), F.lit(1).alias("word"))
    rows = rows.withColumnRenamed("word", "x")
    kept = bloom.might_be_member(rows, members, ["k", "r"])
    assert kept.columns == rows.columns
    assert kept.where("k % 3 = 0").count() == 20_000
    assert kept.where("k % 3 <> 0").count() < 0.05 * 40_000


def test_size_follows_the_keys_and_is_bounded(spark):
    assert bloom.words_for(0) == 1 and bloom.words_for(1_000) == 250
    assert bloom.words_for(bloom.MOST_WORDS * 4) == bloom.MOST_WORDS and bloom.words_for(bloom.MOST_WORDS * 4 + 1) is None
    rows = spark.range(10).select(F.col("id").alias("k"))
    # Too many keys for the bound: all rows pass.
    assert bloom.might_be_member(rows, rows.limit(1), ["k"], count=1 << 40).count() == 10
    assert bloom.might_be_member(rows, rows.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("copies", [1, 3])
def test_stitch_takes_one_bid_and_sorts_no_line(spark, copies):
    shows = spark.createDataFrame([("a", "1", "t2", "ua", "s"), ("a", "1", "t1", "ub", "s"), ("a", "2", "t1", "ua", None),
                                   ("a", None, "t1", "ua", None)], "ssp string, req string, time string, ua string, agsid string")
    clicks = spark.createDataFrame([("a", "1", "t9"), ("a", "1", "t5")], "ssp string, req string, time string")
    bids = spark.createDataFrame([("a", "1", "line x"), ("a", "1", "line y"), ("a", "7", "line z"), ("b", "2", "line")] * copies,
                                 "ssp string, req string, line string")
    stitched = joins.stitch_show_click_bid(shows, clicks, bids)
    rows = stitched.collect()
    assert [(r.ssp, r.req, r.show_time, r.ua, r.click_time, r.clicked) for r in rows] == [("a", "1", "t1", "ub", "t5", 1)]
    again = joins.stitch_show_click_bid(shows, clicks, bids.repartition(3)).collect()
    assert rows[0].line in ("line x", "line y") and again == rows
    plan = stitched._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    # No sort has a line among its input.
    sorts = re.findall(r"\) Sort\s*\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert not [s for s in sorts if re.search(r"\bline#", s)], sorts


def test_more_keys_get_the_largest_filter_for_a_while(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"))
    members = rows.where("k < 10")
    for count in (10, 12_000_000, bloom.MOST_KEYS):
        assert 10 <= bloom.might_be_member(rows, members, ["k"], count).count() < 100
    hit, rest = bloom.split_members(rows, members, ["k"], 10)
    assert hit.where("k < 10").count() == 10 and hit.count() + rest.count() == 1000 and rest.count() > 900
