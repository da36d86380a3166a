import pytest
from pyspark.sql import functions as F

from clickloom.operators import baskets, dedupe, rendering, skew


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(0, 400, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 10).alias("k"),
        F.col("id").alias("v"))
    right = spark.createDataFrame([(7, "a"), (7, "b"), (2, "c"), (99, "d")], "k bigint, w string")
    return left, right


def key_counts(left):
    return left.groupBy("k").agg(F.count("*").alias("n_rows")).where("k is not null")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows,hot_share", [(10, 10_000), (10, 2), (1_000_000, 10_000), (None, None)])
def test_spread_join_equals_plain_join(sides, how, hot_rows, hot_share):
    left, right = sides
    options = {} if hot_rows is None else {"counts": key_counts(left), "hot_rows": hot_rows, "hot_share": hot_share}
    got = skew.spread_join(left, right, ["k"], how, **options)
    want = left.join(right, ["k"], how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_keys_are_all_listed_above_the_threshold(sides):
    left, _ = sides
    counts = key_counts(left)
    rows = {r.k: r["__salts"] for r in skew.hot_key_salts(counts, ["k"], "n_rows", hot_rows=10).collect()}
    sizes = {r.k: r.n_rows for r in counts.collect()}
    assert rows == {k: -(-n // 10) for k, n in sizes.items() if n > 10}
    # At most 1/hot_share of the rows each: fewer than hot_share keys, whatever the data.
    few = skew.hot_key_salts(counts, ["k"], "n_rows", hot_rows=1, hot_share=3).collect()
    assert [r.k for r in few] == [k for k, n in sizes.items() if n > sum(sizes.values()) / 3]
    assert skew.hot_key_salts(counts, ["k"], "n_rows", hot_rows=10_000) is None


@pytest.mark.parametrize("partitions", [1, 8])
def test_a_hot_key_uses_all_its_salts(spark, partitions):
    left = spark.range(0, 1_000, 1, partitions).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(1, "a")], "k int, w string")
    counts = left.groupBy("k").agg(F.count("*").alias("n_rows"))
    joined = skew.spread_join(left, right, ["k"], "left", counts=counts, hot_rows=100)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "__salt" in plan and joined.count() == 1_000
    spread = F.pmod(F.xxhash64("k", "v", F.spark_partition_id()), F.lit(10))
    per_salt = [r["count"] for r in left.groupBy(spread.alias("s")).count().collect()]
    assert len(per_salt) == 10 and max(per_salt) < 160


def test_size_guard_boundary(spark):
    rows = spark.range(4999).select(F.lit("below").alias("g"), "id").unionByName(
        spark.range(5000).select(F.lit("at").alias("g"), "id"))
    kept = skew.drop_oversized(rows, ["g"], 5000).groupBy("g").count().collect()
    assert [(r.g, r["count"]) for r in kept] == [("below", 4999)]


@pytest.mark.parametrize("descending", [False, True])
def test_parts_follow_the_whole_order(spark, descending):
    # One group of many distinct values, one pile of copies, one small group, one without a key.
    rows = spark.range(1000).select(F.lit("many").alias("g"), F.col("id").cast("string").alias("v")).unionByName(
        spark.range(500).select(F.lit("copies").alias("g"), F.lit("same").alias("v"))).unionByName(
        spark.range(120).select(F.lit(None).cast("string").alias("g"), F.col("id").cast("string").alias("v"))).unionByName(
        spark.createDataFrame([("small", "b"), ("small", "a"), ("small", "b")], "g string, v string"))
    parts = rendering.collect_parts(rows, ["g"], F.col("v"), descending=descending, part_rows=50).collect()
    gathered = {}
    for row in sorted(parts, key=lambda r: (str(r.g), r.part)):
        gathered.setdefault(row.g, []).append(row["values"])
    want = {
        "many": [str(i) for i in range(1000)], "copies": ["same"] * 500, "small": ["a", "b", "b"],
        None: [str(i) for i in range(120)],
    }
    assert {g: sum(p, []) for g, p in gathered.items()} == {g: sorted(v, reverse=descending) for g, v in want.items()}
    for pieces in gathered.values():
        assert all(len(p) == 50 for p in pieces[:-1]) and 0 < len(pieces[-1]) <= 50
    numbers = {}
    for row in parts:
        numbers.setdefault(row.g, set()).add(row.part)
    assert all(n == set(range(len(n))) for n in numbers.values())


def test_huge_basket_is_dropped_before_pairs(spark):
    rows = spark.range(10_000).select(F.lit("bot").alias("u"), "id").unionByName(
        spark.createDataFrame([("u1", 1), ("u1", 2), ("u1", 2), ("u2", 3)], "u string, id bigint"))
    pairs = baskets.item_pairs(rows, ["u"], "id", 2, 24)
    assert [tuple(r) for r in pairs.collect()] == [("u1", 1, 2)]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    # The row limit stands on both sides of the exchange.
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_two_stage_top_n_equals_one_stage(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 3).alias("uid"), F.lit(1).alias("id_type"), (F.col("id") % 97).alias("minute"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("cid"))
    got = {tuple(r) for r in dedupe.recent_per_group(rows, limit=50).collect()}
    everything = [tuple(r) for r in rows.collect()]
    want = set()
    for uid in range(3):
        mine = sorted((r for r in everything if r[0] == uid), key=lambda r: (r[2], r[3]), reverse=True)
        want |= set(mine[:50])
    assert got == want
