import pytest
from pyspark.sql import functions as F

from clickloom.sources import cells, logs, sinks, snapshots
from clickloom.streaming.logs import log_stream
from clickloom.streaming.side_table import RefreshingTable, run_with_side_table


@pytest.fixture()
def log_table(spark, folder):
    rows = [(t, c, f"2024-01-0{d}", f"2024-01-0{d}-{h:02d}", f"{t}{c}{d}{h}")
            for t in ("show", "pv") for c in ("adx", "tanx") for d in (1, 2) for h in (9, 10)]
    path = folder + "/log"
    logs.write_log_table(spark.createDataFrame(rows, "log_type string, channel string, day string, hour string, value string"), path)
    return path


def test_log_scan_prunes(spark, log_table):
    df = logs.scan_display(spark, log_table, "show", "adx", "2024-01-02-10")
    assert [r.value for r in df.collect()] == ["showadx210"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters:")[1].split("]")[0]
    assert all(name in partition_filters for name in ("log_type", "channel", "day"))
    assert "hour" in plan.split("PushedFilters:")[1].split("]")[0]
    assert logs.scan_page_views(spark, log_table, "pv", "2024-01-01").count() == 4
    # Hours that are not next to each other, over two digits.
    assert logs.scan_hours(spark, [log_table], ["2024-01-01-09", "2024-01-02-10"], channels=["adx"]).count() == 4
    with pytest.raises(ValueError):
        logs.scan_display(spark, log_table, "pv", "adx", "2024-01-01")


def test_gzip_text_scan(spark, folder):
    sinks.write_delimited(spark.createDataFrame([("a", None), ("b", 2)], "k string, n int"), folder + "/t")
    assert sorted(r.value for r in logs.scan_text(spark, folder + "/t").collect()) == ["a\t", "b\t2"]


def test_snapshot_order_and_names(spark, folder):
    for name in ("state.2024-01-09", "state.2024-01-10", "state.x", "states.2025", "state.2024-01-10.tmp"):
        spark.range(1).write.parquet(f"{folder}/{name}")
    names = [p.rsplit("/", 1)[1] for p in snapshots.list_snapshots(spark, folder, "state.")]
    assert names == ["state.2024-01-10", "state.2024-01-09"]
    with pytest.raises(FileNotFoundError):
        snapshots.newest_snapshot(spark, folder, "none.")


def test_refreshing_table_keeps_the_last_good_one(spark, folder):
    def put(name, rows):
        spark.range(rows).select(F.col("id").alias("k"), F.lit(name).alias("v")).write.parquet(f"{folder}/cfg.{name}")

    put("1", 20)
    side = RefreshingTable(spark, folder, "cfg.")
    assert side.current().first().v == "1"
    put("2", 10)  # not more than ten rows: refused
    assert side.current().first().v == "1"
    put("3", 11)
    assert side.current().first().v == "3"
    import os

    os.makedirs(f"{folder}/cfg.4")  # unreadable: the last good one stays
    assert side.current().first().v == "3"


def test_a_ring_of_usable_snapshots(spark, folder):
    import shutil

    def put(name, rows=20):
        spark.range(rows).select(F.col("id").alias("k"), F.lit(name).alias("v")).write.parquet(f"{folder}/cfg.{name}")

    side = RefreshingTable(spark, folder, "cfg.")
    with pytest.raises(FileNotFoundError):
        side.current()
    put("1", 3)  # too small, also as the first one
    with pytest.raises(FileNotFoundError):
        side.current()
    for name in ("2", "3", "4", "5"):
        put(name)
        assert side.current().first().v == name
    assert [p[-1] for p in side.ring] == ["3", "4", "5"]
    shutil.rmtree(f"{folder}/cfg.5")
    assert side.current().first().v == "4"
    shutil.rmtree(f"{folder}/cfg.4")
    put("6", 4)
    assert side.current().first().v == "3"


def test_a_first_snapshot_that_cannot_be_read_is_passed_over(spark, folder):
    import os

    spark.range(20).write.parquet(f"{folder}/cfg.1")
    os.makedirs(f"{folder}/cfg.2")
    assert RefreshingTable(spark, folder, "cfg.").current().count() == 20


def test_a_batch_goes_on_with_the_snapshot_before(spark, folder):
    import shutil

    for name in ("1", "2"):
        spark.range(20).select(F.col("id").alias("k"), F.lit(name).alias("v")).write.parquet(f"{folder}/side/cfg.{name}")
    spark.range(3).select(F.col("id").alias("k")).coalesce(1).write.parquet(folder + "/in")
    side = RefreshingTable(spark, folder + "/side", "cfg.")
    side.ring.append(next(p for p in snapshots.list_snapshots(spark, folder + "/side", "cfg.") if p.endswith("1")))
    read = side.current

    def vanishing():
        table = read()
        if side.path.endswith("2"):
            shutil.rmtree(f"{folder}/side/cfg.2", ignore_errors=True)
        return table

    side.current = vanishing
    run_with_side_table(log_stream(spark, "parquet", "k bigint", path=folder + "/in"), side, ["k"], folder + "/out", folder + "/ck")
    assert {r.v for r in spark.read.parquet(folder + "/out").collect()} == {"1"}


def test_other_errors_are_not_swallowed(spark, folder):
    spark.range(20).select(F.col("id").alias("k")).write.parquet(f"{folder}/side/cfg.1")
    spark.range(3).select(F.col("id").alias("k")).coalesce(1).write.parquet(folder + "/in")
    side = RefreshingTable(spark, folder + "/side", "cfg.")
    with pytest.raises(Exception, match="other"):
        run_with_side_table(log_stream(spark, "parquet", "k bigint", path=folder + "/in"), side, ["other"], folder + "/out",
                            folder + "/ck")


def test_each_batch_sees_the_newest_side_table(spark, folder):
    def feed(n):
        spark.range(n, n + 3).select(F.col("id").alias("k")).coalesce(1).write.mode("append").parquet(folder + "/in")

    def put(name):
        spark.range(20).select(F.col("id").alias("k"), F.lit(name).alias("v")).write.parquet(f"{folder}/side/cfg.{name}")

    put("1")
    feed(0)
    side = RefreshingTable(spark, folder + "/side", "cfg.")

    def run():
        stream = log_stream(spark, "parquet", "k bigint", path=folder + "/in")
        run_with_side_table(stream, side, ["k"], folder + "/out", folder + "/ck")

    run()
    put("2")
    feed(3)
    run()
    got = {(r.k, r.v) for r in spark.read.parquet(folder + "/out").collect()}
    assert got == {(0, "1"), (1, "1"), (2, "1"), (3, "2"), (4, "2"), (5, "2")}


def test_hourly_outputs_replace_only_their_slots(spark, folder):
    rows = spark.createDataFrame([("h1", 1, "a"), ("h1", 2, "b"), ("h2", 5, "c"), ("h2", 0, "d")], "slot string, id_type int, cid string")
    sinks.write_hourly(sinks.hourly_kinds(rows), folder + "/o", "slot")
    sinks.write_hourly(sinks.hourly_kinds(rows.where("slot = 'h1'").withColumn("cid", F.upper("cid"))), folder + "/o", "slot")
    got = {(r.slot, r.kind, r.cid) for r in spark.read.parquet(folder + "/o").collect()}
    assert got == {("h1", "agsid", "A"), ("h1", "channelid", "B"), ("h2", "channelid", "d")}
    with pytest.raises(ValueError):
        sinks.compact(spark, folder + "/o", folder + "/o/", ["slot"])


def test_cells(spark):
    wide = spark.createDataFrame([("r1", "x", "7"), ("r2", None, "bad")], "k string, a string, counter string")
    table = cells.cells_from_wide(wide, "k", "cf", ["a", "counter"], F.lit(1))
    newer = cells.cells_from_wide(wide.select("k", F.lit("new").alias("a")), "k", "cf", ["a"], F.lit(1))
    merged = cells.upsert_cells(table, newer)
    lines = {r.line for r in cells.lookup_cells(spark.createDataFrame([("r1",), ("r1",), ("r2",), ("r3",)], "row_key string"), merged).collect()}
    assert lines == {"r1:(a,new)(counter,7)", "r2:(a,new)(counter,)"}
    assert cells.scan_cells(table, columns=[("cf", "a")]).count() == 1
    assert cells.scan_cells(table).count() == 3


def test_one_scan_of_several_types_and_channels(spark, log_table):
    df = logs.scan_display(spark, log_table, ["show", "cm"], ["adx", "tanx"], ["2024-01-01", "2024-01-02"])
    assert df.count() == 8
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(ValueError):
        logs.scan_display(spark, log_table, ["show", "pv"], "adx", "2024-01-01")
