"""Scans, snapshots, cell tables and sinks S1 to S14: written to the shared folder, read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.times import hour_key, hour_list
from clickloom.operators import counters, loglines
from clickloom.operators.classify import channel_ids
from clickloom.operators.metrics import uv_pv
from clickloom.queries.registry import SQL_DAY, SQL_HOUR, SQL_K, day_text, prop_k, query, text, ts_text
from clickloom.session import fresh_folder
from clickloom.sources import cell_table, cells, logs, sinks, snapshots

_TYPES = {"view": "show", "click": "tt", "signup": "cm", "purchase": "bidder", "error": "adshow"}
_SQL_TYPE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _TYPES.items()) + " END"
_SQL_CHANNEL = "['adx', 'baidu', 'tanx'][user_id % 3 + 1]"


def _channel():
    return F.element_at(F.array(F.lit("adx"), F.lit("baidu"), F.lit("tanx")), (F.col("user_id") % 3 + 1).cast("int"))


def _log_type():
    kind = None
    for event, name in _TYPES.items():
        test = F.col("event_type") == event
        kind = F.when(test, name) if kind is None else kind.when(test, name)
    return kind


def _written(t, value, log_type, channel=None):
    """Events as a log table in a new folder."""
    path = fresh_folder(t.spark, "logs")
    lines = t.events.select(
        log_type.alias("log_type"), (_channel() if channel is None else channel).alias("channel"),
        day_text().alias("day"), hour_key(F.col("ts")).alias("hour"), value.alias("value"))
    logs.write_log_table(lines, path)
    return path


def _hours(t):
    """Every hour from the first to the last event."""
    first, last = t.events.agg(F.min("ts"), F.max("ts")).first()
    return hour_list(f"{first:%Y-%m-%d-%H}", int((last - first).total_seconds() // 3600) + 2)


def _days(t):
    return sorted({hour[:10] for hour in _hours(t)})


def _display_value():
    return F.concat(ts_text(), F.lit("|~|Log: a=1||guid="), prop_k(), F.lit("||agsid=s"), text("user_id"))


_CHANNELS = ("adx", "baidu", "tanx")


@query("scan_display_log", f"""
SELECT {_SQL_TYPE} AS log_type, {_SQL_CHANNEL} AS channel, {SQL_DAY} AS day, count(DISTINCT user_id) AS users, count(*) AS hits
FROM events GROUP BY 1, 2, 3""")
def _(t):
    """Every type and channel, in one pruned scan."""
    path = _written(t, _display_value(), _log_type())
    days = _days(t)
    lines = logs.scan_display(t.spark, path, logs.DISPLAY_TYPES, _CHANNELS, days)
    return uv_pv(loglines.load_show(lines, ("guid", "agsid")), ["log_type", "channel", "day"], "agsid")


@query("scan_display_hours", f"""
SELECT {_SQL_CHANNEL} AS channel, {SQL_HOUR} AS hour, count(DISTINCT user_id) AS users, count(*) AS hits
FROM events WHERE event_type = 'click' AND hour(ts) BETWEEN 8 AND 11 GROUP BY 1, 2""")
def _(t):
    """Four hours of each day: the hour list prunes days and row groups."""
    path = _written(t, _display_value(), _log_type())
    hours = [f"{day}-{hour:02d}" for day in _days(t) for hour in range(8, 12)]
    lines = logs.scan_display(t.spark, path, "tt", _CHANNELS, hours)
    return uv_pv(loglines.load_show(lines, ("guid", "agsid")), ["channel", "hour"], "agsid")


@query("scan_page_view_log", f"""
SELECT CASE WHEN event_type = 'view' THEN 'pv' ELSE 'track' END AS log_type, {SQL_HOUR} AS hour,
       count(DISTINCT user_id) AS users, count(*) AS hits FROM events GROUP BY 1, 2""")
def _(t):
    value = F.concat(ts_text(), F.lit("\t1.1.1.1\ts"), text("user_id"), F.lit("\tt\thttp://x.test/\tq=1\tUA"))
    path = _written(t, value, F.when(F.col("event_type") == "view", "pv").otherwise("track"), F.lit("all"))
    days = _days(t)
    both = logs.scan_page_views(t.spark, path, "pv", days).unionByName(
        logs.scan_page_views(t.spark, path, "tracking", days))
    return uv_pv(loglines.load_page_views(both, ("agsid", "url")), ["log_type", "hour"], "agsid")


@query("scan_tag_export", f"""
SELECT CASE WHEN event_type = 'view' THEN 'all' ELSE 'inc' END AS log_type, {_SQL_CHANNEL} AS channel, 'u' || user_id AS aguid,
       'c_' || {SQL_K} AS item, strftime(ts, '%y%m%d') AS day_seen, count(*) AS n FROM events GROUP BY 1, 2, 3, 4, 5""")
def _(t):
    value = F.concat(F.lit('{"tags":["SEEN_c_'), prop_k(), F.lit("@"), F.date_format("ts", "yyMMddHH"),
                     F.lit('","M"],"aguid":"u'), text("user_id"), F.lit('"}'))
    path = _written(t, value, F.when(F.col("event_type") == "view", "all").otherwise("inc"))
    lines = logs.scan_tag_export(t.spark, path, logs.TAG_TYPES, _CHANNELS, _days(t))
    items = loglines.unpack_tag_export(lines, "SEEN_", keep=["log_type", "channel"])
    return items.groupBy("log_type", "channel", "aguid", "item", F.col("day").alias("day_seen")).agg(
        F.count("*").alias("n"))


@query("scan_realtime_tags", """
SELECT CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'signup' THEN 4 ELSE 1 END AS channel,
       'c' || regexp_extract(props, '[0-9]+') AS channel_id, count(*) AS n FROM events GROUP BY 1, 2""")
def _(t):
    send = F.when(F.col("event_type") == "view", "0").when(F.col("event_type") == "click", "1").when(
        F.col("event_type") == "signup", "3").otherwise("7")
    value = F.concat_ws("\t", send, F.concat(F.lit("c"), prop_k()), text("user_id"), F.lit("T"), ts_text())
    path = _written(t, value, F.lit(logs.REALTIME_TYPE), F.lit("all"))
    lines = logs.scan_realtime_tags(t.spark, path, _days(t))
    fields = F.split("value", "\t", -1)
    rows = lines.select(F.get(fields, F.lit(0)).alias("send_type"), F.get(fields, F.lit(1)).alias("channel_id"))
    return channel_ids(rows.drop("channel")).groupBy("channel", "channel_id").agg(F.count("*").alias("n"))


@query("scan_hour_range", f"""
SELECT {SQL_HOUR} AS hour, count(*) AS n FROM events GROUP BY 1""")
def _(t):
    """All hours of the table as one explicit list, from two source folders."""
    first = _written(t, _display_value(), F.lit("show"))
    second = fresh_folder(t.spark, "logs")
    logs.write_log_table(logs.scan_log(t.spark, first, channels=["tanx"]), second)
    hours = _hours(t)
    lines = logs.scan_hours(t.spark, [first], hours, channels=["adx", "baidu"]).unionByName(
        logs.scan_hours(t.spark, [second], hours))
    return lines.groupBy("hour").agg(F.count("*").alias("n"))


@query("newest_snapshot", "SELECT c_custkey, c_name || '-new' AS c_name FROM customer")
def _(t):
    folder = fresh_folder(t.spark, "snapshots")
    t.customer.select("c_custkey", "c_name").write.parquet(f"{folder}/state.2024-01-09-23")
    t.customer.select("c_custkey", F.concat("c_name", F.lit("-new")).alias("c_name")).write.parquet(
        f"{folder}/state.2024-01-10-07")
    t.customer.select("c_custkey", "c_name").write.parquet(f"{folder}/other.2024-01-11")
    return snapshots.read_newest(t.spark, folder, "state.")


@query("counter_state_load", """
WITH e AS (SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderstatus AS ty, o_orderkey % 5 AS sn,
                  o_orderkey % 9 AS num, strftime(o_orderdate, '%Y-%m-%d') AS time FROM orders
           UNION ALL SELECT CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderkey % 5, o_orderkey % 4,
                  strftime(o_orderdate, '%Y') FROM orders)
SELECT id, s.send_type, s.send_num, time, max(num) AS num FROM e JOIN (
  SELECT id, max(ty) AS send_type, coalesce(max(sn) FILTER (sn > 0), 0) AS send_num FROM e GROUP BY 1) s USING (id)
GROUP BY 1, 2, 3, 4""")
def _(t):
    folder = fresh_folder(t.spark, "states")
    line = F.concat(
        F.lit("("), text("o_custkey"), F.lit(",("), F.col("o_orderstatus"), F.lit(","), (F.col("o_orderkey") % 5).cast("string"),
        F.lit(",List(("), (F.col("o_orderkey") % 9).cast("string"), F.lit(","), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("), ("), (F.col("o_orderkey") % 4).cast("string"), F.lit(","), F.date_format("o_orderdate", "yyyy"), F.lit("))))"))
    t.orders.select(line.alias("value")).write.text(f"{folder}/state.20240110")
    lines = snapshots.read_newest(t.spark, folder, "state.", "text")
    return counters.merge_counters(counters.parse_counter_lines(lines))


_ORDER_FILE = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_orderpriority", T.StringType()), T.StructField("day", T.StringType())])


@query("sink_delimited_gzip", """
SELECT o_orderkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def _(t):
    path = fresh_folder(t.spark, "delimited")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority",
                           F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    sinks.write_delimited(rows, path)
    return sinks.read_delimited(t.spark, path, _ORDER_FILE)


@query("sink_hourly_outputs", f"""
SELECT {SQL_DAY} AS slot, CASE WHEN user_id % 6 = 1 THEN 'agsid' ELSE 'channelid' END AS kind, count(*) AS n
FROM events WHERE user_id % 6 <> 5 GROUP BY 1, 2""")
def _(t):
    path = fresh_folder(t.spark, "hourly")
    rows = t.events.select(day_text().alias("slot"), (F.col("user_id") % 6).alias("id_type"), prop_k().alias("cid"))
    sinks.write_hourly(sinks.hourly_kinds(rows), path, "slot")
    back = t.spark.read.option("basePath", path).schema("cid string, slot string, kind string").parquet(path)
    return back.groupBy("slot", "kind").agg(F.count("*").alias("n"))


@query("compacted_rewrite", """
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS few_files FROM orders GROUP BY 1""")
def _(t):
    source, target = fresh_folder(t.spark, "loose"), fresh_folder(t.spark, "compact")
    t.orders.select("o_orderkey", "o_orderstatus").repartition(8, "o_orderkey").write.partitionBy("o_orderstatus").parquet(source)
    sinks.compact(t.spark, source, target, ["o_orderstatus"])
    table = t.spark.read.parquet(target).withColumn("file", F.input_file_name())
    files = table.groupBy("o_orderstatus", "file").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
    return files.groupBy("o_orderstatus").agg(
        F.sum("n").alias("n"), F.sum("keys").alias("keys"), (F.count("*") <= 2).alias("few_files"))


def _cell_table(t):
    wide = t.customer.select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").alias("counter"))
    return cells.cells_from_wide(wide, "c_custkey", "cf", ["c_name", "c_mktsegment", "counter"], F.lit(1))


@query("cells_bulk_lookup", """
SELECT CAST(c_custkey AS VARCHAR) AS row_key, 0 AS part,
       c_custkey || ':(c_mktsegment,' || c_mktsegment || ')(c_name,' || c_name || ')(counter,' || c_nationkey || ')' AS line
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def _(t):
    keys = t.orders.where("o_orderstatus = 'P'").select(text("o_custkey").alias("row_key"))
    return cells.lookup_cells(keys, _cell_table(t))


_CELLS_SQL = """
c AS (SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'cf' AS family, q AS qualifier,
             CASE q WHEN 'c_name' THEN c_name WHEN 'c_mktsegment' THEN c_mktsegment ELSE CAST(c_nationkey AS VARCHAR) END AS value
      FROM customer, (VALUES ('c_name'), ('c_mktsegment'), ('counter')) x(q))"""


@query("cells_bulk_upsert", f"""
WITH {_CELLS_SQL},
n AS (SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'cf' AS family, 'c_mktsegment' AS qualifier, 'DEBT' AS value
      FROM customer WHERE c_acctbal < 0
      UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'cf', 'extra', c_name FROM customer WHERE c_acctbal < 0)
SELECT row_key, family, qualifier, coalesce(n.value, c.value) AS value,
       CASE WHEN n.value IS NULL THEN CAST(1 AS BIGINT) ELSE 2 END AS version
FROM c FULL JOIN n USING (row_key, family, qualifier)""")
def _(t):
    debt = t.customer.where("c_acctbal < 0").select(
        "c_custkey", F.lit("DEBT").alias("c_mktsegment"), F.col("c_name").alias("extra"))
    changes = cells.cells_from_wide(debt, "c_custkey", "cf", ["c_mktsegment", "extra"], F.lit(2))
    return cells.upsert_cells(_cell_table(t), changes)


@query("cells_column_scan", f"""
WITH {_CELLS_SQL} SELECT row_key, qualifier, value FROM c WHERE qualifier <> 'c_name'
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 's_name', s_name FROM supplier""")
def _(t):
    path = fresh_folder(t.spark, "cells")
    supplier = cells.cells_from_wide(t.supplier, "s_suppkey", "cs", ["s_name"], F.lit(1))
    _cell_table(t).unionByName(supplier).write.partitionBy("family").parquet(path)
    table = t.spark.read.parquet(path)
    found = cells.scan_cells(table, ["cs"], [("cf", "c_mktsegment"), ("cf", "counter")])
    return found.select("row_key", "qualifier", "value")


def _stored_cells(t):
    """The table as a first layer, two upserts, and what a compaction leaves of the first two."""
    table = cell_table.CellTable(t.spark, fresh_folder(t.spark, "cell-table"), files=8)
    table.upsert(_cell_table(t))
    debt = t.customer.where("c_acctbal < 0").select(
        "c_custkey", F.lit("DEBT").alias("c_mktsegment"), F.col("c_name").alias("extra"))
    table.upsert(cells.cells_from_wide(debt, "c_custkey", "cf", ["c_mktsegment", "extra"], F.lit(2)))
    table.compact()
    late = t.customer.where("c_nationkey = 3").select("c_custkey", F.lit("77").alias("counter"))
    # An older version does not replace a newer cell.
    table.upsert(cells.cells_from_wide(late, "c_custkey", "cf", ["counter"], F.lit(1)))
    table.upsert(cells.cells_from_wide(late.withColumn("extra", F.lit("old")), "c_custkey", "cf", ["extra"], F.lit(0)))
    return table


_STORED_CELLS_SQL = f"""{_CELLS_SQL},
n AS (SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'cf' AS family, 'c_mktsegment' AS qualifier, 'DEBT' AS value
      FROM customer WHERE c_acctbal < 0
      UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'cf', 'extra', c_name FROM customer WHERE c_acctbal < 0),
u AS (SELECT row_key, family, qualifier, coalesce(n.value, c.value) AS value,
             CASE WHEN n.value IS NULL THEN CAST(1 AS BIGINT) ELSE 2 END AS version
      FROM c FULL JOIN n USING (row_key, family, qualifier)),
l AS (SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'cf' AS family, q AS qualifier,
             CASE q WHEN 'counter' THEN '77' ELSE 'old' END AS value
      FROM customer, (VALUES ('counter'), ('extra')) x(q) WHERE c_nationkey = 3),
s AS (SELECT row_key, family, qualifier,
             CASE WHEN qualifier = 'counter' AND l.value IS NOT NULL THEN l.value ELSE coalesce(u.value, l.value) END AS value,
             coalesce(u.version, 0) AS version
      FROM u FULL JOIN l USING (row_key, family, qualifier))"""


@query("cells_layered_table", f"WITH {_STORED_CELLS_SQL} SELECT * FROM s")
def _(t):
    return _stored_cells(t).read()


@query("cells_ranged_lookup", f"""
WITH {_STORED_CELLS_SQL}
SELECT row_key, 0 AS part,
       row_key || ':' || string_agg('(' || qualifier || ',' || value || ')', '' ORDER BY '(' || qualifier || ',' || value || ')') AS line
FROM s WHERE row_key IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P') GROUP BY 1""")
def _(t):
    keys = t.orders.where("o_orderstatus = 'P'").select(text("o_custkey").alias("row_key"))
    return _stored_cells(t).lookup(keys)
