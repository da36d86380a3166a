"""Streaming T1 and T2 over the event table as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import loglines
from clickloom.operators.metrics import uv_pv
from clickloom.queries.registry import SQL_DAY, SQL_K, prop_k, query, text, ts_text
from clickloom.session import fresh_folder
from clickloom.streaming.logs import log_stream, run_available
from clickloom.streaming.side_table import RefreshingTable, run_with_side_table


def _event_stream(t):
    return log_stream(t.spark, "parquet", t.events.schema, {"pathGlobFilter": "events.parquet"}, t.folder)


@query("stream_log_lines", f"""
SELECT {SQL_DAY} AS day, event_type AS ssp, count(DISTINCT user_id) AS users, count(*) AS hits FROM events GROUP BY 1, 2""")
def _(t):
    """Lines rendered from the stream, loaded on the fly, stored, then reported."""
    line = F.concat(ts_text(), F.lit("|~|Log: a=1||agsid=s"), text("user_id"), F.lit("||ssp="), F.col("event_type"))
    loaded = loglines.load_show(_event_stream(t).select(line.alias("value")), ("time", "agsid", "ssp"))
    path, checkpoint = fresh_folder(t.spark, "stream"), fresh_folder(t.spark, "stream-state")
    run_available(loaded, path, checkpoint)
    stored = t.spark.read.parquet(path).withColumn("day", F.substring("time", 1, 10))
    return uv_pv(stored, ["day", "ssp"], "agsid")


@query("stream_refreshing_side_table", f"""
SELECT event_id, {SQL_K} AS k, n_name || '-new' AS name FROM events LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = {SQL_K}""")
def _(t):
    folder = fresh_folder(t.spark, "side")
    names = t.nation.select(text("n_nationkey").alias("k"), "n_name")
    names.select("k", F.col("n_name").alias("name")).write.parquet(f"{folder}/config.2024-01-01")
    names.select("k", F.concat("n_name", F.lit("-new")).alias("name")).write.parquet(f"{folder}/config.2024-01-02")
    side = RefreshingTable(t.spark, folder, "config.")
    path, checkpoint = fresh_folder(t.spark, "stream"), fresh_folder(t.spark, "stream-state")
    run_with_side_table(_event_stream(t).select("event_id", prop_k().alias("k")), side, ["k"], path, checkpoint)
    return t.spark.read.parquet(path).select("event_id", "k", "name")
