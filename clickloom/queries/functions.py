"""Scalar functions F1 to F9."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import (
    affinity,
    after_last,
    before,
    compact_id_decode,
    compact_id_encode,
    epoch_minute,
    join_sorted_distinct,
    md5_hex,
    md5_signed64,
)
from clickloom.functions import times
from clickloom.queries.registry import SQL_HOUR, query, sql_code, sql_md5, sql_minute, ts_text


@query("fn_md5_hex", "SELECT c_custkey, upper(md5(c_name)) AS h FROM customer")
def _(t):
    return t.customer.select("c_custkey", md5_hex(F.col("c_name")).alias("h"))


@query("fn_md5_signed64", f"SELECT c_custkey, {sql_md5('c_name')} AS h FROM customer")
def _(t):
    return t.customer.select("c_custkey", md5_signed64(F.col("c_name")).alias("h"))


@query("fn_compact_id", f"""
WITH h AS (SELECT c_custkey, {sql_md5('c_name')} AS h FROM customer)
SELECT c_custkey, {sql_code('h')} AS code, h AS decoded FROM h""")
def _(t):
    coded = t.customer.select("c_custkey", compact_id_encode(md5_signed64(F.col("c_name"))).alias("code"))
    return coded.withColumn("decoded", compact_id_decode(F.col("code")))


@query("fn_epoch_minute", f"""
SELECT event_id, {sql_minute('ts')} AS minute FROM events WHERE event_type <> 'error'""")
def _(t):
    broken = F.concat(F.lit("at "), ts_text())
    time = F.when(F.col("event_type") == "error", broken).otherwise(ts_text())
    return t.events.select("event_id", epoch_minute(time).alias("minute")).where(F.col("minute").isNotNull())


@query("fn_hour_arithmetic", f"""
SELECT {SQL_HOUR} AS hour, strftime(min(ts) - INTERVAL 1 HOUR, '%Y-%m-%d-%H') AS prev_hour,
       strftime(min(ts) - INTERVAL 1 DAY, '%Y-%m-%d') AS prev_day,
       CAST(epoch(date_trunc('day', min(ts)) - INTERVAL 15 DAY) AS BIGINT) // 60 AS floor_minute,
       count(*) AS events
FROM events GROUP BY 1""")
def _(t):
    return t.events.groupBy(times.hour_key(F.col("ts")).alias("hour")).agg(
        times.previous_hour_key(F.min("ts")).alias("prev_hour"),
        times.previous_day_key(F.min("ts")).alias("prev_day"),
        times.history_floor_minute(F.min("ts"), 15).alias("floor_minute"),
        F.count("*").alias("events"),
    )


@query("fn_string_tools", """
SELECT page_id, split_part(url, '?', 1) AS bare, regexp_extract(url, '[^/]*$') AS tail,
       reverse(url) AS reversed, replace(url, 'example', 'sample') AS replaced,
       trim(substr(url, 8, 12)) AS piece, contains(url, 'page=') AS paged
FROM pages""")
def _(t):
    url = F.col("url")
    return t.pages.select(
        "page_id", before(url, "?").alias("bare"), after_last(url, "/").alias("tail"),
        F.reverse(url).alias("reversed"), F.replace(url, F.lit("example"), F.lit("sample")).alias("replaced"),
        F.trim(F.substring(url, 8, 12)).alias("piece"), url.contains("page=").alias("paged"),
    )


@query("fn_array_tools", """
SELECT page_id, array_to_string(list_sort(list_distinct(string_split(url, '/'))), ',') AS parts,
       array_to_string(string_split(url, '/')[1:3], '/') AS site, len(string_split(url, '/')) AS n
FROM pages""")
def _(t):
    pieces = F.split("url", "/")
    return t.pages.select(
        "page_id", join_sorted_distinct(pieces, ",").alias("parts"),
        F.array_join(F.slice(pieces, 1, 3), "/").alias("site"), F.size(pieces).cast("bigint").alias("n"),
    )


@query("fn_log_weight", """
WITH s AS (SELECT l_suppkey, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS total,
                  count(DISTINCT l_partkey) AS degree FROM lineitem GROUP BY 1)
SELECT l_suppkey, round(CAST(n AS DOUBLE) / CAST(total AS DOUBLE) * ln(2147483647.0::DOUBLE / degree), 6) AS weight FROM s""")
def _(t):
    lines = t.lineitem.select("l_suppkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("q"))
    # Two steps instead of a distinct count next to plain sums.
    parts = lines.groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"), F.sum("q").alias("q"))
    sums = parts.groupBy("l_suppkey").agg(
        F.sum("n").alias("n"), F.sum("q").alias("total"), F.count("*").alias("degree")
    )
    return sums.select(
        "l_suppkey", F.round(affinity(F.col("n"), F.col("total"), F.col("degree")), 6).alias("weight")
    )
