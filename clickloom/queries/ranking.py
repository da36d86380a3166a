"""Keep-best and size-guard operators A14 to A17, rankings W1 and W5."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import dedupe, skew
from clickloom.plans import identity
from clickloom.queries.registry import query, sql_md5, sql_minute, text


def _orders(t):
    return t.orders.select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey", "o_orderstatus")


def _keep_one(direction: str) -> str:
    return f"""
SELECT o_custkey, day, o_orderkey, o_orderstatus FROM (
  SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey, o_orderstatus, row_number() OVER (
    PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y-%m-%d') {direction}, o_orderkey {direction},
    o_orderstatus {direction}) AS r
  FROM orders) WHERE r = 1"""


@query("latest_wins", _keep_one("DESC"))
def _(t):
    return dedupe.latest(_orders(t), ["o_custkey"], "day")


@query("earliest_wins", _keep_one("ASC"))
def _(t):
    return dedupe.earliest(_orders(t), ["o_custkey"], "day")


def _records(t):
    """Identity records: cid = part, uid = order, type = line number."""
    cid = F.concat(F.lit("p"), text("l_partkey"))
    from clickloom.functions import epoch_minute, md5_signed64

    return t.lineitem.select(
        md5_signed64(cid).alias("cid_hash"), F.col("l_orderkey").alias("uid"), cid.alias("cid"),
        F.col("l_linenumber").alias("id_type"),
        epoch_minute(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("minute"), F.lit(1).cast("bigint").alias("num"),
    )


_RECORDS_SQL = f"""
WITH r AS (SELECT {sql_md5("'p' || l_partkey")} AS cid_hash, l_orderkey AS uid, 'p' || l_partkey AS cid,
                  l_linenumber AS id_type, {sql_minute('l_shipdate')} AS minute, CAST(1 AS BIGINT) AS num FROM lineitem)"""


@query("identity_record_merge", _RECORDS_SQL + """
SELECT cid_hash, arg_min(uid, (minute, uid)) AS uid, max(cid) AS cid, arg_max(id_type, (minute, id_type)) AS id_type,
       max(minute) AS minute, CAST(sum(num) AS BIGINT) AS num
FROM r GROUP BY 1""")
def _(t):
    return identity.merge_records(_records(t))


@query("uid_sightings", _RECORDS_SQL + """
SELECT cid_hash, uid, min(minute) AS minute FROM r GROUP BY 1, 2""")
def _(t):
    return identity.uid_sightings(_records(t))


@query("group_size_guard", """
WITH g AS (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 15)
SELECT o_custkey, count(*) AS n, max(o_orderkey) AS last FROM orders ANTI JOIN g USING (o_custkey) GROUP BY 1""")
def _(t):
    kept = skew.drop_oversized(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], 15)
    return kept.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last"))


@query("recent_per_group", """
WITH r AS (SELECT l_suppkey AS uid, l_linenumber AS id_type, 'l' || l_orderkey || '-' || l_partkey AS cid,
                  CAST(floor(epoch(l_shipdate) / 60) AS BIGINT) AS minute FROM lineitem)
SELECT uid, id_type, cid, minute FROM (
  SELECT *, row_number() OVER (PARTITION BY uid, id_type ORDER BY minute DESC, cid DESC) AS rn FROM r)
WHERE rn <= 50""")
def _(t):
    from clickloom.functions import epoch_minute

    rows = t.lineitem.select(
        F.col("l_suppkey").alias("uid"), F.col("l_linenumber").alias("id_type"),
        F.concat(F.lit("l"), text("l_orderkey"), F.lit("-"), text("l_partkey")).alias("cid"),
        epoch_minute(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("minute"),
    )
    return dedupe.recent_per_group(rows)


@query("oldest_member", """
SELECT o_custkey AS component, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS oldest,
       strftime(min(o_orderdate), '%Y-%m-%d') AS oldest_time, count(*) AS n_rows
FROM orders GROUP BY 1""")
def _(t):
    rows = t.orders.select(F.col("o_custkey").alias("component"), F.col("o_orderkey").alias("member"),
                           F.date_format("o_orderdate", "yyyy-MM-dd").alias("time"))
    return dedupe.oldest_per_group(rows, "component", "member", "time")
