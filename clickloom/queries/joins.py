"""Join operators J1 to J10."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import baskets, joins, loglines
from clickloom.queries.registry import query, text

_AGENTS = ("Chrome", "Firefox", "Safari")
_CHANNELS = ("baidu", "tanx", "agx")


def _pick(names, number):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number % len(names) + 1).cast("int"))


def _sql_pick(names, number):
    return "[" + ", ".join(f"'{n}'" for n in names) + f"][{number} % {len(names)} + 1]"


def _stitch_lines(t):
    """Show, click and bid log lines made of the order tables."""
    time = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    channel = F.concat(F.lit("||ssp="), _pick(_CHANNELS, F.col("l_orderkey")))
    show = t.lineitem.select(F.concat(
        time, F.lit("|~|AdShowRequest: src=X||adxreq=r"), text("l_orderkey"), F.lit("||ua="),
        _pick(_AGENTS, F.col("l_suppkey")), F.lit("||agsid=s"), text("l_partkey"), channel).alias("value"))
    click = t.lineitem.where("l_returnflag = 'R'").select(F.concat(
        time, F.lit("|~|Click: x=1||reqid=r"), text("l_orderkey"), F.lit("||agsid=null"), channel).alias("value"))
    bid = t.orders.select(F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("|~|Threadid=1,reqId="),
        F.when(F.col("o_orderpriority") == "5-LOW", "null").otherwise(F.concat(F.lit("r"), text("o_orderkey"))),
        F.lit("|~|userId=u"), text("o_custkey"), F.lit("||ssp="), _pick(_CHANNELS, F.col("o_orderkey")),
    ).alias("value"))
    return show, click, bid


@query("stitch_show_click_bid", f"""
WITH s AS (SELECT l_orderkey AS k, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS time,
                  {_sql_pick(_AGENTS, 'l_suppkey')} AS ua, 's' || l_partkey AS agsid FROM lineitem),
sh AS (SELECT k, min((time, ua, agsid)) AS m FROM s GROUP BY 1),
c AS (SELECT l_orderkey AS k, min(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')) AS ct FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY 1),
b AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '|~|Threadid=1,reqId=r' || o_orderkey
             || '|~|userId=u' || o_custkey || '||ssp=' || {_sql_pick(_CHANNELS, 'o_orderkey')} AS line
      FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT {_sql_pick(_CHANNELS, 'k')} AS ssp, 'r' || k AS req, CAST(ct IS NOT NULL AS INTEGER) AS clicked,
       line || '||ua=' || struct_extract(m, 2) || '||click=' || CAST(ct IS NOT NULL AS INTEGER) || '||clicktime='
       || coalesce(ct, 'null') || '||agsid=' || struct_extract(m, 3) AS out_line
FROM sh JOIN b USING (k) LEFT JOIN c USING (k)""")
def _(t):
    show, click, bid = _stitch_lines(t)
    shows = loglines.load_show(show, ("ssp", "adxreq", "ua", "time", "agsid")).withColumnRenamed("adxreq", "req")
    clicks = loglines.load_click(click, ("ssp", "reqid", "time")).withColumnRenamed("reqid", "req")
    bids = loglines.load_bid(bid, ("ssp", "reqId"), keep_line=True).withColumnRenamed("reqId", "req")
    stitched = joins.stitch_show_click_bid(shows, clicks.select("ssp", "req", "time"), bids.select("ssp", "req", "line"))
    return stitched.select("ssp", "req", "clicked", joins.stitched_line().alias("out_line"))


@query("left_join_default", """
SELECT o_orderkey, coalesce(n, 0) AS n FROM orders LEFT JOIN (
  SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) USING (o_orderkey)""")
def _(t):
    clicks = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n"))
    return joins.left_join_default(t.orders.select("o_orderkey"), clicks, ["o_orderkey"], "n")


@query("attach_component", """
SELECT c_custkey AS cid_hash, coalesce(m, c_custkey) AS uid FROM customer LEFT JOIN (
  SELECT o_custkey, min(o_orderkey) AS m FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def _(t):
    components = t.orders.groupBy(F.col("o_custkey").alias("node")).agg(F.min("o_orderkey").alias("component"))
    return joins.attach_component(t.customer.select(F.col("c_custkey").alias("cid_hash")), components)




@query("dataset_diff", """
WITH l AS (SELECT o_orderkey AS k, 'a' || o_custkey || '|' || 'b' || o_orderkey AS v FROM orders WHERE o_orderstatus <> 'O'),
r AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' THEN 'changed' ELSE
        'a' || o_custkey || '|' || 'b' || o_orderkey END AS v FROM orders WHERE o_orderstatus <> 'P')
SELECT k, l.v || ';c' AS left_value, r.v || ';c' AS right_value FROM l FULL JOIN r USING (k) WHERE l.v IS DISTINCT FROM r.v""")
def _(t):
    a, b = F.concat(F.lit("a"), text("o_custkey")), F.concat(F.lit("b"), text("o_orderkey"))
    # The two sides list the ids in different order and with different counters.
    left_line = F.concat(b, F.lit("|5|1,"), a, F.lit("|4|1\tc|1|1"))
    right_line = F.concat(a, F.lit("|9|3,"), b, F.lit("|8|2\tc|2|7"))
    changed = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("changed|1|1\tc|1|1")).otherwise(right_line)
    left = t.orders.where("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("k"), joins.canonical_ids(left_line).alias("v"))
    right = t.orders.where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("k"), joins.canonical_ids(changed).alias("v"))
    return joins.dataset_diff(left, right, ["k"], "v")


@query("equi_join_count", """
SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t):
    joined = joins.equi_join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")),
        t.orders.select("o_orderkey", "o_orderstatus", "o_custkey"), ["o_orderkey"])
    per = joined.groupBy("o_orderstatus", "o_custkey").agg(F.count("*").alias("n"))
    return per.groupBy("o_orderstatus").agg(F.sum("n").alias("n"), F.count("*").alias("customers"))


_TAG_ROWS_SQL = """
WITH rows AS (
  SELECT CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 1 END AS channel,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'c' || regexp_extract(props, '[0-9]+') END AS channel_id,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE 's' || user_id END AS agsid, 'T' || event_id % 7 AS tag FROM events),
cookie AS (SELECT 's' || c_custkey AS agsid, 'U' || c_nationkey || '-' || c_custkey % 7 AS uid FROM customer WHERE c_acctbal > 0),
chan AS (SELECT ch AS channel, 'c' || s_suppkey AS channel_id, 'V' || s_nationkey AS uid
         FROM supplier, (VALUES (1), (2), (3)) x(ch)),
a AS (SELECT uid, tag FROM rows JOIN cookie USING (agsid)),
p AS (SELECT * FROM rows ANTI JOIN cookie USING (agsid)),
z AS (SELECT * FROM a UNION ALL SELECT uid, tag FROM p JOIN chan USING (channel, channel_id))"""


def _tag_rows(t):
    code = F.when(F.col("event_type") == "view", 2).when(F.col("event_type") == "click", 3).when(
        F.col("event_type") == "purchase", 4).otherwise(1)
    rows = t.events.select(
        code.alias("channel"),
        F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("c"), F.get_json_object("props", "$.k"))).alias("channel_id"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("s"), text("user_id"))).alias("agsid"),
        F.concat(F.lit("T"), (F.col("event_id") % 7).cast("string")).alias("tag"),
    )
    cookies = t.customer.where("c_acctbal > 0").select(
        F.concat(F.lit("s"), text("c_custkey")).alias("agsid"),
        F.concat(F.lit("U"), text("c_nationkey"), F.lit("-"), (F.col("c_custkey") % 7).cast("string")).alias("uid"))
    channels = t.supplier.select(
        F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("channel"),
        F.concat(F.lit("c"), text("s_suppkey")).alias("channel_id"), F.concat(F.lit("V"), text("s_nationkey")).alias("uid"))
    return joins.resolve_users(rows, cookies, channels)


@query("resolve_tags_with_fallback", _TAG_ROWS_SQL + """
SELECT uid, 0 AS part, string_agg(tag, '|~|' ORDER BY tag) AS tags FROM z GROUP BY 1""")
def _(t):
    return joins.user_tag_lines(_tag_rows(t))


@query("both_members_online", """
WITH m AS (SELECT p_partkey FROM part WHERE p_size <= 25),
k AS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey) BETWEEN 2 AND 10),
i AS (SELECT l_orderkey, l_partkey FROM lineitem SEMI JOIN k USING (l_orderkey)),
p AS (SELECT DISTINCT a.l_partkey AS a, b.l_partkey AS b FROM i a JOIN i b
      ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey)
SELECT a, b FROM p WHERE a IN (SELECT * FROM m) AND b IN (SELECT * FROM m)""")
def _(t):
    pairs = baskets.item_pairs(t.lineitem, ["l_orderkey"], "l_partkey", 2, 10).select(
        F.col("item_a").alias("a"), F.col("item_b").alias("b")).distinct()
    return joins.both_members(pairs, "a", "b", t.part.where("p_size <= 25"), "p_partkey")


@query("member_filter", """
SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25) GROUP BY 1""")
def _(t):
    kept = joins.only_members(t.lineitem.select("l_partkey"), "l_partkey", t.part.where("p_size <= 25"), "p_partkey")
    return kept.groupBy("l_partkey").agg(F.count("*").alias("n"))


@query("dictionary_lookup", """
SELECT l_orderkey, l_linenumber, coalesce(p_name, CAST(l_partkey AS VARCHAR)) AS name
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON p_partkey = l_partkey""")
def _(t):
    found = joins.dictionary_lookup(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), t.part.where("p_size <= 25"),
        "l_partkey", "p_partkey", "p_name", "name", text("l_partkey"))
    return found.select("l_orderkey", "l_linenumber", "name")


@query("within_key_pairs", """
WITH i AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem),
k AS (SELECT o FROM i GROUP BY 1 HAVING count(*) BETWEEN 2 AND 24)
SELECT a.o AS l_orderkey, a.p AS item_a, b.p AS item_b FROM i a JOIN i b ON a.o = b.o AND a.p < b.p SEMI JOIN k ON a.o = k.o""")
def _(t):
    return baskets.item_pairs(t.lineitem, ["l_orderkey"], "l_partkey")
