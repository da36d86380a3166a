"""Reports: A1 to A13, A18, A21, set operators U1 to U4, sorted outputs O1 to O3."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import classify, counters, metrics, rendering, sets, user_sets
from clickloom.queries.registry import SQL_DAY, SQL_HOUR, SQL_K, day_text, prop_k, query, text
from clickloom.session import cut_lineage
from clickloom.functions.times import hour_key

# Campaign text of an event: names the campaign number in some of three fields.
_CAMPAIGN = "7"


@query("uv_pv_by_type", """
SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS hits FROM events GROUP BY 1""")
def _(t):
    return metrics.uv_pv(t.events, ["event_type"], "user_id")


@query("report_uv_pv_by_day_sorted", f"""
SELECT {SQL_DAY} AS day, event_type, count(DISTINCT user_id) AS users, count(*) AS hits
FROM events GROUP BY 1, 2 ORDER BY 1, 2""")
def _(t):
    daily = metrics.uv_pv(t.events.withColumn("day", day_text()), ["day", "event_type"], "user_id")
    return metrics.report_rows(daily, ["day", "event_type"])


@query("tag_flag_uv_pv", f"""
WITH f AS (
  SELECT user_id, event_type <> 'error' AS tag, event_type IN ('view', 'click') AS newtag FROM events
), u AS (
  SELECT user_id, count(*) AS n, count(*) FILTER (tag) AS nt, count(*) FILTER (newtag) AS nn FROM f GROUP BY 1
)
SELECT 'all' AS flag, count(*) AS users, CAST(sum(n) AS BIGINT) AS hits FROM u
UNION ALL SELECT 'tag', count(*) FILTER (nt > 0), CAST(sum(nt) AS BIGINT) FROM u
UNION ALL SELECT 'newtag', count(*) FILTER (nn > 0), CAST(sum(nn) AS BIGINT) FROM u""")
def _(t):
    new = F.concat(F.lit('["R_'), prop_k(), F.lit('","{X:DI_1,V:'), prop_k(), F.lit(',}"]'))
    old = F.concat(F.lit('["R_'), prop_k(), F.lit('@160101"]'))
    tags = F.when(F.col("event_type") == "error", "[]").when(
        F.col("event_type").isin("view", "click"), new).otherwise(old)
    return metrics.tag_flags(t.events.withColumn("tags", tags), "tags", "user_id")


@query("tag_value_uv_pv", f"""
WITH e AS (SELECT user_id, event_type, {SQL_K} AS k FROM events),
v AS (SELECT user_id, 'All' AS value FROM e
      UNION ALL SELECT user_id, 'v' || k FROM e WHERE event_type IN ('view', 'click'))
SELECT value, count(DISTINCT user_id) AS users, count(*) AS hits FROM v GROUP BY 1""")
def _(t):
    from clickloom.operators.loglines import tag_values

    marked = F.concat(F.lit('["R_1@2","{X:DI_1,V:v'), prop_k(), F.lit(',T:9}"]'))
    plain = F.concat(F.lit('["R_'), prop_k(), F.lit('","M"]'))
    tags = F.when(F.col("event_type").isin("view", "click"), marked).otherwise(plain)
    return metrics.exploded_uv_pv(t.events.withColumn("tags", tags), tag_values(F.col("tags")), "user_id")


@query("campaign_funnel_kpi", f"""
WITH e AS (SELECT user_id, event_type, {SQL_K} AS k FROM events),
f AS (
  SELECT user_id, 'usertag' AS field FROM e WHERE starts_with(k, '{_CAMPAIGN}')
  UNION ALL SELECT user_id, 'hittag' FROM e WHERE starts_with(k, '{_CAMPAIGN}') AND event_type = 'view'
  UNION ALL SELECT user_id, 'bidtag' FROM e WHERE k = '{_CAMPAIGN}' AND event_type = 'click')
SELECT field, count(DISTINCT user_id) AS users, count(*) AS hits FROM f GROUP BY 1""")
def _(t):
    named = F.concat(F.lit("R_"), prop_k(), F.lit("@1"))
    rows = t.events.withColumn("usertags", named).withColumn(
        "hittags", F.when(F.col("event_type") == "view", named)
    ).withColumn("bidtag", F.when((F.col("event_type") == "click") & (prop_k() == _CAMPAIGN), named))
    fields = {"usertag": "usertags", "hittag": "hittags", "bidtag": "bidtag"}
    return metrics.campaign_funnel(rows, "user_id", fields, _CAMPAIGN)


@query("show_click_kpi", """
WITH s AS (SELECT l_orderkey AS req, l_suppkey AS u FROM lineitem),
c AS (SELECT l_orderkey AS req, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
j AS (SELECT s.u, coalesce(c.n, 0) AS n FROM s LEFT JOIN c USING (req))
SELECT 'show' AS kind, count(DISTINCT u) AS users, count(*) AS hits FROM j
UNION ALL SELECT 'click', count(DISTINCT u) FILTER (n > 0), CAST(sum(n) AS BIGINT) FROM j""")
def _(t):
    shows = t.lineitem.select(F.col("l_orderkey").alias("req"), F.col("l_suppkey").alias("u"))
    clicks = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("req"))
    return metrics.show_click_kpi(shows, clicks, "req", "u")


@query("landing_bounce_kpi", f"""
WITH v AS (SELECT user_id || '-' || {SQL_DAY} AS visit, event_type = 'click' AS ag FROM events),
u AS (SELECT visit, count(*) AS n, count(*) FILTER (ag) AS a FROM v GROUP BY 1)
SELECT 'ag' AS kind, count(*) FILTER (a > 0) AS users, CAST(sum(a) AS BIGINT) AS hits FROM u
UNION ALL SELECT 'all', count(*), CAST(sum(n) AS BIGINT) FROM u
UNION ALL SELECT 'all_bounce', count(*), count(*) FROM u WHERE n = 1
UNION ALL SELECT 'ag_bounce', count(*), count(*) FROM u WHERE n = 1 AND a = 1""")
def _(t):
    visits = t.events.withColumn("visit", F.concat_ws("-", text("user_id"), day_text()))
    return metrics.landing_bounce_kpi(visits, "visit", F.col("event_type") == "click")


@query("hits_per_user_ranking", """
SELECT l_suppkey AS slot, count(DISTINCT l_orderkey) AS users, count(*) AS hits,
       count(*) // count(DISTINCT l_orderkey) AS ratio
FROM lineitem GROUP BY 1 ORDER BY ratio DESC, slot LIMIT 100""")
def _(t):
    return metrics.hits_per_user_ranking(
        t.lineitem.select(F.col("l_suppkey").alias("slot"), "l_orderkey"), "slot", "l_orderkey")


@query("conflicting_ids", f"""
WITH e AS (SELECT event_type AS ssp, {SQL_K} AS guid, user_id FROM events),
g AS (SELECT ssp, guid FROM e GROUP BY 1, 2 HAVING count(DISTINCT user_id) > 1),
w AS (SELECT e.* FROM e SEMI JOIN g USING (ssp, guid)),
r AS (SELECT ssp, 'All' AS kind, user_id FROM e UNION ALL SELECT 'allssp', 'All', user_id FROM e
      UNION ALL SELECT ssp, 'wrong', user_id FROM w UNION ALL SELECT 'allssp', 'wrong', user_id FROM w)
SELECT ssp, kind, count(DISTINCT user_id) AS cookies FROM r GROUP BY 1, 2""")
def _(t):
    rows = t.events.select(F.col("event_type").alias("ssp"), prop_k().alias("guid"), "user_id")
    return metrics.conflicting_ids(rows, "ssp", "guid", "user_id")


_DOMAIN_SQL = (
    "nullif(regexp_extract(lower(regexp_replace(regexp_replace(url, '^https?://', ''), "
    r"'/.*$|\?.*$|:.*$', '')), "
    f"'{classify.REGISTRABLE}', 1), '')"
)


@query("domain_uv_pv", f"""
WITH p AS (SELECT {_DOMAIN_SQL} AS domain, split_part(url, '/', 4) AS u, contains(url, '?') AS ad FROM pages),
g AS (SELECT domain, u, count(*) AS n, count(*) FILTER (ad) AS a FROM p GROUP BY 1, 2)
SELECT domain, CAST(sum(a) AS BIGINT) AS ad_hits, count(*) FILTER (a > 0) AS ad_users,
       CAST(sum(n) AS BIGINT) AS hits, count(*) AS users FROM g GROUP BY 1""")
def _(t):
    pages = t.pages.select(
        classify.registrable_domain(F.col("url")).alias("domain"),
        F.get(F.split("url", "/"), F.lit(3)).alias("u"), F.col("url").contains("?").alias("ad"),
    )
    return metrics.domain_uv_pv(pages, "domain", "u", F.col("ad"))


@query("id_type_combinations", """
WITH i AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
c AS (SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), '|' ORDER BY l_linenumber) AS combination
      FROM i GROUP BY 1)
SELECT combination, count(*) AS users FROM c GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM c""")
def _(t):
    return metrics.id_type_combinations(t.lineitem, "l_orderkey", "l_linenumber")


_ORDER_SUPPLIERS_SQL = "o AS (SELECT DISTINCT l_orderkey AS o, l_suppkey AS s FROM lineitem)"


@query("degree_histogram", f"""
WITH {_ORDER_SUPPLIERS_SQL},
p AS (SELECT DISTINCT x.o AS a, x.s AS b FROM o x),
e AS (SELECT 'o' || a AS node, b FROM p UNION ALL SELECT 's' || b, a FROM p),
d AS (SELECT node, count(*) AS degree FROM e GROUP BY 1)
SELECT CASE WHEN degree < 10 THEN '0-9' WHEN degree < 20 THEN '10-19' WHEN degree < 50 THEN '20-49'
            WHEN degree < 100 THEN '50-99' WHEN degree < 200 THEN '100-199' WHEN degree < 500 THEN '200-499'
            WHEN degree < 1000 THEN '500-999' WHEN degree < 2000 THEN '1000-1999' ELSE 'else' END AS bucket,
       count(*) AS nodes
FROM d GROUP BY 1""")
def _(t):
    pairs = t.lineitem.select(
        F.concat(F.lit("o"), text("l_orderkey")).alias("a"), F.concat(F.lit("s"), text("l_suppkey")).alias("b"))
    return metrics.degree_histogram(pairs, "a", "b")


@query("adjacency_lines", """
WITH p AS (SELECT 'o' || l_orderkey AS a, 's' || l_suppkey AS b, count(*) AS n FROM lineitem GROUP BY 1, 2),
e AS (SELECT a AS node, b || ':' || n AS v FROM p UNION ALL SELECT b, a || ':' || n FROM p)
SELECT node, 0 AS part, node || ',' || string_agg(v, ',' ORDER BY v) AS line FROM e GROUP BY 1""")
def _(t):
    pairs = t.lineitem.select(
        F.concat(F.lit("o"), text("l_orderkey")).alias("a"), F.concat(F.lit("s"), text("l_suppkey")).alias("b"),
        F.lit(1).alias("n"))
    return metrics.adjacency_lines(pairs, "a", "b", "n")


@query("category_histogram", """
WITH e AS (SELECT user_id, CASE WHEN value < 0.5 THEN NULL ELSE event_type || CAST(user_id % 7 AS VARCHAR) END AS kind FROM events),
c AS (SELECT user_id, kind || ':' || count(*) AS v FROM e GROUP BY user_id, kind)
SELECT user_id, 0 AS part, coalesce(string_agg(v, ' ' ORDER BY v), '') AS histogram FROM c GROUP BY 1""")
def _(t):
    """Categories that no list names, some of them missing."""
    kind = F.when(F.col("value") >= 0.5, F.concat("event_type", (F.col("user_id") % 7).cast("string")))
    return metrics.category_histogram(t.events.withColumn("kind", kind), "user_id", "kind")


def _state_entries(t):
    return t.orders.select(
        text("o_custkey").alias("id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("").alias("send_type"),
        (F.col("o_orderkey") % 5 - 1).cast("int").alias("send_num"),
        F.floor("o_totalprice").cast("int").alias("num"), F.date_format("o_orderdate", "yyyy-MM").alias("time"),
    )


_STATE_SQL = """
WITH e AS (SELECT CAST(o_custkey AS VARCHAR) AS id, nullif(o_orderstatus, 'P') AS ty, o_orderkey % 5 - 1 AS sn,
                  CAST(floor(o_totalprice) AS INTEGER) AS num, strftime(o_orderdate, '%Y-%m') AS time FROM orders),
s AS (SELECT id, coalesce(max(ty), '') AS send_type, coalesce(max(sn) FILTER (sn > 0), 0) AS send_num,
             max(time) AS newest FROM e GROUP BY 1),
m AS (SELECT id, time, max(num) AS num FROM e GROUP BY 1, 2),
j AS (SELECT s.id, send_type, send_num, newest, time, num FROM m JOIN s USING (id))"""


@query("counter_state_merge", _STATE_SQL + " SELECT id, send_type, send_num, time, num FROM j")
def _(t):
    return counters.merge_counters(_state_entries(t))


@query("counter_state_drop_newest", _STATE_SQL + """
SELECT id, send_type, send_num, time, num FROM j WHERE time < newest""")
def _(t):
    return counters.merge_counters(_state_entries(t), drop_newest=True)


@query("counter_state_lists", _STATE_SQL + """
SELECT id, send_type, send_num, 0 AS part, string_agg(time || '=' || num, ',' ORDER BY time DESC) AS sends
FROM j GROUP BY 1, 2, 3""")
def _(t):
    states = counters.counter_states(counters.merge_counters(_state_entries(t)))
    shown = F.transform("sends", lambda s: F.concat_ws("=", s["time"], s["num"].cast("string")))
    return states.withColumn("sends", F.array_join(shown, ","))


@query("counter_state_parts", _STATE_SQL + """
, r AS (SELECT *, (row_number() OVER (PARTITION BY id ORDER BY time DESC) - 1) // 3 AS part FROM j)
SELECT id, send_type, send_num, CAST(part AS INTEGER) AS part, string_agg(time || '=' || num, ',' ORDER BY time DESC) AS sends
FROM r GROUP BY 1, 2, 3, 4""")
def _(t):
    """Three sends to a part: newest first over all parts of an id."""
    states = counters.counter_states(counters.merge_counters(_state_entries(t)), part_rows=3)
    shown = F.transform("sends", lambda s: F.concat_ws("=", s["time"], s["num"].cast("string")))
    return states.withColumn("sends", F.array_join(shown, ","))


@query("distinct_users_by_day", f"""
SELECT {SQL_DAY} AS day, count(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def _(t):
    return metrics.distinct_users(t.events.withColumn("day", day_text()), ["day"], "user_id")


@query("top_slots_by_hits", f"""
SELECT {SQL_HOUR} AS hour, count(*) AS hits FROM events GROUP BY 1 ORDER BY hits DESC, hour LIMIT 50""")
def _(t):
    hits = t.events.groupBy(hour_key(F.col("ts")).alias("hour")).agg(F.count("*").alias("hits"))
    return metrics.top_rows(hits, [F.desc("hits"), F.asc("hour")], 50)


@query("ordered_collection_lines", """
SELECT o_custkey AS id, 0 AS part,
       string_agg(strftime(o_orderdate, '%Y-%m-%d') || '|' || o_orderkey, ','
                  ORDER BY strftime(o_orderdate, '%Y-%m-%d') || '|' || o_orderkey DESC) AS line
FROM orders GROUP BY 1""")
def _(t):
    entry = F.concat_ws("|", F.date_format("o_orderdate", "yyyy-MM-dd"), text("o_orderkey"))
    rows = t.orders.select(F.col("o_custkey").alias("id"), entry.alias("v"))
    return rendering.text_parts(rows, ["id"], F.col("v"), ",", descending=True)


@query("ordered_collection_parts", """
WITH v AS (SELECT l_suppkey AS id, l_returnflag || CAST(l_quantity AS INTEGER) AS v FROM lineitem),
r AS (SELECT *, (row_number() OVER (PARTITION BY id ORDER BY v) - 1) // 7 AS part FROM v)
SELECT id, CAST(part AS INTEGER) AS part, string_agg(v, ',' ORDER BY v) AS line FROM r GROUP BY 1, 2""")
def _(t):
    """Seven values to a part, with copies of one value on both sides of a cut."""
    value = F.concat("l_returnflag", F.col("l_quantity").cast("int").cast("string"))
    rows = t.lineitem.select(F.col("l_suppkey").alias("id"), value.alias("v"))
    return rendering.text_parts(rows, ["id"], F.col("v"), ",", part_rows=7)


@query("union_of_logs", """
SELECT source, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM (
  SELECT 'lines' AS source, l_orderkey AS k FROM lineitem UNION ALL SELECT 'orders', o_orderkey FROM orders
  UNION ALL SELECT 'events', event_id FROM events) GROUP BY 1""")
def _(t):
    logs = sets.union_labelled({
        "lines": t.lineitem.select(F.col("l_orderkey").alias("k")),
        "orders": t.orders.select(F.col("o_orderkey").alias("k")),
        "events": t.events.select(F.col("event_id").alias("k")),
    }, "source")
    return logs.groupBy("source").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("union_of_results", """
SELECT 'type' AS report, event_type AS key, count(DISTINCT user_id) AS users, count(*) AS hits FROM events GROUP BY 2
UNION ALL SELECT 'flag', l_returnflag, count(DISTINCT l_suppkey), count(*) FROM lineitem GROUP BY 2""")
def _(t):
    by_type = metrics.uv_pv(t.events.withColumnRenamed("event_type", "key"), ["key"], "user_id")
    by_flag = metrics.uv_pv(t.lineitem.withColumnRenamed("l_returnflag", "key"), ["key"], "l_suppkey")
    return sets.union_labelled({"type": by_type, "flag": by_flag}, "report")


@query("day_overlap", f"""
WITH d AS (SELECT DISTINCT {SQL_DAY} AS day, user_id FROM events),
b AS (SELECT user_id FROM d WHERE day = '2024-01-16')
SELECT day, count(*) AS users, count(b.user_id) AS overlap FROM d LEFT JOIN b USING (user_id) GROUP BY 1""")
def _(t):
    return metrics.day_overlap(t.events.withColumn("day", day_text()), "day", "user_id", "2024-01-16")


@query("union_distinct_counts", """
WITH a AS (SELECT DISTINCT user_id || '-' || regexp_extract(props, '[0-9]+') AS u FROM events WHERE event_type = 'view'),
b AS (SELECT DISTINCT user_id || '-' || regexp_extract(props, '[0-9]+') AS u FROM events WHERE event_type = 'click')
SELECT (SELECT count(*) FROM a) AS first_users, (SELECT count(*) FROM b) AS second_users,
       (SELECT count(*) FROM (SELECT u FROM a UNION SELECT u FROM b)) AS union_users""")
def _(t):
    rows = t.events.withColumn("u", F.concat_ws("-", text("user_id"), prop_k()))
    return metrics.union_distinct_counts(
        rows.where("event_type = 'view'"), rows.where("event_type = 'click'"), "u")


def _user_bitmaps(t):
    """Stored once: one bitmap row per day and 32,768 users."""
    seen = t.events.select(day_text().alias("day"), "user_id")
    numbers = cut_lineage(user_sets.user_numbers(seen, "user_id"))
    return cut_lineage(user_sets.user_bitmaps(seen, ["day"], "user_id", numbers))


@query("user_set_unions", f"""
WITH d AS (SELECT {SQL_DAY} AS day, user_id FROM events),
w AS (SELECT day, user_id, substr(day, 1, 7) AS days FROM d UNION ALL SELECT day, user_id, 'all' FROM d
      UNION ALL SELECT day, user_id, day FROM d)
SELECT days, count(DISTINCT user_id) AS users FROM w GROUP BY 1""")
def _(t):
    """Users of each day, of each month, and of all days, from the stored bitmaps alone."""
    sets = _user_bitmaps(t).withColumn("days", F.explode(F.array("day", F.substring("day", 1, 7), F.lit("all"))))
    return user_sets.union_counts(sets, ["days"])


@query("user_set_overlap", f"""
WITH d AS (SELECT DISTINCT {SQL_DAY} AS day, user_id FROM events WHERE user_id IS NOT NULL)
SELECT day, count(*) AS users, count(*) FILTER (user_id IN (SELECT user_id FROM d WHERE day = '2024-01-16')) AS overlap
FROM d GROUP BY 1""")
def _(t):
    return user_sets.overlap_counts(_user_bitmaps(t), "day", "2024-01-16")
