"""Baskets, co-occurrence, recommenders, site clusters: A19, A20, J10, W2 to W4, G7 to G11."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import baskets
from clickloom.plans import recommend, sessions, sites
from clickloom.queries.registry import SQL_DAY, SQL_K, day_text, prop_k, query, sql_components, sql_md5, text
from clickloom.session import store_in_small_tasks

# Thresholds lowered to the fixture's densities.
_WEIGHT, _DEGREE, _SCORE = 12, 4, 0.05


def _baskets_sql(basket: str, item: str, source: str, low: int, high: int) -> str:
    """CTEs i (distinct basket, item of fitting baskets) and pairs (basket, item_a, item_b)."""
    return f"""
d AS (SELECT DISTINCT {basket} AS basket, {item} AS item FROM {source}),
k AS (SELECT basket FROM d GROUP BY 1 HAVING count(*) BETWEEN {low} AND {high}),
i AS (SELECT d.* FROM d SEMI JOIN k USING (basket)),
pairs AS (SELECT a.basket, a.item AS item_a, b.item AS item_b FROM i a JOIN i b ON a.basket = b.basket AND a.item < b.item)"""


@query("item_support", f"""
WITH {_baskets_sql('l_orderkey', 'l_partkey', 'lineitem', 2, 7)}
SELECT item, count(*) AS support FROM i GROUP BY 1""")
def _(t):
    return baskets.item_support(baskets.bounded_baskets(t.lineitem, ["l_orderkey"], "l_partkey", 2, 7))


@query("pair_counts", f"""
WITH {_baskets_sql('l_orderkey', 'l_suppkey', 'lineitem', 2, 7)}
SELECT item_a, item_b, count(*) AS n FROM pairs GROUP BY 1, 2""")
def _(t):
    return store_in_small_tasks(baskets.pair_counts(baskets.item_pairs(t.lineitem, ["l_orderkey"], "l_suppkey", 2, 7)))


_VISITS_SQL = f"v AS (SELECT user_id, {SQL_DAY} AS day, {SQL_K} AS site FROM events)"


def _visits(t):
    return t.events.select("user_id", day_text().alias("day"), prop_k().alias("site"))


@query("site_cooccurrence", f"""
WITH {_VISITS_SQL}, {_baskets_sql("day || '/' || user_id", 'site', 'v', 2, 24)}
SELECT substr(basket, 1, 10) AS day, item_a, item_b, count(*) AS n FROM pairs GROUP BY 1, 2, 3""")
def _(t):
    return sites.site_pairs(_visits(t), "user_id", "site", keys=["day"])


@query("multi_day_pair_sums", f"""
WITH {_VISITS_SQL}, {_baskets_sql("day || '/' || user_id", 'site', 'v', 2, 24)}
SELECT item_a, item_b, count(*) AS n FROM pairs GROUP BY 1, 2""")
def _(t):
    from clickloom.session import cut_lineage

    # Saved per day, then summed over the days.
    saved = cut_lineage(sites.site_pairs(_visits(t), "user_id", "site", keys=["day"]))
    return baskets.accumulate_pairs(saved.drop("day"))


_SCORED_SQL = f"""
{_baskets_sql('l_orderkey', 'l_suppkey', 'lineitem', 2, 24)},
c AS (SELECT item_a, item_b, count(*) AS n FROM pairs GROUP BY 1, 2 HAVING count(*) > {_WEIGHT}),
dir AS (SELECT item_a AS node, item_b AS neighbour, n FROM c UNION ALL SELECT item_b, item_a, n FROM c),
nodes AS (SELECT node, CAST(sum(n) AS BIGINT) AS total, count(*) AS degree FROM dir GROUP BY 1 HAVING count(*) > {_DEGREE}),
scored AS (SELECT dir.node, dir.neighbour, dir.n,
   round(CAST(n AS DOUBLE) / coalesce(CAST(b.total AS DOUBLE), 2147483647.0::DOUBLE)
         * ln(2147483647.0::DOUBLE / coalesce(CAST(b.degree AS DOUBLE), 2147483647.0::DOUBLE)), 6) AS score
   FROM dir SEMI JOIN nodes a ON a.node = dir.node LEFT JOIN nodes b ON b.node = dir.neighbour),
best AS (SELECT node, neighbour, n, score FROM (
   SELECT *, row_number() OVER (PARTITION BY node ORDER BY score DESC, neighbour) AS r FROM scored) WHERE r = 1 AND score > {_SCORE})"""


def _supplier_pairs(t):
    return baskets.pair_counts(baskets.item_pairs(t.lineitem, ["l_orderkey"], "l_suppkey"))


def _best(t):
    return sites.best_neighbours(sites.scored_neighbours(_supplier_pairs(t), _WEIGHT, _DEGREE), _SCORE)


@query("scored_site_neighbours", f"WITH {_SCORED_SQL} SELECT * FROM scored")
def _(t):
    return sites.scored_neighbours(_supplier_pairs(t), _WEIGHT, _DEGREE)


@query("best_site_neighbours", f"WITH {_SCORED_SQL} SELECT * FROM best")
def _(t):
    return _best(t)


_CLUSTERS_SQL = f"""
WITH RECURSIVE {_SCORED_SQL},
links AS (SELECT DISTINCT {sql_md5('CAST(node AS VARCHAR)')} AS src, {sql_md5('CAST(neighbour AS VARCHAR)')} AS dst FROM best),
{sql_components('links')},
names AS (SELECT DISTINCT s FROM (SELECT node AS s FROM best UNION ALL SELECT neighbour FROM best)),
cl AS (SELECT s AS site, component AS cluster FROM names JOIN links_cc ON node = {sql_md5('CAST(s AS VARCHAR)')})"""


@query("site_clusters", _CLUSTERS_SQL + " SELECT * FROM cl")
def _(t):
    return sites.site_clusters(_best(t))


@query("largest_site_clusters", _CLUSTERS_SQL + """
SELECT cluster, count(*) AS members FROM cl GROUP BY 1 ORDER BY members DESC, cluster LIMIT 50""")
def _(t):
    return sites.cluster_sizes(sites.site_clusters(_best(t)))


@query("site_cluster_lines", _CLUSTERS_SQL + """
SELECT cluster, 0 AS part, string_agg(CAST(site AS VARCHAR), ',' ORDER BY CAST(site AS VARCHAR)) AS members FROM cl GROUP BY 1""")
def _(t):
    return sites.cluster_lines(sites.site_clusters(_best(t)))


_GROUP_SQL = f"""
WITH v AS (SELECT strftime(o_orderdate, '%Y-%m-%d') || '/' || o_custkey || '/' || p_brand AS basket, p_brand, l_suppkey % 50 AS item
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
g AS (SELECT DISTINCT basket, p_brand FROM v),
{_baskets_sql('basket', 'item', 'v', 2, 10)},
c AS (SELECT p_brand AS grp, item_a, item_b, count(*) AS n FROM pairs JOIN g USING (basket) GROUP BY 1, 2, 3)"""

_GROUP_TOP_SQL = _GROUP_SQL + """,
online AS (SELECT DISTINCT p_brand || '_' || p_size AS id FROM part),
ok AS (SELECT * FROM c WHERE grp || '_' || item_a IN (SELECT id FROM online) AND grp || '_' || item_b IN (SELECT id FROM online)),
dir AS (SELECT grp, item_a AS node, item_b AS neighbour, n FROM ok UNION ALL SELECT grp, item_b, item_a, n FROM ok),
top AS (SELECT grp, node, neighbour, n, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY grp, node ORDER BY n DESC, neighbour) AS r FROM dir) WHERE r <= 5)"""


def _group_views(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", (F.col("l_suppkey") % 50).alias("item"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
                             F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("grp"))
    return lines.join(orders, "l_orderkey").join(parts, "l_partkey").select("day", "o_custkey", "grp", "item")


def _online(t):
    return t.part.select(F.concat_ws("_", "p_brand", text("p_size")).alias("id"))


def _group_top(t):
    counts = recommend.group_pair_counts(_group_views(t), "day", "o_custkey", "grp", "item")
    return recommend.group_recommendations(counts, _online(t), "grp", "id")


@query("group_pair_counts", _GROUP_SQL + " SELECT * FROM c")
def _(t):
    return recommend.group_pair_counts(_group_views(t), "day", "o_custkey", "grp", "item")


@query("group_recommender", _GROUP_TOP_SQL + " SELECT * FROM top")
def _(t):
    return _group_top(t)


@query("group_recommender_lines", _GROUP_TOP_SQL + """
SELECT grp || '_' || node || ',' || string_agg(CAST(neighbour AS VARCHAR), ',' ORDER BY rank) AS ids_line,
       grp || '_' || node || ',' || string_agg('(' || grp || ',' || neighbour || ',' || n || ')', ',' ORDER BY rank) AS detail_line
FROM top GROUP BY grp, node""")
def _(t):
    return recommend.group_lines(_group_top(t), "grp")


_CONFIDENCE_SQL = f"""
WITH v AS (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25)),
{_baskets_sql('l_orderkey', 'l_partkey', 'v', 2, 7)},
s AS (SELECT item, count(*) AS support FROM i GROUP BY 1),
c AS (SELECT item_a, item_b, count(*) AS n FROM pairs GROUP BY 1, 2),
dir AS (SELECT item_a AS node, item_b AS neighbour, n FROM c UNION ALL SELECT item_b, item_a, n FROM c),
cf AS (SELECT node, neighbour, n, round(CAST(n AS DOUBLE) / support, 6) AS confidence FROM dir JOIN s ON item = neighbour),
top AS (SELECT node, neighbour, n, confidence, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY node ORDER BY confidence DESC, neighbour) AS r FROM cf) WHERE r <= 10)"""


def _confidence(t):
    views = t.lineitem.select(F.lit("all").alias("day"), "l_orderkey", "l_partkey")
    return recommend.confidence_recommendations(
        views, "day", "l_orderkey", "l_partkey", t.part.where("p_size <= 25"), "p_partkey")


@query("confidence_recommender", _CONFIDENCE_SQL + " SELECT * FROM top")
def _(t):
    return _confidence(t)


@query("confidence_recommender_lines", _CONFIDENCE_SQL + """
SELECT node || ',' || string_agg(CAST(neighbour AS VARCHAR), ',' ORDER BY rank) AS line FROM top GROUP BY node""")
def _(t):
    return recommend.confidence_lines(_confidence(t))


@query("session_summary", f"""
WITH e AS (SELECT user_id || '-' || {SQL_DAY} AS visit, event_type, CAST({SQL_K} AS INTEGER) AS k FROM events),
u AS (SELECT visit, count(*) AS hits, count(*) FILTER (event_type = 'click') AS weight FROM e GROUP BY 1 HAVING count(*) > 1),
p AS (SELECT DISTINCT visit, k || '|' || n_name AS p FROM e JOIN nation ON n_nationkey = k WHERE event_type = 'view')
SELECT u.visit, hits, weight, 0 AS part, coalesce(string_agg(p, ';' ORDER BY p), '') AS products
FROM u LEFT JOIN p USING (visit) GROUP BY 1, 2, 3""")
def _(t):
    url = F.concat(F.lit("http://www.shop.test"), F.when(
        F.col("event_type") == "view", F.concat(F.lit("/ticket-"), prop_k(), F.lit(".html"))
    ).when(F.col("event_type") == "click", "/pay/1").otherwise("/help"))
    from clickloom.operators.classify import ticket_page_item

    views = t.events.select(F.concat_ws("-", text("user_id"), day_text()).alias("visit"), url.alias("url"))
    names = t.nation.select(text("n_nationkey").alias("product"), F.col("n_name").alias("name"))
    return sessions.session_summary(views, "visit", "url", ticket_page_item(F.col("url"), "shop.test"), names)
