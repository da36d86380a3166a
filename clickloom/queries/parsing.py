"""Log loading and classification P1 to P22.

Lines are rendered from the columns of a table and loaded back, so the SQL
side reads the original columns and every parse is really tested.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import none_marker
from clickloom.operators import classify, loglines, pricing, rules, useragent
from clickloom.queries.registry import SQL_K, SQL_TS, prop_k, query, text, ts_text


def _lines(t, *parts, keep=("event_id",)):
    """Event lines: text pieces and columns, one after the other."""
    pieces = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return t.events.select(*keep, F.concat(*pieces).alias("value"))


def _is(*kinds):
    return F.col("event_type").isin(*kinds)


@query("load_kv", f"""
SELECT event_id, {SQL_TS} AS time, CAST(user_id AS VARCHAR) AS a, {SQL_K} AS dup, '1=2' AS x,
       CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS b, NULL AS bare, true AS has_bare
FROM events""")
def _(t):
    lines = _lines(
        t, ts_text(), "|~|skipped first piece=1|~|a=", text("user_id"), "||dup=old|~|bare||time=never||x=1=2||b=",
        F.when(_is("view"), "null").otherwise(F.col("event_type")), "||dup=", prop_k(), "|~||~|",
    )
    # The piece in front of the first separator is the time; the next one is kept.
    loaded = loglines.load_kv(lines)
    has_bare = F.array_contains(F.map_keys("fields"), "bare").alias("has_bare")
    picked = loglines.pick_fields(loaded.withColumn("has_bare", has_bare), ("time", "a", "dup", "x", "b", "bare"))
    return picked


@query("load_query_string", f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS u, {SQL_K} AS k, 'x=y' AS d, NULL AS b, CAST(4 AS BIGINT) AS n
FROM events""")
def _(t):
    lines = _lines(t, "u=", text("user_id"), "&=3&c&b=&d=x=y&k=0&k=", prop_k())
    loaded = lines.withColumn("fields", loglines.query_map(F.col("value")))
    loaded = loaded.withColumn("n", F.size(F.map_keys("fields")).cast("bigint"))
    return loglines.pick_fields(loaded, ("u", "k", "d", "b"))


_FALLBACK_SQL = f"""
SELECT event_id, {SQL_TS} AS time,
       CASE event_type WHEN 'view' THEN 's' || user_id WHEN 'click' THEN 'cook' || user_id
            WHEN 'signup' THEN 'cook' || user_id ELSE NULL END AS agsid,
       CASE event_type WHEN 'view' THEN 'g' || {SQL_K} WHEN 'error' THEN NULL ELSE 'q' || {SQL_K} END AS guid
FROM events"""


def _fallback_lines(t, address_key):
    agsid = F.when(_is("view"), F.concat(F.lit("||agsid=s"), text("user_id"))).when(
        _is("click"), F.lit("||agsid=null")).otherwise(F.lit(""))
    cookie = F.when(_is("click", "signup"), F.concat(F.lit("||cookie=a=b; agsid=cook"), text("user_id"), F.lit(";z=1"))).when(
        _is("purchase"), F.lit("||cookie=agsid=ab")).otherwise(F.lit("||cookie=null"))
    guid = F.when(_is("view"), F.concat(F.lit("||guid=g"), prop_k())).otherwise(F.lit(""))
    address = F.concat(
        F.lit(f"||{address_key}=http://ad.test/notice?reqid=1&guid="),
        F.when(_is("error"), F.lit("")).otherwise(F.concat(F.lit("q"), prop_k())), F.lit("&z=2"))
    return _lines(t, ts_text(), "|~|Request: src=X||req=1", agsid, cookie, guid, address)


@query("load_show_log", _FALLBACK_SQL)
def _(t):
    return loglines.load_show(_fallback_lines(t, "requestUrl"), ("time", "guid", "agsid"))


@query("load_click_log", _FALLBACK_SQL)
def _(t):
    return loglines.load_click(_fallback_lines(t, "refurl"), ("time", "guid", "agsid"))


@query("load_cookie_match_log", f"""
SELECT event_id, {SQL_TS} AS time, event_type AS ssp, CASE WHEN event_type = 'error' THEN NULL ELSE {SQL_K} END AS guid,
       CAST(user_id AS VARCHAR) AS agsid FROM events""")
def _(t):
    key = F.when(_is("error"), F.lit("Matching Cookie: none")).otherwise(F.lit("Matching XX Cookie: google_gid"))
    lines = _lines(t, ts_text(), "|~|", key, "=", prop_k(), "||agsid=", text("user_id"), "||ssp=", F.col("event_type"))
    return loglines.load_cookie_match(lines, ("time", "ssp", "guid", "agsid"))


@query("load_bid_log", f"""
SELECT event_id, 't' || user_id AS "Threadid", CASE WHEN event_type = 'view' THEN NULL ELSE {SQL_K} || '=z' END AS "reqId",
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS guid,
       CASE WHEN event_type = 'click' THEN 'a' || user_id ELSE NULL END AS agsid, 'in' AS ptime FROM events""")
def _(t):
    req = F.when(_is("view"), F.lit(",reqId=,1")).otherwise(F.concat(F.lit(",reqId="), prop_k(), F.lit("=z,1,0")))
    lines = _lines(
        t, ts_text(), "|~|Threadid=t", text("user_id"), req, ",ptime=in|~|ptime=out|~|userId=",
        F.when(_is("error"), F.lit("null")).otherwise(text("user_id")),
        F.when(_is("click"), F.concat(F.lit("|~|agUserId=a"), text("user_id"))).otherwise(F.lit("")),
    )
    return loglines.load_bid(lines, ("Threadid", "reqId", "guid", "agsid", "ptime"))


def _view_lines(t):
    """New layout for views and clicks, old layout for errors, short lines otherwise."""
    new = F.concat(
        ts_text(), F.lit("|~|1.1.1.1\ts"), text("user_id"), F.lit("\ttid\thttp://x.test/?ag_mid=1\tq="), prop_k(),
        F.lit("&ag_kwid=2\tUA"))
    old = F.concat(
        ts_text(), F.lit("|~|1.1.1.1|~|c|~|e|~|s"), text("user_id"),
        F.lit("|~|1|~|2|~|3|~|4|~|tid|~|http://x.test/|~|-|~|q="), prop_k(), F.lit("|~|UA|~|cr|~|kw"))
    short = F.concat(ts_text(), F.lit("\t1.1.1.1\tcust\tev\ts"), text("user_id"), F.lit("\t\t\t"))
    value = F.when(_is("view", "click"), new).when(_is("error"), old).otherwise(short)
    return t.events.select("event_id", value.alias("value"))


@query("load_page_views", f"""
SELECT event_id, {SQL_TS} AS time, 's' || user_id AS agsid,
       CASE WHEN event_type IN ('view', 'click') THEN 'http://x.test/?ag_mid=1' WHEN event_type = 'error' THEN 'http://x.test/' END AS url,
       CASE WHEN event_type = 'error' THEN 'kw' END AS keyword, CASE WHEN event_type IN ('view', 'click', 'error') THEN {SQL_K} END AS q
FROM events""")
def _(t):
    return loglines.load_page_views(_view_lines(t), ("time", "agsid", "url", "keyword", "q"), parse_query=True)


@query("route_page_views", """
SELECT event_id FROM events WHERE event_type IN ('view', 'click', 'error')""")
def _(t):
    return loglines.route_page_views(_view_lines(t)).select("event_id")


@query("null_normalised_fields", f"""
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE {SQL_K} END AS a,
       CASE WHEN event_type IN ('view', 'click') THEN 'null' ELSE {SQL_K} END AS marked FROM events""")
def _(t):
    raw = F.when(_is("view"), "").when(_is("click"), "null").otherwise(prop_k())
    loaded = loglines.load_kv(_lines(t, ts_text(), "|~|x=1||a=", raw, "||z=1"))
    picked = loglines.pick_fields(loaded, ("a",))
    return picked.withColumn("marked", none_marker(F.col("a")))


@query("line_filters", """
SELECT page_id, url FROM pages
WHERE contains(url, 'example') AND (contains(url, '/en/') OR contains(url, '/fr/')) AND starts_with(url, 'https')
  AND NOT contains(url, 'spam')""")
def _(t):
    pages = t.pages.select("page_id", "url")
    return classify.line_filter(pages, "url", ["example"], ["/en/", "/fr/"], ["spam"], ["https"])


@query("campaign_match", r"""
SELECT page_id, regexp_matches(url, '[^0-9]7[^0-9]?') AS loose, regexp_matches(url, '[^0-9]76([^0-9]|$)') AS exact
FROM pages""")
def _(t):
    url = F.col("url")
    return t.pages.select(
        "page_id", classify.matches_campaign(url, "7").alias("loose"),
        classify.matches_campaign(url, "76", strict=True).alias("exact"))


@query("keyword_tags", """
WITH d AS (SELECT source, CASE WHEN contains(text, 'thin') THEN 'B' ELSE 'A' END AS tag FROM documents
           WHERE contains(text, 'thre') OR contains(text, 'onen')),
g AS (SELECT DISTINCT source, tag || '@240101' AS tag FROM d)
SELECT source, string_agg(tag, ';' ORDER BY tag) AS tags FROM g GROUP BY 1""")
def _(t):
    return classify.keyword_tags(t.documents, "source", "text", ["thre", "onen"], ["thin"], "A", "B", "240101")


_SITE = "shop.test"
_PATHS = ("", "s/x", "ticket-9.html", "ab", "customer/reg.html", "help/1", "shopCart/a", "integral/", "subject/1",
          "common/ticket.html", "news/1", "venue/1", "cart/2", "pay/3", "security", "personorders/myorder.html", "zzz/1")
_TYPES = ("head", "search", "product", "area", "reg", "help", "shopcart", "integral", "subject", "ticket", "news",
          "venue", "cart", "pay", "security", "order", "unkown")


@query("page_types", f"""
SELECT page_id, CASE WHEN contains(url, 'utm_') THEN 'login' WHEN contains(url, '#top') THEN 'citiccard'
       ELSE {list(_TYPES)}[page_id % {len(_TYPES)} + 1] END AS page_type FROM pages""")
def _(t):
    path = F.element_at(F.array(*[F.lit(p) for p in _PATHS]), (F.col("page_id") % len(_PATHS) + 1).cast("int"))
    tail = F.regexp_extract("url", r"/(\d+)[^/]*/?$", 1)
    url = F.when(F.col("url").contains("utm_"), F.concat(F.lit(f"http://login.{_SITE}/login?x="), tail)).when(
        F.col("url").contains("#top"), F.concat(F.lit(f"http://citiccard.{_SITE}/"), tail)
    ).otherwise(F.concat(F.lit(f"http://www.{_SITE}/"), path))
    return t.pages.select("page_id", classify.page_type(url, classify.shop_page_rules(_SITE)).alias("page_type"))


# One rule for each order: an exact address, or a prefix of one to four digits of the order's number on its
# host; and one length limit for each region. Ranks are scattered, and repeat beyond sf0.01.
_RANK_SQL = "(o_orderkey * 7919) % 100003"


@query("page_types_by_table", f"""
WITH r AS (
  SELECT {_RANK_SQL} AS rank, CASE WHEN o_orderkey % 5 = 0 THEN 'equals' ELSE 'prefix' END AS kind,
         'http://h' || o_custkey % 40 || '.test/' AS root, CAST(o_orderkey AS VARCHAR) AS n, 'r' || o_orderkey AS label,
         o_orderkey % 4 + 1 AS digits FROM orders),
t AS (SELECT rank, kind, root, root || CASE kind WHEN 'equals' THEN n || '-1' ELSE substr(n, 1, digits) END AS text, label FROM r),
a AS (SELECT l_orderkey, l_linenumber, 'http://h' || l_suppkey % 40 || '.test/' AS root,
             'http://h' || l_suppkey % 40 || '.test/' || l_orderkey || '-' || l_linenumber AS url FROM lineitem),
d AS (SELECT DISTINCT root, url FROM a),
hits AS (
  SELECT url, rank, label FROM d JOIN t USING (root) WHERE kind = 'equals' AND url = text OR kind = 'prefix' AND starts_with(url, text)
  UNION ALL SELECT url, 40000 + r_regionkey, 'short' || r_regionkey FROM d JOIN region ON length(url) < 17 + r_regionkey),
best AS (SELECT url, min(struct_pack(rank := rank, label := label)).label AS label FROM hits GROUP BY 1)
SELECT l_orderkey, l_linenumber, coalesce(label, 'none') AS page_type FROM a LEFT JOIN best USING (url)""")
def _(t):
    """As many rules as orders, matched without an expression for any of them."""
    number, root = text("o_orderkey"), F.concat(F.lit("http://h"), (F.col("o_custkey") % 40).cast("string"), F.lit(".test/"))
    exact = F.col("o_orderkey") % 5 == 0
    of_orders = t.orders.select(
        (F.col("o_orderkey") * 7919 % 100003).cast("long").alias("rank"), F.when(exact, "equals").otherwise("prefix").alias("kind"),
        F.concat(root, F.when(exact, F.concat(number, F.lit("-1"))).otherwise(
            F.substr(number, F.lit(1), (F.col("o_orderkey") % 4 + 1).cast("int")))).alias("text"),
        F.lit(0).alias("length"), F.concat(F.lit("r"), number).alias("label"))
    of_regions = t.region.select(
        (F.col("r_regionkey") + 40000).cast("long").alias("rank"), F.lit("shorter").alias("kind"), F.lit("").alias("text"),
        (F.col("r_regionkey") + 17).cast("int").alias("length"), F.concat(F.lit("short"), text("r_regionkey")).alias("label"))
    urls = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(
        F.lit("http://h"), (F.col("l_suppkey") % 40).cast("string"), F.lit(".test/"), text("l_orderkey"), F.lit("-"),
        text("l_linenumber")).alias("url"))
    typed = rules.first_rule(urls, "url", of_orders.unionByName(of_regions), "page_type", "none")
    return typed.select("l_orderkey", "l_linenumber", "page_type")


@query("keyword_tags_by_table", """
WITH w AS (SELECT DISTINCT n_nationkey AS rank, lower(substr(n_name, 1, 2)) AS word, 'R' || n_regionkey AS tag,
                  n_regionkey <> 3 AS admits FROM nation),
hits AS (SELECT doc_id, bool_or(admits) AS admitted, min(struct_pack(rank := rank, tag := tag)).tag AS tag
         FROM documents JOIN w ON contains(text, word) GROUP BY 1),
g AS (SELECT DISTINCT source, tag || '@240101' AS tag FROM hits JOIN documents USING (doc_id) WHERE admitted)
SELECT source, string_agg(tag, ';' ORDER BY tag) AS tags FROM g WHERE source IS NOT NULL GROUP BY 1""")
def _(t):
    """Words out of a table, whole texts."""
    words = t.nation.select(
        F.col("n_nationkey").cast("long").alias("rank"), F.lower(F.substring("n_name", 1, 2)).alias("word"),
        F.concat(F.lit("R"), text("n_regionkey")).alias("tag"), (F.col("n_regionkey") != 3).alias("admits"))
    return rules.keyword_tags_by_table(t.documents, "source", "text", words, "240101").select("source", "tags")


_HOST_SQL = (
    "lower(regexp_replace(regexp_replace(url, '^https?://', ''), "
    r"'/.*$|\?.*$|:.*$', ''))"
)


@query("registrable_domains", f"""
SELECT page_id, {_HOST_SQL} AS host, nullif(regexp_extract({_HOST_SQL}, '{classify.REGISTRABLE}', 1), '') AS domain
FROM pages""")
def _(t):
    url = F.col("url")
    return t.pages.select("page_id", classify.host(url).alias("host"), classify.registrable_domain(url).alias("domain"))


@query("product_ids", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE split_part(url, '/', 4) || '_' || page_id END AS hotel,
       CAST(page_id AS VARCHAR) AS ticket, CASE WHEN page_id % 2 = 0 THEN CAST(page_id AS VARCHAR) END AS ticket_page
FROM pages""")
def _(t):
    lang = F.get(F.split("url", "/"), F.lit(3))
    hotel = F.concat(
        F.lit("http%3A%2F%2Fh.test%2Fcity%2F"), lang, F.lit("%2Fdt-"), text("page_id"),
        F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.lit("%2F")))
    ticket = F.concat(
        F.when(F.col("page_id") % 2 == 0, F.lit(f"http://www.{_SITE}/")).otherwise(F.lit("http://other.test/")),
        F.lit("ticket-"), text("page_id"), F.lit(".html"))
    return t.pages.select(
        "page_id", classify.city_hotel_item(hotel).alias("hotel"), classify.ticket_item(ticket).alias("ticket"),
        classify.ticket_page_item(ticket, _SITE).alias("ticket_page"))


_TAG_MARK = "T_9_SEEN_"


@query("unpack_tag_export", f"""
SELECT CASE WHEN event_type = 'click' THEN 'no_time' ELSE strftime(ts, '%y%m%d') END AS day,
       'u' || user_id AS aguid, 'city_' || {SQL_K} AS item, count(*) AS n
FROM events WHERE event_type <> 'error' GROUP BY 1, 2, 3""")
def _(t):
    body = F.when(_is("error"), F.lit("single")).otherwise(F.concat(F.lit("city_"), prop_k()))
    at = F.when(_is("click"), F.lit("")).otherwise(F.concat(F.lit("@"), F.date_format("ts", "yyMMddHH")))
    lines = _lines(
        t, '{"other":["M","', f"{_TAG_MARK}", body, "_2015-06-20_%AB", at, '","X"],"aguid":"u', text("user_id"), '","z":1}')
    return loglines.unpack_tag_export(lines, _TAG_MARK).groupBy("day", "aguid", "item").agg(F.count("*").alias("n"))


@query("tag_list_values", f"""
WITH e AS (SELECT event_id, {SQL_K} AS k, event_type FROM events)
SELECT event_id, 'All' AS value FROM e UNION ALL SELECT event_id, k FROM e WHERE event_type = 'view'
UNION ALL SELECT event_id, 'z' || k FROM e WHERE event_type = 'view'""")
def _(t):
    tags = F.when(_is("view"), F.concat(
        F.lit('["{X:DI_1,V:'), prop_k(), F.lit(',T:1}","plain","{X:DI_2,V:z'), prop_k(), F.lit('}"]'.replace("}", ",}"))
    )).when(_is("click"), F.lit("[]")).otherwise(F.lit('["{X:OTHER,V:1,}"]'))
    return t.events.select("event_id", F.explode(loglines.tag_values(tags)).alias("value"))


@query("relabel_codes", """
WITH e AS (SELECT 'ch_' || event_type AS stem, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, event_id % 5 = 0 AS every
           FROM events)
SELECT stem || '_' || CASE WHEN every THEN 'All' ELSE n_name END AS key, count(*) AS n
FROM e LEFT JOIN nation ON n_nationkey = k WHERE every OR n_name IS NOT NULL GROUP BY 1""")
def _(t):
    code = F.when(F.col("event_id") % 5 == 0, F.lit("All")).otherwise(prop_k())
    rows = t.events.select(F.concat(F.lit("ch_"), F.col("event_type"), F.lit("_"), code).alias("key"))
    names = t.nation.select(text("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    return classify.relabel_codes(rows, "key", names).groupBy("key").agg(F.count("*").alias("n"))


@query("export_pairs", """
SELECT 'u' || c_custkey AS id, c_mktsegment AS val FROM customer
UNION ALL SELECT 'n' || c_nationkey, 'u' || c_custkey FROM customer WHERE c_nationkey <> 0
UNION ALL SELECT c_name, 'u' || c_custkey FROM customer WHERE c_acctbal > 0""")
def _(t):
    wide = t.customer.select(
        F.concat(F.lit("u"), text("c_custkey")).alias("aguid"), F.col("c_mktsegment").alias("tag"),
        F.when(F.col("c_nationkey") != 0, F.concat(F.lit("n"), text("c_nationkey"))).otherwise("").alias("a"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("b"))
    return classify.export_pairs(wide, "aguid", "tag", ["a", "b"])


@query("channel_codes", """
WITH r AS (SELECT event_id, CASE event_type WHEN 'view' THEN '0' WHEN 'click' THEN '1' WHEN 'signup' THEN '3' ELSE '9' END AS st,
  CASE WHEN event_id % 2 = 0 THEN repeat('x', 30) ELSE '' END || user_id AS cid FROM events)
SELECT event_id, CASE st WHEN '0' THEN 2 WHEN '1' THEN 3 WHEN '3' THEN 4 ELSE 1 END AS channel,
       CASE WHEN st = '1' AND length(cid) > 32 THEN md5(cid) ELSE cid END AS channel_id FROM r""")
def _(t):
    send = F.when(_is("view"), "0").when(_is("click"), "1").when(_is("signup"), "3").otherwise("9")
    long_id = F.when(F.col("event_id") % 2 == 0, F.lit("x" * 30)).otherwise(F.lit(""))
    rows = t.events.select("event_id", send.alias("send_type"), F.concat(long_id, text("user_id")).alias("channel_id"))
    return classify.channel_ids(rows).select("event_id", "channel", "channel_id")


# Invented user agents whose version numbers come from the table, with what is in them as SQL:
# browser, browser version, kernel, kernel version, system, system version, hardware.
_K = SQL_K
_AGENTS = (
    ("Fox/1.0 (Windows NT 6.1; x9) AppleWebKit/41.7 (like Gecko) Chrome/{k}.0.1 Safari/41.7",
     "'Chrome'", _K, "'Gecko'", "''", "'Windows 7'", "'6.1'", "''"),
    ("Sample/4 (compatible; MSIE {k}.0; Windows NT 5.1)", "'MSIE'", _K, "''", "''", "'Windows XP'", "'5.1'", "''"),
    ("UCWEB/2.4 (Linux; U; Adr {k}.7.6; xx; pad Q9) end",
     "'UCWEB'", "'2'", "''", "''", "'Android'", f"{_K} || '.7'", "'pad Q9'"),
    ("Sample/5 (Windows NT 6.3; Trident/9.1; rv:{k}.2) like Gecko",
     "'MSIE'", _K, "'Gecko'", "''", "'Windows 8'", "'6.3'", "''"),
    ("Sample/6 (xx; Mac OS X (desk; OS 7_2) Presto/{k}.5 Safari/{k}.4",
     "'Safari'", _K, "'Presto'", f"{_K} || '.5'", "'Mac OS X'", "'7_2'", "'desk'"),
    ("curl/{k}", "''", "''", "''", "''", "''", "''", "''"),
)


def _sql_agent(i):
    return f"[{', '.join(a[i] for a in _AGENTS)}][event_id % {len(_AGENTS)} + 1]"


@query("user_agent_columns", f"""
SELECT event_id, {", ".join(f"{_sql_agent(i + 1)} AS {c}" for i, c in enumerate(useragent.UA_COLUMNS))} FROM events""")
def _(t):
    return useragent.with_user_agent(_agents(t)).select("event_id", *useragent.UA_COLUMNS)


def _agents(t):
    shapes = F.array(*[F.lit(a[0]) for a in _AGENTS])
    shape = F.element_at(shapes, (F.col("event_id") % len(_AGENTS) + 1).cast("int"))
    return t.events.select("event_id", "user_id", F.replace(shape, F.lit("{k}"), prop_k()).alias("ua"))


@query("user_agent_report", f"""
SELECT {_sql_agent(1)} AS browser, {_sql_agent(5)} AS os, count(DISTINCT user_id) AS users, count(*) AS hits
FROM events GROUP BY 1, 2""")
def _(t):
    return useragent.browser_report(_agents(t), "ua", "user_id")


@query("ad_cost_rollup", """
WITH l AS (SELECT l_suppkey, CAST(floor(l_extendedprice) AS BIGINT) AS win, CAST(round(l_tax * 100) AS INTEGER) AS markup,
                  CAST(l_quantity AS BIGINT) * 1000000 AS base, l_linenumber AS factor FROM lineitem),
c AS (SELECT l_suppkey, CAST(floor(win * (1 + markup / 100.0::DOUBLE) + 0.5) AS BIGINT) AS internal, base * factor // 1000 AS unit FROM l)
SELECT l_suppkey, count(*) AS hits, CAST(sum(internal) AS BIGINT) AS internal_cost,
       CAST(sum(least(internal, unit)) AS BIGINT) AS cost FROM c GROUP BY 1""")
def _(t):
    rows = t.lineitem.select(
        "l_suppkey", F.floor("l_extendedprice").alias("win"), F.round(F.col("l_tax") * 100).cast("int").alias("markup"),
        (F.col("l_quantity").cast("bigint") * 1000000).alias("base"), F.col("l_linenumber").alias("factor"))
    return pricing.cost_rollup(rows, ["l_suppkey"])
