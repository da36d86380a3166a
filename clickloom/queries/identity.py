"""Graph and identity jobs G1 to G6, G12, G13, and the daily channel merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import compact_id_encode, epoch_minute, md5_signed64
from clickloom.functions.times import hour_key, slot_minute
from clickloom.operators.graph import connected_components
from clickloom.operators.loglines import load_page_views, load_show
from clickloom.plans import channels, extraction, identity, windows
from clickloom.queries.registry import (
    SQL_K, SQL_TS, prop_k, query, sql_code, sql_components, sql_md5, sql_minute, text, ts_text,
)
from clickloom.session import cut_lineage, fresh_folder, own_stages
from clickloom.sources.logs import write_log_table
from clickloom.sources.sinks import hourly_kinds


def _id_pairs(t):
    """Order and part-of-the-day ids of every line, and every order alone."""
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    lines = t.lineitem.select(
        F.concat(day, F.lit(" 00:00:00")).alias("time"),
        F.concat(F.lit(" o"), text("l_orderkey")).alias("id1"), F.lit("1").alias("id1_type"),
        F.concat(F.lit("p"), text("l_partkey"), F.lit("@"), day).alias("id2"), F.lit("2").alias("id2_type"))
    orders = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.concat(F.lit("o"), text("o_orderkey")).alias("id1"), F.lit("1").alias("id1_type"),
        F.lit("null").alias("id2"), F.lit("").alias("id2_type"))
    return lines.unionByName(orders)


_PAIRS_SQL = """
    pairs AS (
      SELECT l_shipdate AS ts, 'o' || l_orderkey AS id1, 'p' || l_partkey || '@' || strftime(l_shipdate, '%Y-%m-%d') AS id2
      FROM lineitem
      UNION ALL SELECT o_orderdate, 'o' || o_orderkey, NULL FROM orders)"""

def _map_sql(pairs, slot):
    return f"""{pairs},
    quads AS (SELECT strftime(ts, '{slot}') AS slot, id1, id2, max(ts) AS ts FROM pairs GROUP BY 1, 2, 3),
    ends AS (SELECT slot, ts, id1 AS cid, 1 AS id_type FROM quads
             UNION ALL SELECT slot, ts, id2, 2 FROM quads WHERE id2 IS NOT NULL),
    verts AS (SELECT slot, {sql_md5('cid')} AS cid_hash, cid, id_type, max(ts) AS ts, count(*) AS num
              FROM ends GROUP BY slot, cid, id_type),
    edges AS (SELECT DISTINCT slot, {sql_md5('id1')} AS src, {sql_md5('id2')} AS dst FROM quads WHERE id2 IS NOT NULL),
    {sql_components('edges', 'slot')},
    idmap AS (SELECT v.slot, v.cid_hash, coalesce(c.component, v.cid_hash) AS uid, v.cid, v.id_type,
                     {sql_minute('v.ts')} AS minute, v.num
              FROM verts v LEFT JOIN edges_cc c ON v.slot = c.slot AND v.cid_hash = c.node)"""


_MAP_SQL = _map_sql(_PAIRS_SQL, "%Y")


@query("connected_components", f"""
WITH RECURSIVE {_PAIRS_SQL},
edges AS (SELECT DISTINCT {sql_md5('id1')} AS src, {sql_md5('id2')} AS dst FROM pairs WHERE id2 IS NOT NULL),
{sql_components('edges')}
SELECT node, component FROM edges_cc""")
def _(t):
    pairs = identity.clean_pairs(_id_pairs(t)).where(F.col("id2").isNotNull())
    edges = pairs.select(md5_signed64(F.col("id1")).alias("src"), md5_signed64(F.col("id2")).alias("dst"))
    return connected_components(edges)


@query("identity_map", f"WITH RECURSIVE {_MAP_SQL} SELECT * FROM idmap")
def _(t):
    return identity.identity_map(_id_pairs(t), slot_chars=4)


_CUT = "1999"


def _window_and_history(t):
    """Slots from the cut year on, and the merged records of the years before."""
    rows = identity.identity_map(_id_pairs(t), slot_chars=4)
    return rows.where(F.col("slot") >= _CUT), identity.merge_slots(rows.where(F.col("slot") < _CUT))


def _merged(t, which):
    """A table of the merge (``everything`` or ``merged``) and its changes; the tables they are made of are gone."""
    with own_stages(t.spark) as stages:
        window, history = _window_and_history(t)
        merge = identity.merge_history(window, history)
        records = merge.merged if which == "merged" else merge.everything()
        stages.keep(records, merge.changes)
    return records, merge.changes


_START = slot_minute(f"{_CUT}-01-01-00")
_MINUTES = 3 * 366 * 24 * 60

_MERGE_SQL = f"""{_MAP_SQL},
    hist AS (SELECT cid_hash, arg_min(uid, (minute, uid)) AS uid, max(cid) AS cid, max(id_type) AS id_type,
                    max(minute) AS minute, CAST(sum(num) AS BIGINT) AS num FROM idmap WHERE slot < '{_CUT}' GROUP BY 1),
    win AS (SELECT cid_hash, uid, cid, id_type, minute, num FROM (
              SELECT *, row_number() OVER (PARTITION BY uid, id_type ORDER BY minute DESC, cid DESC) AS rn
              FROM idmap WHERE slot >= '{_CUT}') WHERE rn <= 50),
    recs AS (SELECT * FROM win UNION ALL SELECT * FROM hist),
    merged AS (SELECT cid_hash, arg_min(uid, (minute, uid)) AS uid, max(cid) AS cid, max(id_type) AS id_type,
                      max(minute) AS minute, CAST(sum(num) AS BIGINT) AS num FROM recs GROUP BY 1),
    seen AS (SELECT cid_hash, uid, min(minute) AS minute FROM recs GROUP BY 1, 2),
    roots AS (SELECT cid_hash, min(uid) AS root FROM seen GROUP BY 1 HAVING count(*) > 1),
    shared AS (SELECT s.*, r.root FROM seen s JOIN roots r USING (cid_hash)),
    stars AS (SELECT DISTINCT root AS src, uid AS dst FROM shared WHERE root <> uid),
    {sql_components('stars')},
    firsts AS (SELECT uid, min(minute) AS minute FROM shared GROUP BY 1),
    members AS (SELECT c.node AS uid, c.component, f.minute FROM stars_cc c JOIN firsts f ON f.uid = c.node),
    oldest AS (SELECT component, arg_min(uid, (minute, uid)) AS new_uid FROM members GROUP BY 1 HAVING count(*) < 5000),
    changes AS (SELECT m.uid AS old_uid, o.new_uid, m.minute FROM members m JOIN oldest o USING (component)),
    real_changes AS (SELECT * FROM changes WHERE old_uid <> new_uid),
    idx AS (SELECT cid_hash, coalesce(c.new_uid, m.uid) AS uid, cid, id_type, m.minute, num
            FROM merged m LEFT JOIN real_changes c ON c.old_uid = m.uid),
    added AS (SELECT * FROM idx WHERE minute >= {_START} AND minute < {_START + _MINUTES})"""


@query("history_merge_changes", f"WITH RECURSIVE {_MERGE_SQL} SELECT * FROM changes")
def _(t):
    window, history = _window_and_history(t)
    return identity.merge_history(window, history).changes


@query("history_merge_index", f"WITH RECURSIVE {_MERGE_SQL} SELECT * FROM idx")
def _(t):
    with own_stages(t.spark) as stages:
        index = identity.remap_uids(*_merged(t, "everything"))
        stages.keep(index)
    return index


@query("history_from_daily_base", f"""
WITH RECURSIVE {_MERGE_SQL} SELECT cid_hash, uid, cid, id_type, minute, num FROM hist""")
def _(t):
    _, history = _window_and_history(t)
    base = history.select(compact_id_encode(F.col("uid")).alias("uid_code"), "cid", "id_type", "minute", "num")
    return identity.history_from_daily_base(base)


@query("identity_delete_rows", f"""
WITH RECURSIVE {_MERGE_SQL}
SELECT {sql_code('old_uid')} AS old_code, {sql_code('new_uid')} AS new_code FROM real_changes WHERE minute < {_START}""")
def _(t):
    window, history = _window_and_history(t)
    return identity.uids_to_delete(identity.merge_history(window, history).changes, _START)


@query("identity_add_rows", f"""
WITH RECURSIVE {_MERGE_SQL},
per AS (SELECT uid, id_type, string_agg(cid || '|' || minute || '|' || num, ',' ORDER BY minute DESC, cid) AS ids, count(*) AS n
        FROM added GROUP BY 1, 2 HAVING count(*) < 5000),
wide AS (SELECT uid, coalesce(max(ids) FILTER (id_type = 1), '') AS t1, coalesce(max(ids) FILTER (id_type = 2), '') AS t2,
                '' AS t3, '' AS t4, '' AS t5, CAST(sum(n) AS BIGINT) AS total FROM per GROUP BY 1)
SELECT {sql_code('uid')} AS uid_code, t1, t2, t3, t4, t5, total FROM wide""")
def _(t):
    with own_stages(t.spark) as stages:
        index = identity.remap_uids(*_merged(t, "everything"))
        added = cut_lineage(identity.window_records(index, _START, _MINUTES))
        stages.keep(added)
    return identity.add_rows(added)


@query("identity_change_log", f"""
WITH RECURSIVE {_MERGE_SQL}
SELECT {sql_code('old_uid')} AS old_code, {sql_code('new_uid')} AS new_code, minute FROM changes""")
def _(t):
    window, history = _window_and_history(t)
    return identity.change_log(identity.merge_history(window, history).changes)


@query("identity_change_audit", f"""
WITH RECURSIVE {_MERGE_SQL},
audited AS (SELECT 'before' AS taken, cid, uid FROM merged WHERE minute >= {_START} AND minute < {_START + _MINUTES}
         UNION ALL SELECT 'after', cid, uid FROM added)
SELECT taken, cid, uid, c.new_uid, c.minute AS change_minute FROM audited JOIN real_changes c ON c.old_uid = uid""")
def _(t):
    """The window's records against the changes, before and after the remap.

    After it hardly any record stands under a changed uid; before it, all that change do.
    """
    with own_stages(t.spark) as stages:
        merged, changes = _merged(t, "merged")
        parts = []
        for name, records in (("before", merged), ("after", identity.remap_uids(merged, changes))):
            audit = identity.change_audit(changes, identity.window_records(records, _START, _MINUTES))
            parts.append(audit.select(F.lit(name).alias("taken"), "cid", "uid", "new_uid", "change_minute"))
        audited = parts[0].unionByName(parts[1])
        stages.keep(audited)
    return audited


@query("identity_hourly_rows", f"""
WITH RECURSIVE {_MERGE_SQL},
w AS (SELECT i.slot, i.cid, coalesce(c.new_uid, i.uid) AS u, i.id_type, i.minute
      FROM idmap i LEFT JOIN real_changes c ON c.old_uid = i.uid WHERE slot >= '{_CUT}')
SELECT slot, cid, {sql_code('u')} AS uid, id_type, minute, CASE id_type WHEN 1 THEN 'agsid' ELSE 'channelid' END AS kind FROM w""")
def _(t):
    window, history = _window_and_history(t)
    merge = identity.merge_history(window, history)
    return hourly_kinds(identity.slot_rows(window, merge.changes))


def _channel_rows(t):
    return t.orders.select(
        F.concat(F.lit("c"), text("o_custkey")).alias("cid"), F.concat(F.lit("o"), text("o_orderkey")).alias("uid"),
        (F.col("o_orderkey") % 3 + 2).cast("int").alias("id_type"),
        epoch_minute(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("minute"), "o_orderstatus")


def _uid_changes(t):
    hour = F.element_at(F.array(F.lit("07"), F.lit("15"), F.lit("23")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    return t.lineitem.select(
        F.concat(F.lit("o"), text("l_orderkey")).alias("old_uid"),
        F.concat(F.lit("n"), text("l_suppkey")).alias("new_uid"), hour.alias("hour"))


_CHANNEL_SQL = f"""
WITH rows AS (SELECT 'c' || o_custkey AS cid, 'o' || o_orderkey AS uid, CAST(o_orderkey % 3 + 2 AS INTEGER) AS id_type,
                     {sql_minute('o_orderdate')} AS minute, o_orderstatus FROM orders),
log AS (SELECT 'o' || l_orderkey AS old_uid, 'n' || l_suppkey AS new_uid, ['07', '15', '23'][l_linenumber % 3 + 1] AS hour
        FROM lineitem),
ch AS (SELECT old_uid, arg_max(new_uid, (hour, new_uid)) AS new_uid FROM log GROUP BY 1)"""

_FLOOR = slot_minute("2001-08-02-00") - 1500 * 1440


@query("daily_uid_changes", _CHANNEL_SQL + " SELECT * FROM ch")
def _(t):
    return channels.day_changes(_uid_changes(t))


@query("daily_channel_merge", _CHANNEL_SQL + f""",
kept AS (SELECT cid, max((minute, uid, id_type)) AS m FROM rows
         WHERE o_orderstatus = 'O' OR minute >= {_FLOOR} GROUP BY 1)
SELECT cid, coalesce(new_uid, struct_extract(m, 2)) AS uid, struct_extract(m, 3) AS id_type, struct_extract(m, 1) AS minute
FROM kept LEFT JOIN ch ON old_uid = struct_extract(m, 2)""")
def _(t):
    rows = _channel_rows(t)
    return channels.merge_channels(
        rows.where("o_orderstatus = 'O'"), rows.where("o_orderstatus <> 'O'"), channels.day_changes(_uid_changes(t)),
        "2001-08-02", keep_days=1500)


@query("daily_cookie_merge", _CHANNEL_SQL + """,
kept AS (SELECT cid, id_type, max((minute, uid)) AS m FROM rows GROUP BY 1, 2)
SELECT cid, coalesce(new_uid, struct_extract(m, 2)) AS uid, id_type, struct_extract(m, 1) AS minute
FROM kept LEFT JOIN ch ON old_uid = struct_extract(m, 2)""")
def _(t):
    return channels.merge_cookies(_channel_rows(t), channels.day_changes(_uid_changes(t)))


@query("chained_uid_changes", """
WITH o AS (SELECT o_orderkey AS k, max(o_orderkey) OVER (PARTITION BY o_custkey) AS last FROM orders)
SELECT 'o' || k AS old_uid, 'o' || last AS new_uid FROM o WHERE k <> last""")
def _(t):
    from pyspark.sql import Window

    following = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    hops = t.orders.select("o_orderkey", following.alias("next")).where(F.col("next").isNotNull()).select(
        F.concat(F.lit("o"), text("o_orderkey")).alias("old_uid"), F.concat(F.lit("o"), text("next")).alias("new_uid"))
    return channels.chained_changes(hops)


@query("id_pair_extraction", f"""
WITH e AS (SELECT {SQL_TS} AS time, user_id, event_type, {SQL_K} AS k, event_id FROM events),
d AS (SELECT time, CASE WHEN event_id % 4 = 0 AND event_type = 'click' THEN md5(repeat('g', 33) || k) WHEN event_id % 4 = 0
                   THEN repeat('g', 33) || k ELSE k END AS id1,
             CASE event_type WHEN 'view' THEN '2' WHEN 'click' THEN '3' ELSE '4' END AS id1_type, 's' || user_id AS id2
      FROM e WHERE event_type IN ('view', 'click', 'signup') AND NOT event_id % 4 = 1),
p AS (SELECT time, n_name || '_f' || k AS id1, '5' AS id1_type, 's' || user_id AS id2
      FROM e JOIN nation ON n_nationkey = user_id % 40 WHERE event_type IN ('error', 'purchase'))
SELECT *, '1' AS id2_type FROM (SELECT * FROM d UNION ALL SELECT * FROM p)""")
def _(t):
    ev = t.events
    channel = F.when(F.col("event_type") == "view", "adx").when(F.col("event_type") == "click", "baidu").otherwise("tanx")
    guid = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("g" * 33), prop_k())).when(
        F.col("event_id") % 4 == 1, F.lit(extraction.MOCKED_ID)).otherwise(prop_k())
    shows = ev.where(F.col("event_type").isin("view", "click", "signup")).select(
        channel.alias("channel"),
        F.concat(ts_text(), F.lit("|~|Show: a=1||guid="), guid, F.lit("||agsid=s"), text("user_id")).alias("value"))
    views = ev.where(F.col("event_type").isin("error", "purchase")).select(F.concat(
        ts_text(), F.lit("\t1.1.1.1\ts"), text("user_id"), F.lit("\tt\thttp://x.test/\tatscu=AG"),
        (F.col("user_id") % 40).cast("string"), F.lit("&agfid=f"), prop_k(), F.lit("&z=1\tUA")).alias("value"))
    clients = t.nation.select(
        F.concat(F.lit("AG"), text("n_nationkey")).alias("client_code"), F.col("n_name").alias("client_id"))
    display = extraction.display_pairs(load_show(shows, ("time", "guid", "agsid")))
    visits = extraction.page_view_pairs(load_page_views(views, ("time", "agsid", "query"), keep_line=True), clients)
    return extraction.all_pairs(display, visits)


_EVENT_PAIRS_SQL = f"""
    pairs AS (SELECT ts, 'u' || user_id AS id1, 'k' || {SQL_K} || '-' || strftime(ts, '%Y%m%d') AS id2 FROM events)"""


def _windows_sql(count):
    """The windows one after the other, each merged into the index of the one before."""
    parts = [_map_sql(_EVENT_PAIRS_SQL, "%Y-%m-%d-%H"), """
    bounds AS (SELECT CAST(floor(epoch(min(ts)) / 3600) AS BIGINT) AS first,
                      CAST(floor(epoch(max(ts)) / 3600) AS BIGINT) AS last FROM events),
    spans AS (SELECT first, (last - first) // {count} + 1 AS span FROM bounds),
    placed AS (SELECT i.*, (i.minute // 60 - first) // span AS w FROM idmap i, spans)""".replace("{count}", str(count))]
    none = "SELECT cid_hash, uid, cid, id_type, minute, CAST(num AS BIGINT) AS num FROM idmap WHERE false"
    for k in range(count):
        before = none if k == 0 else f"SELECT * FROM idx{k - 1}"
        parts.append(f"""
    recs{k} AS (SELECT cid_hash, uid, cid, id_type, minute, num FROM (
                  SELECT *, row_number() OVER (PARTITION BY uid, id_type ORDER BY minute DESC, cid DESC) AS rn
                  FROM placed WHERE w = {k}) WHERE rn <= 50 UNION ALL {before}),
    merged{k} AS (SELECT cid_hash, arg_min(uid, (minute, uid)) AS uid, max(cid) AS cid, max(id_type) AS id_type,
                         max(minute) AS minute, CAST(sum(num) AS BIGINT) AS num FROM recs{k} GROUP BY 1),
    seen{k} AS (SELECT cid_hash, uid, min(minute) AS minute FROM recs{k} GROUP BY 1, 2),
    roots{k} AS (SELECT cid_hash, min(uid) AS root FROM seen{k} GROUP BY 1 HAVING count(*) > 1),
    shared{k} AS (SELECT s.*, r.root FROM seen{k} s JOIN roots{k} r USING (cid_hash)),
    stars{k} AS (SELECT DISTINCT root AS src, uid AS dst FROM shared{k} WHERE root <> uid),
    {sql_components(f"stars{k}")},
    firsts{k} AS (SELECT uid, min(minute) AS minute FROM shared{k} GROUP BY 1),
    members{k} AS (SELECT c.node AS uid, c.component, f.minute FROM stars{k}_cc c JOIN firsts{k} f ON f.uid = c.node),
    oldest{k} AS (SELECT component, arg_min(uid, (minute, uid)) AS new_uid FROM members{k} GROUP BY 1 HAVING count(*) < 5000),
    changes{k} AS (SELECT m.uid AS old_uid, o.new_uid FROM members{k} m JOIN oldest{k} o USING (component)
                   WHERE m.uid <> o.new_uid),
    idx{k} AS (SELECT cid_hash, coalesce(c.new_uid, m.uid) AS uid, cid, id_type, m.minute, num
               FROM merged{k} m LEFT JOIN changes{k} c ON c.old_uid = m.uid),
    out{k} AS (SELECT slot, cid, coalesce(c.new_uid, p.uid) AS u, id_type, minute
               FROM placed p LEFT JOIN changes{k} c ON c.old_uid = p.uid WHERE w = {k})""")
    rows = " UNION ALL ".join(f"SELECT * FROM out{k}" for k in range(count))
    return f"""WITH RECURSIVE {",".join(parts)}
SELECT slot, cid, {sql_code('u')} AS uid, id_type, minute, CASE id_type WHEN 1 THEN 'agsid' ELSE 'channelid' END AS kind
FROM ({rows})"""


@query("identity_windows", _windows_sql(3))
def _(t):
    """Three windows over all events, from two log tables, driven end to end."""
    line = F.concat_ws(
        "\t", ts_text(), F.concat(F.lit("u"), text("user_id")), F.lit("1"),
        F.concat(F.lit("k"), prop_k(), F.lit("-"), F.date_format("ts", "yyyyMMdd")), F.lit("2"))
    root = fresh_folder(t.spark, "windows")
    paths = [f"{root}/log-{name}" for name in ("even", "odd")]
    for i, path in enumerate(paths):
        write_log_table(t.events.where(F.col("event_id") % 2 == i).select(
            F.lit("pairs").alias("log_type"), F.lit("all").alias("channel"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
            hour_key(F.col("ts")).alias("hour"), line.alias("value")), path)
    first, last = t.events.agg(F.date_trunc("hour", F.min("ts")), F.date_trunc("hour", F.max("ts"))).first()
    span = int((last - first).total_seconds() // 3600) // 3 + 1
    windows.run_windows(t.spark, paths, root, f"{first:%Y-%m-%d-%H}", span, 3, first_run=True,
                        buckets=8)
    return t.spark.read.parquet(windows.WindowPaths(root).idmap())
