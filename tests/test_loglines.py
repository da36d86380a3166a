from pyspark.sql import functions as F

from clickloom.operators import classify, counters, loglines, pricing, useragent


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_kv_map_quirks(spark):
    row = loglines.load_kv(lines(spark, "2031-02-03 04:05:06|~|p=1||q||p=2|~|r=x=y||time=no||s=||")).first().fields
    assert row == {"p": "2", "q": "", "r": "x=y", "s": "", "time": "2031-02-03 04:05:06"}
    assert loglines.load_kv(lines(spark, "2031-02-03 04:05:06")).first().fields == {"time": "2031-02-03 04:05:06"}


def test_typed_lookup_agrees_with_the_map(spark):
    text = "2031-02-03 04:05:06|~|Entry: k=1||ua=First||ua=Second||site||site=shop.test||bidtag=null||bkid=||adxreq=7=8|||"
    show = loglines.load_show(lines(spark, text)).first()
    fields = loglines.load_kv(lines(spark, text)).first().fields
    for name in ("ua", "site", "adxreq"):
        assert show[name] == fields[name]
    assert (show.bidtag, show.bkid, show.time) == (None, None, "2031-02-03 04:05:06")
    # A bare key after a valued one is the last one and empty.
    assert loglines.load_show(lines(spark, "t|~|a||site=x||site")).first().site is None


def test_cookie_id_and_guid_fallbacks(spark):
    got = loglines.load_show(lines(
        spark,
        "t|~|S||agsid=null||cookie=k=1; agsid=COOKIE7; z=2",
        "t|~|S||agsid=own||cookie=agsid=COOKIE7",
        "t|~|S||cookie=foo=bar; agsid=ab",
        "t|~|S||agsid=||cookie=agsid=COOKIE7",
        "t|~|S||requestUrl=http://x/?a=1&guid=G1&guid=G2&b",
        "t|~|S||requestUrl=http://x/?a=1&guid=",
        "t|~|S||guid=||requestUrl=x&guid=G1",
    ), ("agsid", "guid")).collect()
    assert [r.agsid for r in got[:4]] == ["COOKIE7", "own", "foo=bar", None]
    assert [r.guid for r in got[4:]] == ["G2", None, None]


def test_bid_thread_fields(spark):
    got = loglines.load_bid(lines(
        spark,
        "2031-05-06 07:08:09|~|Threadid=t77,reqId=Q-one,wait=12,x|~|userId=Zed=|~|agUserId=null|~|url=http://p.test/?m=n",
        "2031-05-06 07:08:09|~|Threadid=t9|~|reqId=Q-two|~|agUserId=Ann",
        "2031-05-06 07:08:09|~|Threadid=t9,reqId=,x|~|reqId=Q-three",
    ), ("Threadid", "reqId", "guid", "agsid", "url"), keep_line=True).collect()
    assert [(r.Threadid, r.reqId, r.guid, r.agsid) for r in got] == [
        ("t77", "Q-one", "Zed=", None), ("t9", "Q-two", None, "Ann"), ("t9", "Q-three", None, None)]
    assert got[0].url == "http://p.test/?m=n" and got[0].line.startswith("2031")


def test_page_view_layouts(spark):
    new = "2015|~|ip|~|sid\ttid\thttp://u/?ag_kwid=1\ta=1&b=2&a=3\tUA"
    old = "|~|".join(["2015", "ip", "cust", "ev", "sid", "1", "2", "3", "4", "tid", "u", "ck", "q", "UA", "cr", "kw"])
    trailing = "2015\tip\tsid\t\t\t\t"
    df = lines(spark, new, old, trailing)
    got = loglines.load_page_views(df, ("agsid", "url", "keyword", "a", "custid"), parse_query=True).collect()
    assert [(r.agsid, r.url, r.keyword, r.a, r.custid) for r in got] == [
        ("sid", "http://u/?ag_kwid=1", None, "3", None), ("sid", "u", "kw", None, "cust"), (None, None, None, None, "sid")]
    assert [r[0] for r in df.select(loglines.field_count(F.col("value"))).collect()] == [7, 16, 7]
    assert loglines.route_page_views(df).count() == 2
    good, bad = loglines.split_malformed(loglines.load_page_views(df, ("agsid", "url")), ["url"])
    assert (good.count(), bad.count()) == (2, 1)


def test_cookie_match(spark):
    got = loglines.load_cookie_match(lines(
        spark, "2031-02-03 04:05:06|~|Matching some partner: google_gid=gid-31=||agsid=Ann||guid=other", "t|~|x=1||guid=g")).collect()
    assert [(r.guid, r.agsid) for r in got] == [("gid-31=", "Ann"), ("g", None)]


def test_tag_export_and_values(spark):
    text = '{"list":["SEEN_oslo_41_2031-07-08@3107080930","SEEN_%C3_9","SEEN_rome_7","other"],"aguid":"person-5"}'
    got = loglines.unpack_tag_export(lines(spark, text, "no mark"), "SEEN_")
    assert sorted(tuple(r) for r in got.collect()) == [("310708", "person-5", "oslo_41"), ("no_time", "person-5", 'rome_7"')]
    values = spark.createDataFrame([('["a","{X:DI_1,V:0102,W:3}","{X:DI_2}"]',), ("",), (None,)], "t string")
    got = [r[0] for r in values.select(loglines.tag_values(F.col("t"))).collect()]
    assert got == [["All", "0102", '{X:DI_2}"'], ["All"], ["All"]]


def test_campaign_boundaries(spark):
    df = spark.createDataFrame([("_40817",), ("_408179",), ("40817",), (None,)], "t string")
    got = df.select(classify.matches_campaign(F.col("t"), "40817").alias("a"),
                    classify.matches_campaign(F.col("t"), "40817", strict=True).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(True, True), (True, False), (False, False), (False, False)]


def test_hotel_items(spark):
    df = spark.createDataFrame([
        ("h%2Fcity%2Fbeijing%2Fdt-12%2F",), ("h%2Fcity%2Fb%2Fdt-12%2F",), ("h%2Fcity%2Fbeijing%2Fdt-12",),
        ("%2Fcity%2Fbeijing%2Fdt-12%2F",), ("none",)], "t string")
    assert [r[0] for r in df.select(classify.city_hotel_item(F.col("t"))).collect()] == ["beijing_12", None, None, None, None]


def test_counter_lines(spark):
    got = counters.parse_counter_lines(lines(
        spark, "(a,(B,3,List((5,2015), (6,2016))))", "a,,0,7,2015,9", "b,T,2")).collect()
    assert [tuple(r) for r in got] == [
        ("a", "B", 3, 5, "2015"), ("a", "B", 3, 6, "2016"), ("a", "", 0, 7, "2015"), ("b", "T", 2, None, None)]
    merged = counters.merge_counters(counters.parse_counter_lines(lines(
        spark, "(a,(B,3,List((5,2015), (6,2016))))", "a,,0,7,2015,9")))
    states = counters.counter_states(merged).collect()
    assert [(r.id, r.send_type, r.send_num, [tuple(s) for s in r.sends]) for r in states] == [
        ("a", "B", 3, [("2016", 6), ("2015", 7)])]


def test_user_agents(spark):
    cases = {
        "Sample/1.0 (Windows NT 6.1; x9) Engine/1.2 (like Gecko) Maxthon/6.7.8 Chrome/41.0 Safari/99.1":
            ("Maxthon", "6", "Gecko", "", "Windows 7", "6.1", ""),
        "Sample/2.0 (Windows NT 6.3; Trident/9.9; rv:14.2; like Gecko)":
            ("MSIE", "14", "Gecko", "", "Windows 8", "6.3", ""),
        "Sample/3.0 (Linux; Android 7.5.3; xx; PHONE-77Q Build/AB12) Engine/5.5 UCBrowser/4.5.6 Mobile":
            ("UCBrowser", "4", "", "", "Android", "7.5", "PHONE-77Q"),
        "UCWEB/5.1 (Linux; U; Adr 6.2.9; xx; tablet Z55) Extra/1.0":
            ("UCWEB", "5", "", "", "Android", "6.2", "tablet Z55"),
        "Crawler spider/8.2 (+http://bots.test/)": ("spider", "8", "", "", "", "", ""),
        "Sample/6 (xx; Mac OS X (desk; OS 7_2) Presto/3.5 Safari/4.4":
            ("Safari", "4", "Presto", "3.5", "Mac OS X", "7_2", "desk"),
        "": ("", "", "", "", "", "", ""),
    }
    df = spark.createDataFrame([(u,) for u in cases] + [(None,)], "ua string")
    got = {r.ua: tuple(r[c] for c in useragent.UA_COLUMNS) for r in useragent.with_user_agent(df).collect()}
    for ua, want in cases.items():
        assert got[ua] == want, ua
    assert got[None] == ("",) * 7


def test_costs(spark):
    df = spark.createDataFrame(
        [(10, 35, 500000, 2), (-3, 50, 10**18, 100), (5, 10, 1999, 1), (None, 1, 1, 1), (7, 0, -1500, 1)],
        "win bigint, markup int, base bigint, factor int")
    got = [(r.internal_cost, r.cost) for r in pricing.with_costs(df).collect()]
    assert got == [(14, 14), (0, 0), (6, 1), (0, 0), (7, -1)]
