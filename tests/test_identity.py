"""Window driver and identity jobs against plain Python on a small fixture."""

import hashlib
import pathlib
import random
import struct
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_graph import union_find

from clickloom.functions.hashing import CODE_DIGITS
from clickloom.functions.times import hour_list, slot_minute
from clickloom.plans import channels, identity, index, windows
from clickloom.queries import QUERIES
from clickloom.sources import logs


def signed(text):
    return struct.unpack("<q", hashlib.md5(text.encode()).digest()[:8])[0]


def code(number):
    return "".join(CODE_DIGITS[((number % 2**64) >> (5 * i)) & 31] for i in range(12, -1, -1)) + "u"


def minute_of(time):
    return slot_minute(time[:13].replace(" ", "-")) + int(time[14:16])


def hourly(pairs):
    """{slot: {cid: (uid, type, minute, num)}}"""
    slots = defaultdict(dict)
    for time, a, ta, b, tb in pairs:
        a, b = (v if v not in ("", "null") else None for v in (a.strip(), b.strip()))
        key = (a, ta, b, tb)
        quads = slots[time[:13].replace(" ", "-")]
        quads[key] = max(quads.get(key, ""), time)
    result = {}
    for slot, quads in slots.items():
        seen = defaultdict(list)
        for (a, ta, b, tb), time in quads.items():
            for cid, kind in ((a, ta), (b, tb)):
                if cid:
                    seen[cid].append((time, kind))
        roots = union_find([(signed(a), signed(b)) for (a, _, b, _) in quads if a and b])
        result[slot] = {
            cid: (roots.get(signed(cid), signed(cid)), int(max(v)[1]), minute_of(max(v)[0]), len(v)) for cid, v in seen.items()
        }
    return result


def merge(window, history, recent, limit):
    """window: list of (cid, uid, type, minute, num); history: the same. -> index, changes"""
    groups = defaultdict(list)
    for row in window:
        groups[(row[1], row[2])].append(row)
    records = [r for g in groups.values() for r in sorted(g, key=lambda r: (r[3], r[0], r[4]), reverse=True)[:recent]]
    records += history
    by_cid = defaultdict(list)
    for row in records:
        by_cid[row[0]].append(row)
    first, edges = {}, []
    for rows in by_cid.values():
        uids = defaultdict(lambda: 2**60)
        for _, uid, _, minute, _ in rows:
            uids[uid] = min(uids[uid], minute)
        if len(uids) > 1:
            edges += [(min(uids), u) for u in uids]
            for uid, minute in uids.items():
                first[uid] = min(first.get(uid, 2**60), minute)
    members = defaultdict(list)
    for uid, root in union_find(edges).items():
        members[root].append(uid)
    changes = {}
    for group in members.values():
        if len(group) < limit:
            oldest = min((first[u], u) for u in group)[1]
            changes.update({u: (oldest, first[u]) for u in group})
    index = []
    for cid, rows in by_cid.items():
        uid = min((r[3], r[1]) for r in rows)[1]
        kind = max((r[3], r[2]) for r in rows)[1]
        index.append((cid, changes.get(uid, (uid, 0))[0], kind, max(r[3] for r in rows), sum(r[4] for r in rows)))
    return index, changes


def make_pairs(seed=3):
    rng = random.Random(seed)
    rows = []
    for slot in hour_list("2024-01-01-16", 16):
        for _ in range(12):
            time = f"{slot[:10]} {slot[11:]}:{rng.randint(0, 59):02d}:00"
            rows.append((time, f" s{rng.randint(0, 60)}", "1", rng.choice(["", "null", f"c{rng.randint(0, 12)}"]), "2"))
    return rows


def write_pairs(spark, pairs, folder):
    """The pairs as a log table of tab-separated lines."""
    rows = [("pairs", "all", p[0][:10], p[0][:13].replace(" ", "-"), "\t".join(p)) for p in pairs]
    logs.write_log_table(spark.createDataFrame(rows, "log_type string, channel string, day string, hour string, value string"),
                         folder + "/log")
    return folder + "/log"


def test_missing_tables_raise_and_short_windows_all_count(spark, folder):
    log = write_pairs(spark, make_pairs(), folder)
    saved = windows.run_windows(spark, [log], folder, "2024-01-01-16", 4, 4, first_run=True, recent=3, group_limit=3, buckets=4)
    assert saved == ["2024-01-01-19", "2024-01-01-23", "2024-01-02-03", "2024-01-02-07"]
    assert windows.day_window_ends("2024-01-02-23", 4) == [f"2024-01-02-{h:02d}" for h in (3, 7, 11, 15, 19, 23)]
    assert windows.day_window_ends("2024-01-01-23", 4, "2024-01-01-16") == saved[:2]
    paths = windows.WindowPaths(folder)
    # All windows of the day feed its merge: taking one away is noticed.
    with pytest.raises(FileNotFoundError):
        windows.run_daily_merge(spark, paths, "2024-01-01", ["2024-01-01-15", *saved[:2]], first_run=True)
    with pytest.raises(FileNotFoundError):
        windows.run_daily_merge(spark, paths, "2024-01-01", saved[:2])
    with pytest.raises(FileNotFoundError):
        windows.run_windows(spark, [log], folder, "2024-01-05-00", 4, 1)
    # Going on from what is there needs no flag, and reads the hours' directories only.
    windows.run_windows(spark, [log], folder, "2024-01-02-08", 4, 1, last="2024-01-02-07", buckets=4)
    plan = logs.scan_hours(spark, [log], ["2024-01-01-16"])._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-01" in plan[plan.index("PartitionFilters"):] and "PushedFilters: [IsNotNull(hour)" in plan


def test_windows_against_plain_python(spark, folder):
    pairs = make_pairs()
    log = write_pairs(spark, pairs, folder)
    with pytest.raises(FileNotFoundError):
        windows.run_windows(spark, [log], folder, "2024-01-01-16", 8, 1, recent=3, group_limit=3)
    saved = windows.run_windows(spark, [log], folder, "2024-01-01-16", 8, 2, first_run=True, recent=3, group_limit=3, buckets=4)
    assert saved == ["2024-01-01-23", "2024-01-02-07"]
    paths = windows.WindowPaths(folder)
    slots = hourly(pairs)
    got = {(r.slot, r.cid): (r.uid, r.id_type, r.minute, r.num) for r in spark.read.parquet(paths.hourly()).collect()}
    assert got == {(s, c): v for s, rows in slots.items() for c, v in rows.items()}

    history = []
    dropped_changes = False
    table = windows.previous_index(spark, paths, hour_list("2024-01-02-08", 1), saved[-1])[0]
    for run, slot in enumerate(saved):
        hours = hour_list("2024-01-01-16", 16)[run * 8:run * 8 + 8]
        start = slot_minute(hours[0])
        window = [(c, *v) for h in hours for c, v in slots.get(h, {}).items()]
        merged, changes = merge(window, history, 3, 3)
        log = {(r.old_code, r.new_code, r.minute) for r in spark.read.parquet(paths.output(slot, "changes")).collect()}
        assert log == {(code(o), code(n), m) for o, (n, m) in changes.items()}
        deleted = {(r.old_code, r.new_code) for r in spark.read.parquet(paths.output(slot, "delete")).collect()}
        assert deleted == {(code(o), code(n)) for o, (n, m) in changes.items() if o != n and m < start}
        lists = defaultdict(list)
        for cid, uid, kind, minute, num in merged:
            if start <= minute < start + 480:
                lists[(uid, kind)].append((-minute, cid, f"{cid}|{minute}|{num}"))
        dropped_changes |= any(len(v) >= 3 for v in lists.values())
        want = defaultdict(lambda: ["", "", 0])
        for (uid, kind), entries in lists.items():
            if len(entries) < 3:
                want[code(uid)][kind - 1] = ",".join(e[2] for e in sorted(entries))
                want[code(uid)][2] += len(entries)
        added = {r.uid_code: [r.t1, r.t2, r.total] for r in spark.read.parquet(paths.output(slot, "add")).collect()}
        assert added == dict(want)
        rows = spark.read.parquet(paths.idmap()).where(F.col("slot").isin(*hours)).collect()
        assert {(r.slot, r.cid, r.uid, r.kind) for r in rows} == {
            (h, c, code(changes.get(v[0], (v[0],))[0]), "agsid" if v[1] == 1 else "channelid")
            for h in hours for c, v in slots.get(h, {}).items()}
        history = merged
    assert dropped_changes
    # All layers together are the index that the plain merge has.
    assert sorted((r.cid, r.uid, r.id_type, r.minute, r.num) for r in table.records().collect()) == sorted(merged)
    # The first window ends at hour 23: coded base for the next day, merged channel ids.
    assert spark.read.parquet(paths.daily_base("2024-01-02")).count() > 0
    assert spark.read.parquet(paths.channel_history("agsid", "2024-01-01")).count() > 0


def written(folder):
    return sum(f.stat().st_size for f in pathlib.Path(folder).rglob("*.parquet"))


def test_a_window_reads_its_buckets_and_writes_its_ids(spark, folder):
    records = lambda lo, hi: spark.range(lo, hi).selectExpr(
        "id as cid_hash", "id as uid", "concat('c', id) as cid", "1 as id_type", "id % 7 as minute", "1L as num")
    sizes = []
    for name, n in (("small", 1_000), ("large", 100_000)):
        paths = windows.WindowPaths(f"{folder}/{name}", 16)
        index.write_base(records(0, n), paths.daily_base("2024-01-02"), 16)
        spark.createDataFrame([("2024-01-02-00", 16 * i, 16 * i, f"c{16 * i}", 1, 40, 1) for i in range(20)],
                              "slot string, cid_hash long, uid long, cid string, id_type int, minute long, num long"
                              ).write.parquet(paths.hourly())
        before = written(f"{folder}/{name}")
        windows.run_window(spark, paths, ["2024-01-02-00"], "2024-01-01-23")
        sizes.append(written(f"{folder}/{name}") - before)
        after = windows.previous_index(spark, paths, ["2024-01-02-01"], "2024-01-02-00")[0]
        # The ids of the base are the hashes of their text, so they lie in buckets of these.
        found = after.records(spark.range(1).selectExpr("0L as cid_hash"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("PartitionFilters: [isnotnull(bucket") + plan.count("PartitionFilters: [bucket") >= 2, plan
        assert [r.num for r in found.collect()] == [1]
        assert after.records().count() == n + 20
    # A hundred times the index, the same window.
    assert sizes[1] < 1.2 * sizes[0]


def test_changes_apply_to_older_layers_only(spark):
    names = "cid_hash long, uid long, cid string, id_type int, minute long, num long, bucket int"
    rows = lambda *r: spark.createDataFrame([(c, u, f"c{c}", 1, 5, 1, c % 2) for c, u in r], names)
    moved = lambda *r: spark.createDataFrame(list(r), "uid long, new_uid long")
    table = index.IdentityIndex(
        rows((1, 10), (2, 20), (3, 30)),
        [index.Layer(rows((2, 21)), moved((10, 11), (30, 31))), index.Layer(rows((4, 10)), moved((11, 12), (21, 20))),
         index.Layer(rows(), moved())], 2)
    assert {r.cid_hash: r.uid for r in table.records().collect()} == {1: 12, 2: 20, 3: 31, 4: 10}
    wanted = spark.createDataFrame([(1,), (4,), (99,)], "cid_hash long")
    assert {r.cid_hash: r.uid for r in table.records(wanted).collect()} == {1: 12, 4: 10}
    assert table.touched_buckets(wanted) == [0, 1]
    assert {r.cid_hash for r in table.older_in_range(0, 9, wanted).collect()} == {2, 3}


def test_short_lines_and_unreadable_times(spark):
    lines = spark.createDataFrame([
        ("2024-01-01 10:00:00\ta\t1\tb\t2\textra",), ("2024-01-01 10:00:00\ta\t1\tb",), ("2024-01-01 10:99:00\tz\t1\t\t",),
    ], "value string")
    pairs = identity.pairs_from_lines(lines)
    assert pairs.count() == 2
    assert {r.cid for r in identity.identity_map(pairs).collect()} == {"a", "b"}


def test_one_hop_and_chained_changes(spark):
    log = spark.createDataFrame(
        [("a", "b", "07"), ("b", "c", "15"), ("x", "y", "07"), ("x", "z", "23"), ("p", "q", "07"), ("q", "p", "15")],
        "old_uid string, new_uid string, hour string")
    one_hop = channels.day_changes(log)
    assert {tuple(r) for r in one_hop.collect()} == {("a", "b"), ("b", "c"), ("x", "z"), ("p", "q"), ("q", "p")}
    assert {tuple(r) for r in channels.chained_changes(one_hop).collect()} == {
        ("a", "c"), ("b", "c"), ("x", "z"), ("p", "q"), ("q", "p")}


def test_diff_of_a_table_with_itself_is_empty(spark):
    from clickloom.operators.joins import canonical_ids, dataset_diff

    df = spark.createDataFrame([("u", "b|1|1,a|2|1\tc|3|1"), ("v", None)], "k string, line string")
    canonical = df.select("k", canonical_ids(F.col("line")).alias("v"))
    assert canonical.where("k = 'u'").first().v == "a|b;c"
    assert dataset_diff(canonical, canonical, ["k"], "v").count() == 0
    only_left = dataset_diff(canonical, canonical.where("k = 'u'"), ["k"], "v").collect()
    assert [(r.k, r.left_value, r.right_value) for r in only_left] == [("v", None, None)]


def test_a_chain_of_a_thousand_hops_takes_ten_rounds(spark, monkeypatch):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(1_000)]
    hops = spark.createDataFrame(chain, "old_uid string, new_uid string")
    rounds, store = [], channels.cut_lineage
    monkeypatch.setattr(channels, "cut_lineage", lambda *a: rounds.append(1) or store(*a))
    ends = {r.new_uid for r in channels.chained_changes(hops).collect()}
    # The table itself is stored once before.
    assert ends == {"n1000"} and len(rounds) <= 11


def test_circles_stars_and_what_leads_into_a_circle(spark):
    star = [(f"s{i}", "hub") for i in range(50)] + [("hub", "mid"), ("mid", "end")]
    circle = [("p", "q"), ("q", "r"), ("r", "p"), ("in", "p"), ("far", "in"), ("self", "self")]
    hops = spark.createDataFrame(star + circle, "old_uid string, new_uid string")
    got = {r.old_uid: r.new_uid for r in channels.chained_changes(hops).collect()}
    assert got == {old: "end" for old, _ in star} | dict(circle)
    assert channels.chained_changes(hops.limit(0)).count() == 0


def test_diff_joins_the_unequal_buckets_only(spark):
    from clickloom.operators import joins

    rows = [(i, f"v{i}" if i % 9 else None) for i in range(3_000)]
    left = spark.createDataFrame(rows, "k long, v string")
    changed = [(i, "new" if i == 5 else v) for i, v in rows if i != 77] + [(3_000, None)]
    right = spark.createDataFrame(changed, "k long, v string").repartition(5)
    assert joins.unequal_buckets(left, left.repartition(3), ["k"], "v") == []
    unlike = joins.unequal_buckets(left, right, ["k"], "v")
    assert 1 <= len(unlike) <= 3
    got = {tuple(r) for r in joins.dataset_diff(left, right, ["k"], "v").collect()}
    assert got == {(5, "v5", "new"), (77, "v77", None), (3_000, None, None)}
    # Few buckets, other types, and null keys, which match nothing.
    assert {tuple(r) for r in joins.dataset_diff(left, right, ["k"], "v", buckets=1).collect()} == got
    other = right.withColumn("k", F.col("k").cast("int"))
    assert {tuple(r) for r in joins.dataset_diff(left, other, ["k"], "v").collect()} == got
    nulls = spark.createDataFrame([(None, "a"), (1, "b")], "k long, v string")
    assert joins.dataset_diff(nulls, nulls, ["k"], "v").count() == 2


def test_equal_tables_shuffle_their_bucket_sums_only(spark):
    from clickloom.operators import joins

    table = spark.range(20_000).select("id", F.format_string("value %d", "id").alias("v"))
    diff = joins.dataset_diff(table, table.repartition(4), ["id"], "v", buckets=16)
    plan = diff._jdf.queryExecution().optimizedPlan().toString()
    assert diff.count() == 0
    # Nothing is left of the tables but rows without a key.
    assert "isnull(id" in plan or "LocalRelation" in plan


def test_ids_of_one_star_are_not_shuffled_again(spark):
    rows = [(f"2024-01-01 16:{i % 60:02d}:00", f"s{i}", "1", f"c{i}", "2") for i in range(50)]
    schema = "time string, id1 string, id1_type string, id2 string, id2_type string"
    table = identity.identity_map(spark.createDataFrame(rows, schema))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    assert table.count() == 100
    # Chains over several stars, an id on both sides, one paired with itself, one with nothing, no id1.
    more = [("a", "x"), ("b", "x"), ("b", "y"), ("c", "y"), ("x", "z"), ("e", "e"), ("f", None), (None, "z"), (None, "g"), ("a", "x")]
    rows += [("2024-01-01 17:05:00", a, "1", b, "2") for a, b in more]
    table = identity.identity_map(spark.createDataFrame(rows, schema)).collect()
    got = {(r.slot[-2:], r.cid): (r.uid, r.num) for r in table}
    assert len(got) == len(table) == 109
    least = min(map(signed, "abcxyz"))
    assert {c: got["17", c] for c in "abcxyz"} == {
        c: (least, n) for c, n in zip("abcxyz", (1, 2, 1, 3, 2, 2), strict=True)}
    assert [got["17", c] for c in "efg"] == [(signed("e"), 2), (signed("f"), 1), (signed("g"), 1)]


def test_ids_with_one_record_are_not_shuffled(spark):
    names = "cid_hash long, uid long, cid string, id_type int, minute long, num long"
    rows = [(i, i % 7, f"c{i}", 1, i, 1) for i in range(40)] + [(i, 9, f"c{i}", 2, 3 * i, 2) for i in range(5)]
    rows += [(50, None, None, None, None, None), (None, 1, "x", 1, 1, 1), (None, 2, "x", 1, 1, 1)]
    records = spark.createDataFrame(rows, names)
    merged = identity.merge_slots(records)
    assert "hashpartitioning" not in merged._jdf.queryExecution().executedPlan().toString()
    plain = identity.merge_records(records)
    assert merged.columns == plain.columns and merged.schema["num"].dataType == plain.schema["num"].dataType
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(merged.collect(), key=key) == sorted(plain.collect(), key=key)


def test_a_merge_knows_the_ids_of_its_window(spark):
    names = "cid_hash long, uid long, cid string, id_type int, minute long, num long"
    history = spark.createDataFrame([(1, 10, "a", 1, 5, 1), (2, 20, "b", 1, 5, 1), (3, 30, "c", 1, 5, 1)], names)
    window = spark.createDataFrame([(2, 21, "b", 1, 9, 4), (4, 21, "d", 1, 9, 1), (3, 30, "c", 2, 9, 1)], names)
    merge = identity.merge_history(window, history)
    assert {(r.cid, r.uid, r.minute, r.num) for r in merge.merged.collect()} == {
        ("b", 20, 9, 5), ("d", 21, 9, 1), ("c", 30, 9, 2)}
    assert [r.cid for r in merge.untouched.collect()] == ["a"]
    assert {tuple(r) for r in merge.changes.collect()} == {(20, 20, 5), (21, 20, 9)}
    moved = identity.remap_uids(merge.everything(), merge.changes)
    assert {(r.cid, r.uid) for r in moved.collect()} == {("a", 10), ("b", 20), ("c", 30), ("d", 20)}
    # Only records of changed uids are moved, before the result is read.
    assert "hashpartitioning" not in moved._jdf.queryExecution().executedPlan().toString()
    assert identity.merge_history(window, None).untouched is None


@pytest.fixture()
def order_tables(spark, folder):
    """Orders and lines of some years, each part and day in several orders."""
    spark.range(300).selectExpr(
        "id % 40 as l_orderkey", "id % 11 as l_partkey",
        "timestamp'1997-01-01' + make_dt_interval(cast(id * 37 % 60 as int) * 30) as l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(45).selectExpr(
        "id as o_orderkey", "timestamp'1997-02-01' + make_dt_interval(cast(id as int) * 20) as o_orderdate",
    ).write.parquet(f"{folder}/orders.parquet")
    return folder


def stages_left(spark, make):
    """Stage tables that are left behind a query, those its result reads, and its rows."""
    root = pathlib.Path(spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    before = {p.name for p in root.iterdir()}
    result = make()
    left = {p.name for p in root.iterdir()} - before
    files = result.inputFiles()
    return left, {name for name in left if any(name in f for f in files)}, result.count()


def test_the_index_leaves_only_tables_it_reads(spark, order_tables):
    left, read, n = stages_left(spark, lambda: QUERIES["history_merge_index"](spark, order_tables))
    assert n and left == read


def test_add_rows_leave_the_records_of_the_window_alone(spark, order_tables):
    left, read, n = stages_left(spark, lambda: QUERIES["identity_add_rows"](spark, order_tables))
    assert n and len(left) == 1 and left == read


def test_the_audit_leaves_only_tables_it_reads(spark, order_tables):
    left, read, n = stages_left(spark, lambda: QUERIES["identity_change_audit"](spark, order_tables))
    assert n and left == read
