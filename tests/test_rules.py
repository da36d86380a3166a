"""Rule tables: against the written rule list, against plain Python, defined cases, plan size, hot texts."""

import random

from pyspark.sql import functions as F

from clickloom.operators import classify, rules

SITE = "shop.test"


def table(spark, rows):
    return spark.createDataFrame(rows, rules.RULE_SCHEMA)


def labels(df, text="url", out="label"):
    return {r[text]: r[out] for r in df.collect()}


def plain(text, rows, default):
    """The rule by definition."""
    tests = {
        "equals": lambda r: text == r[2], "prefix": lambda r: text.startswith(r[2]),
        "contains": lambda r: r[2] in text, "shorter": lambda r: len(text) < r[3],
    }
    hits = [(r[0], r[4]) for r in rows if tests[r[1]](r)]
    return min(hits)[1] if hits else default


def test_equals_the_written_list(spark):
    written = classify.shop_page_rules(SITE)
    urls = [r.text + tail for r in written for tail in ("", "x", "abc", "/abcdef")] + ["", "http://other.test/", "hü"]
    df = spark.createDataFrame([(u,) for u in urls] + [(None,)], "url string")
    want = labels(df.select("url", classify.page_type(F.col("url"), written).alias("label")))
    got = labels(rules.first_rule(df, "url", rules.rule_table(spark, written), default=classify.UNKNOWN_PAGE))
    assert got == want


def test_random_rules_against_plain_python(spark):
    rng = random.Random(7)

    def word(most):
        return "".join(rng.choice("abé") for _ in range(rng.randint(0, most)))

    rows = [(rng.randint(0, 40), rng.choice(["equals", "prefix", "contains", "shorter"]), word(5), rng.randint(-1, 9), f"l{i}")
            for i in range(60)]
    # Ranks are often equal, texts of few letters: the empty one is left to the test of defined cases.
    rows = [(r[0] + 20 * (len(r[2]) < 2), r[1], r[2] or "bbb", r[3], r[4]) for r in rows]
    texts = sorted({word(12) for _ in range(300)})
    df = spark.createDataFrame([(t,) for t in texts], "url string")
    got = labels(rules.first_rule(df, "url", table(spark, rows), default="none"))
    assert got == {t: plain(t, rows, "none") for t in texts}
    assert len(set(got.values())) > 8


def test_defined_cases(spark):
    df = spark.createDataFrame([("ab", 1, "x"), ("ab", 1, "x"), (None, 2, "y"), ("", 3, "z")], "url string, rank int, label string")
    rows = [(2, "prefix", "a", 0, "late"), (1, "prefix", "a", 0, "m"), (1, "prefix", "a", 0, "b"), (1, "prefix", "a", 0, "b"),
            (None, "prefix", "a", 0, "no"), (0, "prefix", None, 0, "no"), (0, "shorter", None, None, "no"),
            (0, "shorter", "", 0, "no"), (0, None, "a", 0, "no"), (0, "other", "a", 0, "no"), (0, "equals", "ab", 0, None)]
    got = rules.first_rule(df, "url", table(spark, rows), "hit", "d")
    assert got.columns == ["url", "rank", "label", "hit"]
    assert sorted(map(tuple, got.fillna("~").collect())) == [
        ("", 3, "z", "d"), ("ab", 1, "x", "b"), ("ab", 1, "x", "b"), ("~", 2, "y", "d")]
    # The output may take the place of a column; an empty prefix or keyword matches all but null.
    for kind in ("prefix", "contains"):
        got = rules.first_rule(df, "url", table(spark, [(0, kind, "", 0, "every")]))
        assert sorted(map(tuple, got.select("url", "label").fillna("~").collect())) == [
            ("", "every"), ("ab", "every"), ("ab", "every"), ("~", "~")]
    none = rules.first_rule(df, "url", table(spark, []), "hit", "d")
    assert {r.hit for r in none.collect()} == {"d"}
    assert rules.first_rule(df.limit(0), "url", table(spark, rows)).count() == 0


def test_length_limits_meet_every_length(spark):
    limits = [1, 2, 3, 7, 8, 11, 64, 100]
    rows = [(limit, "shorter", None, limit, f"under {limit}") for limit in limits]
    df = spark.createDataFrame([("x" * n,) for n in range(120)], "url string")
    got = labels(rules.first_rule(df, "url", table(spark, rows), default="long"))
    for n in range(120):
        assert got["x" * n] == next((f"under {limit}" for limit in limits if n < limit), "long")


def test_plan_does_not_grow_with_the_rules(spark):
    df = spark.range(200).select(F.concat(F.lit("http://h.test/"), F.col("id").cast("string")).alias("url"))

    def plan(n):
        many = spark.range(n).select(
            F.col("id").alias("rank"), F.lit("prefix").alias("kind"),
            F.concat(F.lit("http://h.test/"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("text"),
            F.lit(0).alias("length"), F.col("id").cast("string").alias("label"))
        keyed = rules.cut_lineage(rules.keyed_rules(many))
        text = rules.matches(df, "url", keyed)._jdf.queryExecution().optimizedPlan().toString()
        return len(text.splitlines())

    assert plan(20_000) == plan(10)


def test_a_hot_text_goes_on_once_a_partition(spark):
    """Every row has one text: what is shuffled are pairs of text and key, once a partition."""
    hot = spark.range(0, 40_000, 1, 8).select(F.lit("http://h.test/a/b").alias("url"))
    rows = [(i, "prefix", "http://h.test/a/b"[:i], 0, f"l{i}") for i in range(1, 10)]
    keyed = rules.cut_lineage(rules.keyed_rules(table(spark, rows)))
    found = rules.matches(hot, "url", keyed)
    assert found.count() == 9
    got = rules.first_rule(hot, "url", table(spark, rows))
    assert got.groupBy("label").count().collect()[0][:] == ("l1", 40_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_keyword_tags_by_table_equal_the_written_form(spark):
    texts = ["gold and oil", "oil", "gold", "silver oil gold", "", None, "golden"]
    rows = [(f"k{i % 3}", t) for i, t in enumerate(texts)] + [(None, "gold"), ("k9", "nothing"), ("k8", "crude oil")]
    df = spark.createDataFrame(rows, "k string, t string")
    words = spark.createDataFrame(
        [(0, "oil", "B", False), (1, "gold", "A", True), (1, "silver", "A", True), (1, "silver", "A", None)],
        "rank long, word string, tag string, admits boolean")
    want = classify.keyword_tags(df, "k", "t", ["gold", "silver"], ["oil"], "A", "B", "240101")
    got = rules.keyword_tags_by_table(df, "k", "t", words, "240101")
    assert sorted((r.k, r.tags) for r in got.collect()) == sorted((r.k, r.tags) for r in want.collect())
    assert got.columns == ["k", "part", "tags"]
    assert rules.keyword_tags_by_table(df, "k", "t", words.limit(0), "240101").count() == 0


def test_keys_are_not_shuffled_where_rules_are_broadcast(spark):
    df = spark.range(100).select(F.concat(F.lit("http://h.test/"), F.col("id") % 50).alias("url"))
    keyed = rules.cut_lineage(rules.keyed_rules(table(spark, [(0, "prefix", "http://h.test/1", 0, "a"), (1, "prefix", "http:", 0, "b")])))
    found = rules.hits(df, "url", keyed)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") <= 1 and "Aggregate" not in plan[:plan.index("Generate")]
    assert found.count() == 122 and rules.matches(df, "url", keyed).count() == 61
    assert {len(r.digest) for r in found.collect()} == {16}


def test_keywords_of_all_characters_in_one_pass(spark):
    texts = ["a\U0001f600b", "\U0001f600\U0001f600", "a\nb", "\n\n", "ab", "é\r\nx", ".*", "b"]
    words = ["\U0001f600b", "a\n", "\n\n", "\r\n", ".*", "ab", "b", "\U0001f600", "\nbx"]
    rows = [(i, "contains", w, 0, f"l{i}") for i, w in enumerate(words)]
    df = spark.createDataFrame([(t,) for t in texts], "url string")
    assert labels(rules.first_rule(df, "url", table(spark, rows), default="none")) == {t: plain(t, rows, "none") for t in texts}
    keyed = rules.cut_lineage(rules.keyed_rules(table(spark, rows)))
    # No list of all characters, and no slice of it per place.
    assert "slice(" not in rules.hits(df, "url", keyed)._jdf.queryExecution().optimizedPlan().toString()


def test_rules_of_small_groups_move_no_row(spark, monkeypatch):
    """Broadcast kinds and lengths, shuffled ones, and both together give the same labels."""
    rng = random.Random(11)

    def word(most):
        return "".join(rng.choice("abc") for _ in range(rng.randint(1, most)))

    rows = [(rng.randint(0, 9), rng.choice(["equals", "prefix", "shorter"]), word(6), rng.randint(0, 5), f"l{i}") for i in range(80)]
    rows.append((12, "contains", "ab", 0, "inside"))
    texts = sorted({word(9) for _ in range(200)})
    df = spark.createDataFrame([(t,) for t in texts] * 2 + [(None,)], "url string")
    want = {t: plain(t, rows, "none") for t in texts} | {None: "none"}
    for most, lookups in ((64 << 20, 16), (64 << 20, 3), (0, 16)):
        monkeypatch.setattr(rules, "NEAR_BYTES", most)
        monkeypatch.setattr(rules, "NEAR_LOOKUPS", lookups)
        got = rules.first_rule(df, "url", table(spark, rows), default="none")
        assert got.count() == 2 * len(texts) + 1 and labels(got) == want
    monkeypatch.undo()
    few = [r for r in rows if r[1] == "prefix"]
    plan = rules.first_rule(df, "url", table(spark, few))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
