"""Rules out of a table of any size: the first one that matches a text, keyword tags.

A text is turned into the keys that could match it: itself, its prefixes of the lengths
in use, its substrings of the lengths in use, and one key per bit of the length limits in
use. Keys meet the rules in an equi-join. The plan does not grow with the rules; the
lengths in use, at most one per character of the longest rule, come to the driver.

Keys that no rule has are dropped by a bounded Bloom filter on the spot, so texts are not
shuffled: what goes on is a digest of the text and a key. (Above 33 million keys of rules
there is no filter, and all keys are shuffled.) A key that many texts share comes straight
from a shuffle against a stored table, so adaptive execution splits it; so does a text that
many rows share, when labels are joined back.

For the first rule, the kinds and lengths with the fewest rules are looked up in broadcast
tables, as long as these are small: such a key needs one join and moves nothing, so neither
keys nor rows of texts are shuffled for it. Keywords, and the other kinds and lengths, go
the way above, and only texts that a filter takes for theirs meet the labels found so.

Defined cases. Equal ranks: the least label wins. Repeated rules count once. A rule with
a null in its kind, rank or label, or in the text or length that its kind needs, never
matches; nor does a limit of 0 or less. An empty prefix or keyword matches every text but
null. A null text, and one without a rule, gets the default. A text of n characters gives
up to n keyword keys for each keyword length in use, held in one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.bloom import might_be_member, split_members
from clickloom.operators.classify import PageRule
from clickloom.operators.rendering import text_parts
from clickloom.session import cut_lineage

RULE_SCHEMA = "rank long, kind string, text string, length int, label string"
KEY = ("kind", "at", "text")
LENGTH_BITS = 31
# Rules that are broadcast: this many bytes in all, and a bound on the joins of a plan.
NEAR_BYTES = 64 << 20
NEAR_LOOKUPS = 16
# Of a broadcast row besides its texts.
ROW_BYTES = 64


def rule_table(spark: SparkSession, rules: Sequence[PageRule]) -> DataFrame:
    """A written rule list as a table; its order becomes the rank."""
    rows = [(rank, r.kind, r.text, r.length, r.label) for rank, r in enumerate(rules)]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _shifted(number: Column, bits: Column) -> Column:
    return F.call_function("shiftright", number, bits)


def _blocks(limit: Column) -> Column:
    """``0 .. limit - 1`` as blocks of powers of two: for each bit set, (bit, a length without its lower bits)."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(LENGTH_BITS - 1)), lambda b: _shifted(limit, b).bitwiseAND(F.lit(1)) == 1)
    return F.transform(bits, lambda b: F.struct(b.alias("at"), (_shifted(limit, b) - 1).cast("string").alias("text")))


def keyed_rules(rules: DataFrame) -> DataFrame:
    """Rules with the keys (kind, at, text) under which a text finds them.

    ``at`` is the length of a prefix or keyword, the bit of a length limit, else 0.
    """
    kind = F.col("kind")
    size = F.when(kind.isin("prefix", "contains"), F.length("text")).otherwise(0)
    own = F.when(F.col("text").isNotNull(), F.array(F.struct(size.alias("at"), F.col("text"))))
    below = F.when(F.col("length") > 0, _blocks(F.col("length")))
    keys = F.when(kind == "shorter", below).when(kind.isin("equals", "prefix", "contains"), own)
    usable = rules.where(F.col("rank").isNotNull() & F.col("label").isNotNull())
    others = [c for c in rules.columns if c not in ("kind", "text", "length")]
    return usable.select("kind", F.explode(keys).alias("key"), *others).select("kind", "key.*", *others)


def _keys_of(text: Column, used: Sequence[tuple[str, int]]) -> Column:
    """All keys of a text with a (kind, at) in use."""
    def key(kind: str, at: Column, piece: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("at"), piece.alias("text"))

    def numbers(kind: str) -> list[int]:
        return sorted(at for k, at in used if k == kind)

    def fitting(kind: str) -> Column:
        return F.filter(F.lit(numbers(kind)), lambda n: n <= F.length(text))

    def windows(n: Column) -> Column:
        # In one pass: a character is taken where n of them follow from it on, which are the group.
        ahead = F.concat(F.lit("(?s)(?=(.{"), n.cast("string"), F.lit("}))."))
        found = F.when(n > 0, F.regexp_extract_all(text, ahead, F.lit(1))).otherwise(F.array(F.lit("")))
        return F.transform(F.array_distinct(found), lambda piece: key("contains", n, piece))

    parts = []
    if numbers("equals"):
        parts.append(F.array(key("equals", F.lit(0), text)))
    if numbers("prefix"):
        parts.append(F.transform(fitting("prefix"), lambda n: key("prefix", n, F.substr(text, F.lit(1), n))))
    if numbers("contains"):
        parts.append(F.flatten(F.transform(fitting("contains"), windows)))
    if numbers("shorter"):
        parts.append(F.transform(
            F.lit(numbers("shorter")), lambda b: key("shorter", b, _shifted(F.length(text), b).cast("string"))))
    return F.concat(*parts)


def _digest(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def hits(df: DataFrame, text: str, keyed: DataFrame) -> DataFrame | None:
    """(digest of the text, a row of ``keyed`` that matches it), for each row of ``df``; None without any rule.

    Equal texts give equal rows, so what is made of them has to be the same for one and for many. Where
    ``keyed`` is broadcast, a grouping by digest brings the keys of a text together before anything is shuffled.
    ``keyed`` should be a stored table; it is read for the keys in use, the filter and the join.
    """
    used = [(r["kind"], r["at"]) for r in keyed.select("kind", "at").distinct().collect()]
    if not used:
        return None
    value = F.col(f"`{text}`")
    keys = df.where(value.isNotNull()).select(_digest(value).alias("digest"), F.explode(_keys_of(value, used)).alias("key"))
    return might_be_member(keys.select("digest", "key.*"), keyed, KEY).join(keyed, list(KEY))


def matches(df: DataFrame, text: str, keyed: DataFrame) -> DataFrame | None:
    """:func:`hits`, each once."""
    found = hits(df, text, keyed)
    return None if found is None else found.distinct()


def _own_key(text: Column, kind: str, at: int) -> Column:
    """The only key of a text with that kind (not ``contains``) and ``at``; it may be one that no rule has."""
    if kind == "equals":
        return text
    if kind == "prefix":
        return F.substr(text, F.lit(1), F.lit(at))
    return _shifted(F.length(text), F.lit(at)).cast("string")


def _near_groups(keyed: DataFrame) -> list[tuple[str, int]]:
    """The (kind, at) whose rules are broadcast: the smallest ones, within the bounds."""
    size = F.sum(F.octet_length("text") + F.octet_length("label") + F.lit(ROW_BYTES)).alias("size")
    groups = keyed.where("kind <> 'contains'").groupBy("kind", "at").agg(size).orderBy("size", "kind", "at")
    near, total = [], 0
    for row in groups.limit(NEAR_LOOKUPS).collect():
        total += row["size"]
        if total > NEAR_BYTES:
            break
        near.append((row["kind"], row["at"]))
    return near


def _with_near(rows: DataFrame, keyed: DataFrame, groups: Sequence[tuple[str, int]]) -> DataFrame:
    """``rows`` (row, text) with ``near``, the best (rank, label) of the rules of ``groups``, null without one."""
    found = []
    for kind, at in groups:
        name, mark = f"best_{kind}_{at}", f"key_{kind}_{at}"
        # Stored each, so that a lookup reads its own rules only.
        table = cut_lineage(keyed.where((F.col("kind") == kind) & (F.col("at") == at)).select(
            F.col("text").alias(mark), F.struct("rank", "label").alias(name)))
        rows = rows.join(F.broadcast(table), _own_key(F.col("text"), kind, at) == F.col(mark), "left")
        found.append(F.col(name))
    none = F.lit(None).cast(keyed.select(F.struct("rank", "label").alias("best")).schema["best"].dataType)
    return rows.select("row", "text", F.least(none, none, *found).alias("near"))


def first_rule(df: DataFrame, text: str, rules: DataFrame, out: str = "label", default: str | None = None) -> DataFrame:
    """``df`` with the label of the first rule, by rank, that matches ``text``, as ``out``.

    ``rules``: rank, kind (``equals``, ``prefix``, ``contains``, or ``shorter`` than length
    characters), text, length, label.
    """
    best = F.min(F.struct("rank", "label")).alias("best")
    keyed = keyed_rules(rules.select("rank", "kind", "text", "length", "label")).groupBy(*KEY).agg(best)
    keyed = cut_lineage(keyed.select(*KEY, "best.*"))
    groups = _near_groups(keyed)
    near = F.lit(False)
    for kind, at in groups:
        near = near | ((F.col("kind") == kind) & (F.col("at") == at))
    # The caller's columns travel in a struct, whatever their names.
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    kept = [F.col("row")[c].alias(c) for c in df.columns if c != out]

    def labelled(rows: DataFrame, first: Column) -> DataFrame:
        return rows.select(*kept, F.coalesce(first["label"], F.lit(default)).alias(out))

    looked_up = _with_near(held, keyed, groups)
    found = hits(df, text, keyed.where(~near))
    if found is None:
        return labelled(looked_up, F.col("near"))
    far = cut_lineage(found.groupBy("digest").agg(best).select("digest", F.col("best").alias("far")))
    likely, others = split_members(
        looked_up.withColumn("digest", _digest(F.col("text"))), far, ["digest"], far.count())
    # Stored, as the rows are read for it once more.
    mended = cut_lineage(labelled(likely.join(far, ["digest"], "left"), F.least("near", "far")))
    return labelled(others, F.col("near")).unionByName(mended)


def keyword_tags_by_table(df: DataFrame, key: str, text: str, words: DataFrame, day: str) -> DataFrame:
    """Tags per key of all texts with an admitting word, as ``tag@day;...`` in parts.

    ``words``: rank, word, tag, admits. A text without any word that admits it has no tag;
    one with such a word gets the tag of the least rank among all of its words (with equal
    ranks the least tag). Rows without a key are left out.
    """
    rules = words.select(
        "rank", F.lit("contains").alias("kind"), F.col("word").alias("text"), F.col("tag").alias("label"),
        F.lit(None).cast("int").alias("length"), F.coalesce("admits", F.lit(False)).alias("admits"))
    tag = [F.max("admits").alias("admits"), F.min(F.struct("rank", "label")).alias("best")]
    keyed = cut_lineage(keyed_rules(rules).groupBy(*KEY).agg(*tag).select(*KEY, "admits", "best.*"))
    rows = df.where(F.col(f"`{key}`").isNotNull())
    found = hits(rows, text, keyed)
    if found is None:
        return rows.select(F.col(f"`{key}`").alias(key), F.lit(0).alias("part"), F.lit("").alias("tags")).limit(0)
    labels = cut_lineage(found.groupBy("digest").agg(*tag).where("admits").select("digest", F.col("best.label").alias("label")))
    tagged = rows.select(F.col(f"`{key}`").alias(key), _digest(F.col(f"`{text}`")).alias("digest")).join(labels, ["digest"])
    entry = F.concat("label", F.lit(f"@{day}"))
    return text_parts(tagged.select(key, "label").distinct(), [key], entry, ";", "tags")
