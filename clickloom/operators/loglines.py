"""Load delimited and key/value log lines into typed tables.

Every loader maps ``DataFrame(value string, ...)`` to typed columns with plain
column expressions; other input columns (channel, day, ...) pass through.
Missing markers become NULL here, so later operators only meet NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import blank_to_null, let, safe_map

# Separators of the log formats.
KV_SEPARATOR = r"\|~\||\|\|"
FIELD_SEPARATOR = r"\|~\||\t"

# Field names of the two page-view layouts.
PAGE_VIEW_NEW = ("time", "ip", "agsid", "tid", "url", "query", "useragent")
PAGE_VIEW_OLD = (
    "time", "ip", "custid", "eventid", "agsid", "evtp1", "evtp2", "evtp3", "evtp4",
    "tid", "url", "cookie", "query", "useragent", "creative", "keyword",
)
# Fixed value: search landing marker in page-view lines.
SEARCH_LANDING = "ag_kwid"

# Longer than any line has pieces; a start added to it must not overflow.
ALL_PIECES = 1 << 30

SHOW_FIELDS = ("time", "ssp", "adxreq", "guid", "agsid", "ua", "site", "bidtag", "bkid")
CLICK_FIELDS = ("time", "ssp", "reqid", "guid", "agsid")
BID_FIELDS = ("time", "ssp", "reqId", "Threadid", "guid", "agsid", "url", "usertags", "hittags", "bidtag", "ads")
MATCH_FIELDS = ("time", "ssp", "guid", "agsid")


def _entry(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def _split_entry(segment: Column, when_bare: str) -> Column:
    """``k=v`` cut at the first ``=``; a bare segment is the key, or dropped later as ''."""
    cut = F.locate("=", segment)
    bare_key = segment if when_bare == "key" else F.lit("")
    return _entry(
        F.when(cut > 0, F.substring_index(segment, "=", 1)).otherwise(bare_key),
        F.when(cut > 0, F.substr(segment, cut + 1)).otherwise(F.lit("")),
    )


def _split_trimmed(text: Column, separator: str) -> Column:
    """Split without the empty pieces at the end."""

    def trim(pieces: Column) -> Column:
        filled = F.transform(F.reverse(pieces), lambda p: p != "")
        ahead = F.array_position(filled, True).cast("int")
        return F.when(ahead > 0, F.slice(pieces, F.lit(1), F.size(pieces) - ahead + 1)).otherwise(
            F.slice(pieces, F.lit(1), F.lit(0))
        )

    return let(F.split(text, separator), trim)


def kv_entries(line: Column) -> Column:
    """Entries of a key/value line, the line's time last so that it wins."""
    time = F.array(_entry(F.lit("time"), F.substring(line, 1, 19)))
    # The piece in front of the first separator is the time.
    rest = F.slice(_split_trimmed(line, KV_SEPARATOR), F.lit(2), F.lit(ALL_PIECES))
    return F.concat(F.transform(rest, lambda s: _split_entry(s, "key")), time)


def kv_map(line: Column) -> Column:
    return safe_map(kv_entries(line))


def query_map(text: Column, sep: str = "&") -> Column:
    """Query-string map: entries without ``=`` or with an empty key are dropped."""
    entries = F.transform(F.split(text, sep), lambda s: _split_entry(s, "drop"))
    return safe_map(F.filter(entries, lambda e: e["key"] != ""))


def pick_fields(df: DataFrame, names: Sequence[str], fields: str = "fields",
                rename: Mapping[str, str] | None = None) -> DataFrame:
    """Named map entries as columns, both missing markers as NULL."""
    rename = rename or {}
    picked = [blank_to_null(F.col(fields)[n]).alias(rename.get(n, n)) for n in names]
    kept = [c for c in df.columns if c not in (fields, "value") and c not in {rename.get(n, n) for n in names}]
    return df.select(*kept, *picked)


def load_kv(lines: DataFrame) -> DataFrame:
    """All entries of each line as a map column."""
    return lines.withColumn("fields", kv_map(F.col("value")))


# The typed loaders below know the fields they want. They look each one up in
# the split line instead of building a map of everything the line holds.

def segments(line: Column) -> Column:
    """Key/value pieces of a line, the leading time left out.

    Empty pieces at the end stay; no lookup finds them.
    """
    return F.slice(F.split(line, KV_SEPARATOR), F.lit(2), F.lit(ALL_PIECES))


def _last_named(pieces: Column, name: str) -> Column:
    """Last piece with this key, with or without a value; NULL when there is none."""
    return F.try_element_at(
        F.filter(pieces, lambda p: p.startswith(f"{name}=") | (p == name)), F.lit(-1)
    )


def _value_of(piece: Column, name: str) -> Column:
    return F.substr(piece, F.lit(len(name) + 2))


def _lookup(pieces: Column, name: str) -> Column:
    return F.substring(F.col("value"), 1, 19) if name == "time" else _value_of(_last_named(pieces, name), name)


def _normalised(df: DataFrame, raw: Mapping[str, Column], keep_line: bool = False) -> DataFrame:
    """Raw values as columns, then both missing markers as NULL.

    The raw values pass through ``inline``: a later filter on a loaded column
    then stays above it and does not take the line apart a second time.
    """
    kept = [c for c in df.columns if c not in raw and c != "value" and not c.startswith("__")]
    line = [F.col("value").alias("line")] if keep_line else []
    row = F.struct(*[c.alias(n) for n, c in raw.items()])
    staged = df.select(*kept, *line, F.inline(F.array(row)))
    return staged.select(*kept, *(["line"] if keep_line else []), *[blank_to_null(F.col(n)).alias(n) for n in raw])


def _query_value(address: Column, name: str) -> Column:
    """Last value of a query-string key; NULL when absent."""
    return F.substr(
        F.try_element_at(F.filter(F.split(address, "&"), lambda p: p.startswith(f"{name}=")), F.lit(-1)),
        F.lit(len(name) + 2),
    )


def _cookie_id(cookie: Column) -> Column:
    """Last piece of more than three characters around ``agsid=``, up to ``;``."""
    pieces = F.filter(F.split(cookie, "agsid="), lambda p: F.length(p) > 3)
    found = F.substring_index(F.try_element_at(pieces, F.lit(-1)), ";", 1)
    return F.when(cookie.contains("agsid="), found)


def _with_fallback_ids(lines: DataFrame, names: Sequence[str], address_key: str) -> DataFrame:
    """Cookie id out of the cookie text, user id out of the request address, where absent."""
    split = lines.withColumn("__s", segments(F.col("value")))
    pieces = F.col("__s")
    staged = split.select(
        "*", _lookup(pieces, "agsid").alias("__agsid"), _lookup(pieces, "cookie").alias("__cookie"),
        _last_named(pieces, "guid").alias("__guid"), _lookup(pieces, address_key).alias("__address"),
    )
    # An explicit empty cookie id is not replaced; only an absent one or ``null`` is.
    replaced = F.coalesce(F.col("__agsid"), F.lit("null")) == "null"
    agsid = F.when(replaced, _cookie_id(F.col("__cookie"))).otherwise(F.col("__agsid"))
    guid = F.when(F.col("__guid").isNotNull(), _value_of(F.col("__guid"), "guid")).otherwise(
        _query_value(F.col("__address"), "guid")
    )
    own = {"agsid": agsid, "guid": guid}
    return _normalised(staged, {n: own[n] if n in own else _lookup(pieces, n) for n in names})


def load_show(lines: DataFrame, names: Sequence[str] = SHOW_FIELDS) -> DataFrame:
    return _with_fallback_ids(lines, names, "requestUrl")


def load_click(lines: DataFrame, names: Sequence[str] = CLICK_FIELDS) -> DataFrame:
    return _with_fallback_ids(lines, names, "refurl")


def load_cookie_match(lines: DataFrame, names: Sequence[str] = MATCH_FIELDS) -> DataFrame:
    """The user id is the value of the key ``Matching ... google_gid``."""
    split = lines.withColumn("__s", segments(F.col("value")))
    pieces = F.col("__s")

    def is_match(piece: Column) -> Column:
        return piece.startswith("Matching ") & F.substring_index(piece, "=", 1).endswith("google_gid")

    matching = F.try_element_at(F.array_sort(F.filter(pieces, is_match)), F.lit(1))
    staged = split.withColumn("__match", matching)
    match = F.col("__match")
    matched = F.when(match.contains("="), F.substr(match, F.locate("=", match) + 1)).when(match.isNotNull(), "")
    own = {"guid": F.coalesce(matched, _lookup(pieces, "guid"))}
    return _normalised(staged, {n: own[n] if n in own else _lookup(pieces, n) for n in names})


def load_bid(lines: DataFrame, names: Sequence[str] = BID_FIELDS, keep_line: bool = False) -> DataFrame:
    """Bid lines; ids come from ``userId`` and ``agUserId``.

    A thread field ``id,k=v,k=v`` is taken apart: the first piece is the thread
    id and each later pair with a value wins over a field of the same name.
    """
    split = lines.withColumn("__s", segments(F.col("value")))
    pieces, thread = F.col("__s"), F.col("__thread")
    listed = F.split(F.regexp_replace(_lookup(pieces, "Threadid"), ",+$", ""), ",")
    staged = split.withColumn("__thread", F.when(F.size(listed) > 1, listed))
    tail = F.slice(thread, F.lit(2), F.size(thread))

    def threaded(name: str) -> Column:
        bare = F.transform(
            F.filter(tail, lambda p: p.startswith(f"{name}=")), lambda p: F.regexp_replace(p, "=+$", "")
        )
        named = F.filter(bare, lambda p: p.startswith(f"{name}="))
        return _value_of(F.try_element_at(named, F.lit(-1)), name)

    def field(name: str) -> Column:
        if name == "Threadid":
            return F.coalesce(F.get(thread, F.lit(0)), _lookup(pieces, name))
        return F.coalesce(threaded(name), _lookup(pieces, name))

    own = {"guid": field("userId"), "agsid": field("agUserId")}
    return _normalised(staged, {n: own[n] if n in own else field(n) for n in names}, keep_line)


def load_page_views(lines: DataFrame, names: Sequence[str] = PAGE_VIEW_NEW, parse_query: bool = False,
                    keep_line: bool = False) -> DataFrame:
    """Fields by position: seven fields are the new layout, anything else the old one.

    Trailing empty fields are cut before the fields are counted. With
    ``parse_query`` a name may also be a query-string key, which then wins.
    """
    items = F.col("__items")
    split = lines.withColumn("__items", _split_trimmed(F.col("value"), FIELD_SEPARATOR))

    def positional(name: str) -> Column:
        def at(layout: Sequence[str]) -> Column:
            return F.get(items, F.lit(layout.index(name))) if name in layout else F.lit(None).cast("string")

        return F.when(F.size(items) == len(PAGE_VIEW_NEW), at(PAGE_VIEW_NEW)).otherwise(at(PAGE_VIEW_OLD))

    staged = split.withColumn("__query", positional("query")) if parse_query else split

    def field(name: str) -> Column:
        if not parse_query:
            return positional(name)
        return F.coalesce(_query_value(F.col("__query"), name), positional(name))

    return _normalised(staged, {n: field(n) for n in names}, keep_line)


def field_count(line: Column) -> Column:
    """Number of fields, trailing empty ones included."""
    return F.size(F.split(line, FIELD_SEPARATOR, -1))


def route_page_views(lines: DataFrame, marker: str = SEARCH_LANDING) -> DataFrame:
    """Seven-field lines that carry the marker, and every sixteen-field line."""
    n = field_count(F.col("value"))
    return lines.where(((n == 7) & F.col("value").contains(marker)) | (n == 16))


def split_malformed(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows that lack a required column)."""
    bad = F.lit(False)
    for name in required:
        bad = bad | F.col(name).isNull()
    return df.where(~bad), df.where(bad)


def unpack_tag_export(lines: DataFrame, marker: str, keep: Sequence[str] = ()) -> DataFrame:
    """Tag-export text -> (day, aguid, item), one row per well-formed marked tag, after the columns ``keep``.

    A tag is cut after the marker and before ``@``; its ``_`` pieces holding
    ``-`` or ``%`` are dropped and at least two must remain.
    """
    pieces = F.split(F.col("value"), ",")
    # The user id may stand anywhere in the line; the last well-formed one counts.
    ids = F.filter(
        F.transform(pieces, lambda p: F.regexp_extract(p, 'aguid":"([^"]+)', 1)), lambda p: p != ""
    )
    tags = F.filter(pieces, lambda p: p.contains(marker) & ~p.contains("aguid"))
    exploded = lines.where(F.col("value").contains(marker)).select(
        *keep, F.coalesce(F.try_element_at(ids, F.lit(-1)), F.lit("")).alias("aguid"), F.explode(tags).alias("tag")
    )
    body = F.substring_index(F.element_at(F.split(F.col("tag"), marker), 2), "@", 1)
    kept = F.filter(
        F.split(F.regexp_replace(body, "_+$", ""), "_"), lambda p: ~p.contains("-") & ~p.contains("%")
    )
    day_text = F.substring_index(F.element_at(F.split(F.col("tag"), "@"), 2), '"', 1)
    day = F.when(F.col("tag").contains("@"), F.substring(day_text, 1, 6)).otherwise("no_time")
    return exploded.select(
        *keep, day.alias("day"), "aguid", F.array_join(kept, "_").alias("item"), F.size(kept).alias("n")
    ).where(F.col("n") > 1).drop("n")


def tag_values(tags: Column, marker: str = "{X:DI") -> Column:
    """Values of the marked entries of a bracketed tag list, with ``All`` in front."""
    inner = F.when(F.length(tags) >= 2, F.substr(tags, F.lit(2), F.length(tags) - 2)).otherwise("")
    marked = F.filter(F.split(inner, '","'), lambda t: t.contains(marker))
    values = F.transform(
        marked, lambda t: F.substring_index(F.element_at(F.split(t, ",V:", 2), -1), ",", 1)
    )
    return F.concat(F.array(F.lit("All")), F.coalesce(values, F.array().cast("array<string>")))
