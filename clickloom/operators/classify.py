"""Filters, classifiers and extractors over parsed columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import blank_to_null, join_sorted

# Second-level and country labels of domain names.
SECOND_LEVEL = "com|net|org|gov|me|name|edu|info|tel|mobi|tv|cc|biz|asia|so|co"
COUNTRY = "cn|hk|us|sg|jp|in|pw|am|ph|tj"
REGISTRABLE = rf"([\w-]+(\.({SECOND_LEVEL}))?(\.({COUNTRY}))?)$"

# Path marks of city and hotel pages in encoded addresses.
CITY_MARK = "%2Fcity%2F"
HOTEL_MARK = "%2Fdt-"
TICKET_MARK = "ticket-"

# Send type of a real-time tag row -> channel code.
SEND_TYPE_CHANNEL = {"0": 2, "1": 3, "3": 4}
DEFAULT_CHANNEL = 1
HASHED_CHANNEL = 3
LONGEST_PLAIN_ID = 32


def contains_any(col: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [col.contains(w) for w in words], F.lit(False))


def starts_with_any(col: Column, prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [col.startswith(p) for p in prefixes], F.lit(False))


def line_filter(df: DataFrame, col: str, all_of: Sequence[str] = (), any_of: Sequence[str] = (),
                none_of: Sequence[str] = (), prefixes: Sequence[str] = ()) -> DataFrame:
    """Substring and prefix tests on one column."""
    c = F.col(col)
    for word in all_of:
        df = df.where(c.contains(word))
    if any_of:
        df = df.where(contains_any(c, any_of))
    if prefixes:
        df = df.where(starts_with_any(c, prefixes))
    for word in none_of:
        df = df.where(~c.contains(word))
    return df


def matches_campaign(col: Column, campaign: str, strict: bool = False) -> Column:
    """A non-digit, then the campaign id.

    The default also accepts longer numbers that start with the id; ``strict``
    demands that the number ends there.
    """
    tail = r"(\D|$)" if strict else r"\D?"
    return F.coalesce(col.rlike(rf"\D{re.escape(campaign)}{tail}"), F.lit(False))


def keyword_tags(df: DataFrame, key: str, text: str, words: Sequence[str], special_words: Sequence[str],
                 tag: str, special_tag: str, day: str) -> DataFrame:
    """Tags per key of all texts holding one of ``words``, as ``tag@day;...``."""
    hit = df.where(contains_any(F.col(text), words) & F.col(key).isNotNull())
    is_special = contains_any(F.col(text), special_words)
    flags = hit.groupBy(key).agg(
        F.max(is_special).alias("special"), F.max(~is_special).alias("plain")
    )
    # Two possible tags: two flags per key, no list has to be gathered.
    found = F.array_compact(
        F.array(F.when(F.col("plain"), F.lit(tag)), F.when(F.col("special"), F.lit(special_tag)))
    )
    return flags.select(key, join_sorted(F.transform(found, lambda t: F.concat(t, F.lit(f"@{day}"))), ";").alias("tags"))


@dataclass(frozen=True)
class PageRule:
    """``kind`` is ``equals``, ``prefix`` or ``shorter`` (than ``length`` characters)."""

    kind: str
    label: str
    text: str = ""
    length: int = 0

    def test(self, url: Column) -> Column:
        if self.kind == "equals":
            return url == self.text
        if self.kind == "prefix":
            return url.startswith(self.text)
        if self.kind == "shorter":
            return F.length(url) < self.length
        raise ValueError(self.kind)


# Fixed value: the label of an address that no rule covers.
UNKNOWN_PAGE = "unkown"


def shop_page_rules(site: str) -> list[PageRule]:
    """Page types of a ticket shop. The first matching rule wins, so order counts."""
    root = f"http://www.{site}/"
    # Path prefix and page type.
    return [
        PageRule("equals", "head", root),
        PageRule("prefix", "search", root + "s/"),
        PageRule("prefix", "product", root + "ticket-"),
        PageRule("shorter", "area", length=len(root) + 4),
        PageRule("prefix", "reg", root + "customer/reg.html"),
        PageRule("prefix", "help", root + "help"),
        PageRule("prefix", "shopcart", root + "shopCart"),
        PageRule("prefix", "integral", root + "integral"),
        PageRule("prefix", "subject", root + "subject"),
        PageRule("prefix", "ticket", root + "common/ticket.html"),
        PageRule("prefix", "news", root + "news"),
        PageRule("prefix", "venue", root + "venue"),
        PageRule("prefix", "login", f"http://login.{site}/login"),
        PageRule("prefix", "cart", root + "cart"),
        PageRule("prefix", "pay", root + "pay"),
        PageRule("prefix", "security", root + "security"),
        PageRule("prefix", "order", root + "personorders/myorder.html"),
        PageRule("prefix", "citiccard", f"http://citiccard.{site}"),
    ]


def page_type(url: Column, rules: Sequence[PageRule], default: str = UNKNOWN_PAGE) -> Column:
    typed = None
    for rule in rules:
        test = rule.test(url)
        typed = F.when(test, rule.label) if typed is None else typed.when(test, rule.label)
    return F.lit(default) if typed is None else typed.otherwise(default)


def host(url: Column) -> Column:
    bare = F.regexp_replace(url, r"^https?://", "")
    return F.lower(F.regexp_replace(bare, r"/.*$|\?.*$|:.*$", ""))


def registrable_domain(url: Column) -> Column:
    """Last label in front of the known suffixes, with them; NULL when nothing fits."""
    return blank_to_null(F.regexp_extract(host(url), REGISTRABLE, 1))


def city_hotel_item(address: Column) -> Column:
    """``city_hotel`` out of an encoded address; NULL unless both are complete.

    The city takes at least two characters; each value must end with ``%``.
    """
    after_city = F.get(F.split(address, CITY_MARK, 2), F.lit(1))
    city_split = F.split(after_city, "%", 2)
    city = F.get(city_split, F.lit(0))
    rest = F.concat(F.lit("%"), F.get(city_split, F.lit(1)))
    hotel_split = F.split(F.get(F.split(rest, HOTEL_MARK, 2), F.lit(1)), "%", 2)
    hotel = F.when(F.size(hotel_split) == 2, F.get(hotel_split, F.lit(0)))
    complete = ~address.startswith(CITY_MARK) & (F.length(city) > 1) & (F.length(hotel) > 0)
    return F.when(complete, F.concat_ws("_", city, hotel))


def ticket_item(line: Column) -> Column:
    """Text between the first ``ticket-`` and the next dot."""
    return F.substring_index(F.get(F.split(line, TICKET_MARK), F.lit(1)), ".", 1)


def ticket_page_item(url: Column, site: str) -> Column:
    """Ticket id of a ticket page address, else NULL."""
    prefix = f"http://www.{site}/{TICKET_MARK}"
    after = F.get(F.split(url, re.escape(prefix), 2), F.lit(1))
    return blank_to_null(F.substring_index(after, ".html", 1))


def relabel_codes(df: DataFrame, key: str, names: DataFrame, code: str = "code", name: str = "name",
                  keep: str = "All") -> DataFrame:
    """Swap the key's last ``_`` part for its name; rows without a name are dropped."""
    unique = names.groupBy(F.col(code).alias("__code")).agg(F.min(name).alias("__name"))
    coded = df.withColumn("__code", F.substring_index(F.col(key), "_", -1))
    joined = coded.join(unique, ["__code"], "left")
    label = F.when(F.col("__code") == keep, F.lit(keep)).otherwise(F.col("__name"))
    stem = F.substr(F.col(key), F.lit(1), F.length(key) - F.length("__code"))
    return joined.withColumn("__label", label).where(F.col("__label").isNotNull()).withColumn(
        key, F.concat(stem, F.col("__label"))
    ).drop("__code", "__name", "__label")


def export_pairs(df: DataFrame, main: str, tag: str, other_ids: Sequence[str]) -> DataFrame:
    """One wide row -> (main id, tag) and (other id, main id) for each id present."""
    pairs = [F.struct(F.col(main).alias("id"), F.col(tag).alias("val"))]
    pairs += [
        F.when(blank_to_null(F.col(c)).isNotNull(), F.struct(F.col(c).alias("id"), F.col(main).alias("val")))
        for c in other_ids
    ]
    return df.select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).select("p.id", "p.val")


def channel_code(send_type: Column) -> Column:
    code = None
    for text, number in SEND_TYPE_CHANNEL.items():
        code = F.when(send_type == text, number) if code is None else code.when(send_type == text, number)
    return code.otherwise(DEFAULT_CHANNEL)


def channel_ids(df: DataFrame, send_type: str = "send_type", channel_id: str = "channel_id") -> DataFrame:
    """Add the channel code; over-long ids of the hashed channel become their md5."""
    code = channel_code(F.col(send_type))
    hashed = (code == HASHED_CHANNEL) & (F.length(channel_id) > LONGEST_PLAIN_ID)
    return df.withColumn("channel", code).withColumn(
        channel_id, F.when(hashed, F.md5(F.col(channel_id))).otherwise(F.col(channel_id))
    )
