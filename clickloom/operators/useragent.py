"""User-agent columns and the browser report."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.metrics import uv_pv

# Keywords by kind.
BROWSERS = (
    "TencentTraveler", "QQBrowser", "Maxthon", "BIDUBrowser", "360SE", "TheWorld", "qihu theworld",
    "UCBrowser", "Firefox", "Chrome", "MSIE", "MQQBrowser", "NokiaBrowser", "Iceweasel",
    "K-MeleonCCFME", "Opera", "BdMobile", "UC", "Safari", "Mobile", "UCWEB", "SE 2.X", "Trident", "spider",
)
KERNELS = ("AppleWebKit", "Presto", "Gecko", "KHTML")
SYSTEMS = ("SymbianOS", "Mac OS X", "Android", "Windows NT", "Adr", "Linux")
# Windows NT version -> product.
WINDOWS_NAMES = {
    "5.0": "Windows 2000",
    "5.1": "Windows XP",
    "5.2": "Windows 2003",
    "6.0": "Windows Vista",
    "6.1": "Windows 7",
    "6.3": "Windows 8",
}
# Patterns of versions and device names.
VERSION_TAIL = r"([0-9/. ]*)"
VERSION_CHARACTERS = "0123456789/. "
IE_VERSION = r"rv:(\d+)"
ANDROID_BUILD = r"([\w -]+)( Build/)"
ANDROID_LAST_FIELD = r"; ([\w -]+)\)"
MAC_DEVICE = r"\( *([a-zA-Z]+) *;"
MAC_VERSION = r"OS ([0-9_]+)"
LINUX_VERSION = r"Linux ([\w-]+)"
NUMERIC_DEVICE = r"^[\d\- _]+$"

UA_COLUMNS = ("browser", "browser_version", "kernel", "kernel_version", "os", "os_version", "hardware")


def _keyword_pattern() -> str:
    """Longest keyword first, so that no keyword hides a longer one."""
    words = sorted(BROWSERS + KERNELS + SYSTEMS, key=lambda w: (-len(w), w))
    return "(" + "|".join(re.escape(w) for w in words) + ")" + VERSION_TAIL


def _bare(version: Column) -> Column:
    return F.translate(version, " /", "")


def with_user_agent(df: DataFrame, ua: str = "ua") -> DataFrame:
    """Add browser, kernel, system and hardware columns.

    The keywords are read from left to right. The first browser counts, only
    Safari gives way to another; the last kernel and the last system count.
    """
    pattern = F.lit(_keyword_pattern())
    text = F.coalesce(F.col(ua), F.lit(""))
    # Every keyword ends in a letter, so a match splits at its last letter.
    found = F.transform(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda m: F.struct(
            F.rtrim(m, F.lit(VERSION_CHARACTERS)).alias("word"),
            F.substr(m, F.length(F.rtrim(m, F.lit(VERSION_CHARACTERS))) + 1).alias("ver"),
        ),
    )
    base = df.withColumn("__f", found)

    def of_kind(words: tuple[str, ...]) -> Column:
        return F.filter("__f", lambda x: x["word"].isin(*words))

    last = F.lit(-1)
    browsers = of_kind(BROWSERS)
    steady = F.filter(browsers, lambda x: x["word"] != "Safari")
    base = base.withColumn(
        "__b", F.coalesce(F.try_element_at(steady, F.lit(1)), F.try_element_at(browsers, last))
    ).withColumn("__k", F.try_element_at(of_kind(KERNELS), last)).withColumn("__systems", of_kind(SYSTEMS))
    base = base.withColumn("__s", F.try_element_at(F.col("__systems"), last))

    is_trident = F.col("__b.word") == "Trident"
    rv = F.regexp_extract(text, IE_VERSION, 1)
    browser_version = F.when(is_trident & (rv != ""), rv).otherwise(F.col("__b.ver"))

    has_android = F.exists("__systems", lambda x: x["word"].isin("Android", "Adr"))
    has_mac = F.exists("__systems", lambda x: x["word"] == "Mac OS X")
    build = F.regexp_extract(text, ANDROID_BUILD, 1)
    tail = F.concat(F.lit(";"), F.substring_index(text, ";", -1))
    last_field = F.when(text.contains(";"), F.regexp_extract(tail, ANDROID_LAST_FIELD, 1)).otherwise("")
    android_device = F.when(has_android, F.when(build != "", build).otherwise(last_field)).otherwise("")
    after_mac = F.concat(F.lit("Mac OS X"), F.substring_index(text, "Mac OS X", -1))
    mac_device = F.when(has_mac, F.regexp_extract(after_mac, MAC_DEVICE, 1)).otherwise("")
    system = F.col("__s.word")
    device = F.trim(
        F.when(system == "Mac OS X", F.when(mac_device != "", mac_device).otherwise(android_device))
        .otherwise(F.when(android_device != "", android_device).otherwise(mac_device))
    )

    mac_version = F.regexp_extract(after_mac, MAC_VERSION, 1)
    after_linux = F.concat(F.lit("Linux"), F.substring_index(text, "Linux", -1))
    linux_version = F.regexp_extract(after_linux, LINUX_VERSION, 1)
    raw_version = (
        F.when((system == "Mac OS X") & (mac_version != ""), mac_version)
        .when((system == "Linux") & (linux_version != ""), linux_version)
        .otherwise(F.col("__s.ver"))
    )
    version = _bare(raw_version)
    is_android = system.isin("Android", "Adr")
    named = F.when(is_android, "Android")
    for nt, product in WINDOWS_NAMES.items():
        named = named.when((system == "Windows NT") & (version == nt), product)

    empty = F.lit("")
    columns = {
        "browser": F.coalesce(F.when(is_trident, "MSIE").otherwise(F.col("__b.word")), empty),
        "browser_version": F.coalesce(F.substring_index(_bare(browser_version), ".", 1), empty),
        "kernel": F.coalesce(F.col("__k.word"), empty),
        "kernel_version": F.coalesce(_bare(F.col("__k.ver")), empty),
        "os": F.coalesce(named.otherwise(system), empty),
        "os_version": F.coalesce(
            F.when(is_android, F.substring_index(version, ".", 2)).otherwise(version), empty
        ),
        "hardware": F.when(device.rlike(NUMERIC_DEVICE), empty).otherwise(device),
    }
    kept = [c for c in df.columns if c not in columns]
    return base.select(*kept, *[c.alias(n) for n, c in columns.items()])


def browser_report(df: DataFrame, ua: str, user: str) -> DataFrame:
    """Users and hits per browser and system.

    Agents are taken apart once per (agent, user), not once per hit.
    """
    per_agent = df.where(F.col(user).isNotNull()).groupBy(F.col(ua).alias("ua"), user).agg(F.count("*").alias("n"))
    return uv_pv(with_user_agent(per_agent, "ua"), ["browser", "os"], user, F.col("n"))
