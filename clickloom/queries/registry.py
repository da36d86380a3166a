"""Query registry and the expressions that queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.hashing import CODE_DIGITS, CODE_WIDTH

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale, read on access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register a function of :class:`Tables` under a query name."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def ts_text(col: str = "ts") -> Column:
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss")


def day_text(col: str = "ts") -> Column:
    return F.date_format(F.col(col), "yyyy-MM-dd")


def prop_k() -> Column:
    return F.get_json_object("props", "$.k")


def text(col: str) -> Column:
    return F.col(col).cast("string")


# The same expressions as SQL text.
SQL_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
SQL_DAY = "strftime(ts, '%Y-%m-%d')"
SQL_HOUR = "strftime(ts, '%Y-%m-%d-%H')"
SQL_K = "regexp_extract(props, '[0-9]+')"


def sql_md5(expr: str) -> str:
    n = f"md5_number_upper({expr})"
    return (
        f"CAST(CASE WHEN {n} >= 9223372036854775808 THEN CAST({n} AS HUGEINT) - 18446744073709551616 "
        f"ELSE CAST({n} AS HUGEINT) END AS BIGINT)"
    )


def sql_code(expr: str) -> str:
    """Compact code of a signed 64-bit number, digit by digit."""
    u = f"(CASE WHEN {expr} < 0 THEN CAST({expr} AS HUGEINT) + 18446744073709551616 ELSE CAST({expr} AS HUGEINT) END)"
    digits = [
        f"substr('{CODE_DIGITS}', CAST(({u} // {32 ** i}) % 32 AS INTEGER) + 1, 1)"
        for i in range(CODE_WIDTH - 1, -1, -1)
    ]
    return "(" + " || ".join(digits) + " || 'u')"


def sql_minute(expr: str) -> str:
    return f"CAST(floor(epoch({expr}) / 60) AS BIGINT)"


def sql_components(edges: str, by: str = "") -> str:
    """CTE bodies that solve components of a CTE ``edges`` (by, src, dst) by closure.

    Gives the CTE ``{edges}_cc`` (by, node, component). Needs WITH RECURSIVE.
    """
    b = f"{by}, " if by else ""
    rb = f"r.{by}, " if by else ""
    match = f"r.{by} = s.{by} AND " if by else ""
    return f"""
    {edges}_sym AS (SELECT {b}src AS a, dst AS b FROM {edges} UNION SELECT {b}dst, src FROM {edges}),
    {edges}_reach AS (
        SELECT {b}a AS node, a AS other FROM {edges}_sym
        UNION
        SELECT {rb}r.node, s.b FROM {edges}_reach r JOIN {edges}_sym s ON {match}r.other = s.a
    ),
    {edges}_cc AS (SELECT {b}node, min(other) AS component FROM {edges}_reach GROUP BY {b}node)"""
