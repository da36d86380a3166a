"""Text, array and map tools shared by the log loaders and reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = ("", "null")


def blank_to_null(col: Column) -> Column:
    """Both missing markers, empty text and the word ``null``, become real NULL."""
    return F.when(~col.isin(*MISSING), col)


def none_marker(col: Column, marker: str = "null") -> Column:
    """The opposite of :func:`blank_to_null`, for text outputs."""
    return F.coalesce(col, F.lit(marker))


def before(col: Column, mark: str) -> Column:
    """Text before the first ``mark`` (all of it when absent)."""
    return F.substring_index(col, mark, 1)


def after_last(col: Column, mark: str) -> Column:
    """Text after the last ``mark`` (all of it when absent)."""
    return F.substring_index(col, mark, -1)


def join_sorted(values: Column, sep: str) -> Column:
    return F.array_join(F.array_sort(values), sep)


def join_sorted_distinct(values: Column, sep: str) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(values)), sep)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def safe_map(entries: Column) -> Column:
    """``array<struct<key,value>>`` -> map; the last entry of a repeated key wins.

    Only rows that do repeat a key take the slower way, which keeps entries
    with no equal key behind them. The session's duplicate-key policy does not
    matter.
    """
    def build(es: Column) -> Column:
        def choose(keys: Column) -> Column:
            def is_last(entry: Column, index: Column) -> Column:
                return F.array_position(F.slice(keys, index + 2, F.size(keys)), entry["key"]) == 0

            return F.when(
                F.size(keys) == F.size(F.array_distinct(keys)), F.map_from_entries(es)
            ).otherwise(F.map_from_entries(F.filter(es, is_last)))

        return let(F.transform(es, lambda e: e["key"]), choose)

    return let(entries, build)
