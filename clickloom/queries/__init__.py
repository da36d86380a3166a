"""Registered queries over the given tables, each with its SQL counterpart where SQL can say it."""

from clickloom.queries import (  # noqa: F401
    functions,
    identity,
    joins,
    metrics,
    parsing,
    ranking,
    recommend,
    sources,
    streams,
)
from clickloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
