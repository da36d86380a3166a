"""Registered corpus queries, one module per operator, and the pipeline."""

from clickloom.llm.queries import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13, pipeline  # noqa: F401
from clickloom.llm.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
