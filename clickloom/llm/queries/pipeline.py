"""The corpus pipeline as a query."""

import corpus_pipeline
from clickloom.llm.queries.registry import register

register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
