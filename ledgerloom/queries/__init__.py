"""Queries that run the operators over whole tables, each with the same result said in SQL for DuckDB where SQL can."""

from . import base, cleaning, documents, entities, further, held, modelling, quality, reports, roundtrips, scores

QUERIES = base.QUERIES
ORACLES = base.ORACLES

__all__ = ["ORACLES", "QUERIES", "base", "cleaning", "documents", "entities", "further", "held", "modelling", "quality", "reports", "roundtrips", "scores"]
