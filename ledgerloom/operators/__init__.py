"""Relational operators: schema, joins, aggregates, deduplication, scoring, quality, models."""
