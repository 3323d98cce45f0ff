"""Relational operators: filters, dedupe, joins, upserts, aggregates, checks."""
