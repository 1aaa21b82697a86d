"""Relational operators: features, joins, aggregates, ordered selection, gates, extraction."""
