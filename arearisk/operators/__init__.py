"""Operators: cleaning, key reshaping, aggregates, ranking, joins, classification."""
