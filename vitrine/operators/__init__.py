"""Relational operators: joins, metrics, pairs, ranking, documents."""
