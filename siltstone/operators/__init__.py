"""Relational building blocks: unnesting, joins, gate, diff, profile."""
