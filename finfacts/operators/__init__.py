"""Relational operators built from DataFrame joins, aggregates and generators."""
