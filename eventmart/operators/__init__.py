"""Relational operators: sets, lookups, dimensions, facts, counts, questions."""
