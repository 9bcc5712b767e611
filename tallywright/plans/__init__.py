"""Queries over the given tables: how they are read as attempts, and the oracle SQL."""
