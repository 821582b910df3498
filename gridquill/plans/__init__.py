"""Declarative cell queries, and the query catalogue."""
