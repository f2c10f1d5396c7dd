"""Queries over the given tables, each with the SQL it has to agree with."""
