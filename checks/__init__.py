"""Dirty channel views over the given tables, their SQL twins, and the query catalogue."""
