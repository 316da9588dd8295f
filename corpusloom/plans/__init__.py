"""Whole plans: the list build, and the queries with their SQL."""
