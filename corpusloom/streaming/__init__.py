"""Counts and contexts of a growing corpus."""
