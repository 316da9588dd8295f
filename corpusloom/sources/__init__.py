"""Readers, writers, configuration and the cache of intermediate tables."""
