"""Readers, writers, JDBC, incremental (bookmarked) reads."""
