"""Readers, writers, stage tables, and the role views over the test tables."""
