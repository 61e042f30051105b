"""Readers of web archives and views over the test tables."""
