"""Whole dataflows: the image index and its counters."""
