"""Grouping, matching and extraction operators."""
