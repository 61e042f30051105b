"""Incremental variants of the associative folds."""
