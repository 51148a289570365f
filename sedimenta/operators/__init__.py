"""Changelog reads and what folds a changelog."""
