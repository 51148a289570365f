"""Schemas, options and state settings."""
