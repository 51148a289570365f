"""Versioned tables: metadata, files, deletion vectors."""
