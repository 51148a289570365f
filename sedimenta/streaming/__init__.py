"""The changelog as a stream."""
