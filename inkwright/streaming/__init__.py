"""Incremental forms of the archive's jobs."""
