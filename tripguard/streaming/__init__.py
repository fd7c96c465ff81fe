"""Incremental runs of the jobs."""
