"""Operators composed into jobs and queries."""
