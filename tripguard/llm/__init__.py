"""Operators over text corpora and web pages, built on DataFrames."""
