"""Assembled pipelines and the registry of queries."""
