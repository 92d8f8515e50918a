"""Imports every module that registers queries."""

from workload import cleaning, expressions, model  # noqa: F401

FLAGSHIP = "consolidate_end_to_end"
