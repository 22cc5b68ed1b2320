"""Imports the modules that register this subpackage's queries."""

from trendlens.llm import queries  # noqa: F401
