"""Imports every query module so that all queries are registered."""

from trendlens.plans import (  # noqa: F401
    feature_queries, model_queries, neighbor_queries, table_queries, text_queries,
    source_queries, video_queries)
