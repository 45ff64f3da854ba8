"""Queries over the driver tables that exercise every operator of the library."""

from . import aggregate_queries, flagship, matching_queries, model_queries, table_queries, text_queries  # noqa: F401
from .base import REGISTRY

__all__ = ["REGISTRY"]
