"""All named queries. Importing this package fills the registry."""

from . import assoc_queries, model_queries, profile_queries, tag_queries, text_queries, vector_queries  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
