"""The queries over the driver's tables."""

from . import formats, inventory, publishing, relational, streams, texts  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
