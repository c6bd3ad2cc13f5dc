"""Registered queries over the driver tables; importing this package fills REGISTRY."""

from . import catalog, columns, features, inputs, ml, modeling, monitor, serving, streams, synthetic, tables  # noqa: F401
from .registry import REGISTRY, Query, query

__all__ = ["REGISTRY", "Query", "query"]
