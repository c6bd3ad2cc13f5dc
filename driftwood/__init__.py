"""driftwood: feature lookups, point-in-time joins, model scoring and drift monitoring on Spark."""

__version__ = "0.1.0"
