"""tideline: incremental dimensional warehousing and its analytics as Spark jobs."""

from .session import build_session

__all__ = ["build_session"]
