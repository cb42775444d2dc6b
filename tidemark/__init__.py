"""Panel analytics over partitioned Parquet tables, written as Spark DataFrame transforms."""

from tidemark.session import build_session

__all__ = ["build_session"]
