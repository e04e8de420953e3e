"""Credit-risk early-warning analytics on Spark DataFrames."""

from tidemark.session import build_session

__all__ = ["build_session"]
