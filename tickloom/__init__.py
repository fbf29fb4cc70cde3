"""Spark-native analytics for daily price series."""

from tickloom.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
