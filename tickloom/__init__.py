"""tickloom: trade and market time-series analytics as Spark DataFrame operators."""

from tickloom.session import build_session

__all__ = ["build_session"]
