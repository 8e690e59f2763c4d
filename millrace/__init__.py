"""Millrace: a Spark-first listing analytics engine (see README.md)."""

__all__ = ["config", "schema"]
