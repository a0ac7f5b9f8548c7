"""Layered table pipelines, table checks, Spark ML life cycle and token analytics on plain Spark."""
