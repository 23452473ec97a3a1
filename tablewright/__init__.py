"""Spark-first toolkit: bring records into tables, keep the tables in order, profile them."""

__version__ = "0.1.0"
