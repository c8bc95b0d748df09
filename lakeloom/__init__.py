"""Ingestion and refinement of a bronze / silver / gold data lake as Spark plans."""

__version__ = "0.1.0"
