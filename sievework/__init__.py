"""Spark-first engine for curating text evidence into auditable tables."""
