"""Incremental table sync as Spark jobs: windowed extracts, value normalisation, upserts, published versions."""

__version__ = "0.1.0"
