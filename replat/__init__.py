"""Rebuild-progress analytics as Spark jobs: parcels + permit cases + regions in, published tables out."""

__version__ = "0.1.0"
