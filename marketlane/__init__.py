"""Marketplace analytics as Spark jobs: every operator is DataFrame in, DataFrame out."""

from marketlane.settings import Settings

__all__ = ["Settings"]
