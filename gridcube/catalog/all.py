"""Importing the catalog modules fills the registry."""

from gridcube.catalog import arranging, auditing, reducing, selecting, storing  # noqa: F401
from gridcube.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
