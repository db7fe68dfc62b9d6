"""Input tables."""

from tallyframe.sources.derived import DerivedTables
from tallyframe.sources.registry import TableSet

__all__ = ["DerivedTables", "TableSet"]
