"""Named queries over the driver tables (one per operator of the inventory)
and, where SQL can express them, their DuckDB twins."""
from .registry import QUERIES, ORACLE, register
from . import core, analyses  # noqa: F401  (registration side effects)

__all__ = ["QUERIES", "ORACLE", "register"]
