"""Sources: the driver's parquet tables, text / delimited readers, and the
stand-in record sets the analyses run on (all derived from the tables)."""
from .tables import TABLES, table, tables
from . import text, standins

__all__ = ["TABLES", "table", "tables", "text", "standins"]
