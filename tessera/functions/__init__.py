"""Column-expression helpers (all JVM-side built-ins / higher-order functions)."""
from . import text, weblog, arrays, ml, hashing

__all__ = ["text", "weblog", "arrays", "ml", "hashing"]
