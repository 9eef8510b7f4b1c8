"""tessera — course-style Spark analytics expressed as DataFrame -> DataFrame functions.

Every operator is plain Spark SQL / DataFrame / Spark ML work; nothing here
parses, plans or schedules queries on its own.
"""

__all__ = ["session", "sources", "functions", "operators", "plans"]
