"""Text, delimited and regex-validated record sources.

All readers return plain DataFrames; schemas are given explicitly wherever
the caller knows them (an explicit schema saves Spark a pass over the data).
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


def local_rows(spark: SparkSession, rows, names) -> DataFrame:
    """Table from local tuples and column names (types inferred)."""
    return spark.createDataFrame(rows, list(names))


def local_partitioned(spark: SparkSession, rows, names, n: int) -> DataFrame:
    """Local tuples spread over ``n`` partitions."""
    return spark.createDataFrame(rows, list(names)).repartition(n)


def read_text(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Lines of a text file or directory -> one string column ``value``."""
    df = spark.read.text(path)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", header: bool = True,
                   schema: StructType | str | None = None) -> DataFrame:
    """Delimited text.  With ``schema`` no inference pass is made and trailing
    columns beyond the schema are dropped by position; without it types are
    inferred (one extra pass)."""
    reader = spark.read.option("sep", sep).option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def staging_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint directory for staged files."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stage-{tag}-{uuid.uuid4().hex}"


def stage_lines(lines: DataFrame, tag: str, files: int | None = None) -> str:
    """Write a one-string-column frame as text files; return the folder."""
    path = staging_path(lines.sparkSession, tag)
    out = lines if files is None else lines.repartition(files)
    out.write.text(path)
    return path


def regex_quarantine(lines: DataFrame, pattern: str, header_id: str, id_group: int = 1,
                     col: str = "value") -> DataFrame:
    """Classify each line against ``pattern``: 1 = valid, 0 = header (its id
    group equals ``header_id``), -1 = no match.  Returns the line, its status
    and all capture groups 1..n (quotes are left for the caller)."""
    value = F.col(col)
    ngroups = pattern.count("(") - pattern.count("(?")
    groups = [F.regexp_extract(value, pattern, i).alias(f"g{i}") for i in range(1, ngroups + 1)]
    matched = value.rlike(pattern)
    status = (F.when(~matched, F.lit(-1))
               .when(F.regexp_extract(value, pattern, id_group) == F.lit(header_id), F.lit(0))
               .otherwise(F.lit(1)))
    return lines.select(value.alias("line"), status.alias("status"), *groups)


def strip_quotes(c: Column) -> Column:
    return F.regexp_replace(c, '"', "")
