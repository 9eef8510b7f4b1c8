"""Web-server log analytics over Common Log Format lines."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.weblog import SIZE_RE, clf_time, parse_clf_columns
from .relational import any_null


def parse(lines: DataFrame, col: str = "value") -> DataFrame:
    """CLF lines -> host, timestamp (text), path, status, content_size."""
    return lines.select(*parse_clf_columns(col))


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(any_null(parsed))


def bad_size_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines whose size field is not a number, marked with ``*``."""
    return lines.where(~F.col(col).rlike(SIZE_RE)).select(F.concat(F.col(col), F.lit("*")).alias("line"))


def clean(parsed: DataFrame) -> DataFrame:
    """Null sizes -> 0, the CLF time text -> timestamp column ``time``."""
    return (parsed.na.fill({"content_size": 0})
                  .withColumn("time", clf_time("timestamp"))
                  .drop("timestamp"))


def logs(lines: DataFrame) -> DataFrame:
    return clean(parse(lines))


def size_stats(logs_df: DataFrame) -> DataFrame:
    c = F.col("content_size")
    return logs_df.agg(F.min(c).alias("min_size"), F.avg(c).alias("avg_size"), F.max(c).alias("max_size"))


def status_counts(logs_df: DataFrame) -> DataFrame:
    return (logs_df.groupBy("status").count()
                   .withColumn("log_count", F.ln(F.col("count"))))


def frequent_hosts(logs_df: DataFrame, min_requests: int = 10) -> DataFrame:
    return logs_df.groupBy("host").count().where(F.col("count") > min_requests).select("host")


def path_hits(logs_df: DataFrame) -> DataFrame:
    return logs_df.groupBy("path").count()


def top_paths(logs_df: DataFrame, k: int = 10) -> DataFrame:
    return path_hits(logs_df).orderBy(F.desc("count"), F.asc("path")).limit(k)


def top_error_paths(logs_df: DataFrame, k: int = 10) -> DataFrame:
    return top_paths(logs_df.where(F.col("status") != 200), k)


def unique_hosts(logs_df: DataFrame) -> DataFrame:
    return logs_df.agg(F.countDistinct("host").alias("unique_hosts"))


def daily_hosts(logs_df: DataFrame) -> DataFrame:
    return (logs_df.groupBy(F.dayofmonth("time").alias("day"))
                   .agg(F.countDistinct("host").alias("hosts")))


def daily_requests_per_host(logs_df: DataFrame) -> DataFrame:
    """Requests / distinct hosts per day, in one aggregation."""
    return (logs_df.groupBy(F.dayofmonth("time").alias("day"))
                   .agg(F.count(F.lit(1)).alias("requests"), F.countDistinct("host").alias("hosts"))
                   .withColumn("avg_reqs_per_host", F.col("requests") / F.col("hosts")))


def daily_mean_per_host_two_level(logs_df: DataFrame) -> DataFrame:
    """Count per (day, host), then mean of those counts per day."""
    per = logs_df.groupBy(F.dayofmonth("time").alias("day"), "host").count()
    return per.groupBy("day").agg(F.avg("count").alias("avg_reqs_per_host"))


def not_found(logs_df: DataFrame) -> DataFrame:
    return logs_df.where(F.col("status") == 404)


def not_found_paths(logs_df: DataFrame) -> DataFrame:
    return not_found(logs_df).select("path").distinct()


def not_found_top_paths(logs_df: DataFrame, k: int = 20) -> DataFrame:
    return not_found(logs_df).groupBy("path").count().orderBy(F.desc("count"), F.asc("path")).limit(k)


def not_found_top_hosts(logs_df: DataFrame, k: int = 25) -> DataFrame:
    return not_found(logs_df).groupBy("host").count().orderBy(F.desc("count"), F.asc("host")).limit(k)


def not_found_by_day(logs_df: DataFrame) -> DataFrame:
    return not_found(logs_df).groupBy(F.dayofmonth("time").alias("day")).count()


def not_found_top_days(logs_df: DataFrame, k: int = 5) -> DataFrame:
    return not_found_by_day(logs_df).orderBy(F.desc("count"), F.asc("day")).limit(k)


def not_found_by_hour(logs_df: DataFrame) -> DataFrame:
    return not_found(logs_df).groupBy(F.hour("time").alias("hour")).count()
