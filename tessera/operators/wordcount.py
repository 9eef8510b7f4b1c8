"""Word counting over text lines."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import clean_text, split_words


def words(lines: DataFrame, col: str = "value") -> DataFrame:
    """Cleaned lines -> one ``word`` per row, blanks dropped."""
    # explode_outer + null filter keeps Spark from inferring a size() > 0
    # filter and evaluating the cleaning twice
    return lines.select(F.explode_outer(split_words(clean_text(col))).alias("word")) \
                .where(F.col("word").isNotNull())


def counts(words_df: DataFrame) -> DataFrame:
    """word -> count (partial counts are combined map-side before the shuffle)."""
    return words_df.groupBy("word").count()


def top(words_df: DataFrame, k: int = 15) -> DataFrame:
    return counts(words_df).orderBy(F.desc("count"), F.asc("word")).limit(k)


def unique_and_mean(words_df: DataFrame) -> DataFrame:
    c = counts(words_df)
    return c.agg(F.count(F.lit(1)).alias("unique_words"), F.avg("count").alias("mean_count"))
