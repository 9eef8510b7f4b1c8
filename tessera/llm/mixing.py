"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of all characters over its
actual share.  Every document is repeated a Poisson-distributed number of times
with that mean: the distribution is inverted at a uniform number hashed from
the document's id and a seed, so a rerun gives the same copies.  Copies are
then dealt out and ordered by a hash of their own.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, pin


def uniform(seed: str, *cols) -> Column:
    """A number in (0, 1] from the md5 of the seed and columns (52 bits)."""
    key = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c, F.lit(""))
                                          for c in cols])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 1) / F.lit(float(1 << 52))


def poisson_tables(rates: DataFrame, most_from_zero: float = 1000.0) -> DataFrame:
    """(source, low, cdf) for (source, rate > 0): the cumulative probabilities of
    low, low + 1, ... of a Poisson of this mean, up to where they reach one in double
    precision.  ``low`` is 0 up to a rate of ``most_from_zero``; beyond, it is 12
    standard deviations below the mean, so tables grow with the root of the rate."""
    few = _from_zero(rates.where(F.col("rate") <= most_from_zero))
    return few.unionByName(_from_tail(rates.where(F.col("rate") > most_from_zero)))


def _from_zero(rates: DataFrame) -> DataFrame:
    most = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    each = Window.partitionBy("source").orderBy("k")
    rows = rates.withColumn("k", F.explode(F.sequence(F.lit(0), most)))
    rows = rows.withColumn("log_fact", F.sum(F.ln(F.greatest("k", F.lit(1)))).over(each))
    rows = rows.withColumn("p", F.exp(F.col("k") * F.ln("rate") - F.col("rate") - F.col("log_fact")))
    rows = rows.withColumn("cdf", F.sum("p").over(each))
    return rows.groupBy("source").agg(
        F.lit(0).cast("long").alias("low"),
        F.transform(F.array_sort(F.collect_list(F.struct("k", "cdf"))), lambda x: x["cdf"]).alias("cdf"))


def _from_tail(rates: DataFrame) -> DataFrame:
    wide = 12 * F.sqrt("rate") + 30
    each, whole = Window.partitionBy("source").orderBy("k"), Window.partitionBy("source")
    rows = rates.withColumn("low", F.greatest(F.lit(0), F.floor(F.col("rate") - wide)).cast("long"))
    rows = rows.withColumn("k", F.explode(F.sequence("low", F.ceil(F.col("rate") + wide).cast("long"))))
    # from the ratio of neighbours, rate / k: the logarithm of the factorial would lose digits
    rows = rows.withColumn("log_p", F.sum(F.when(F.col("k") > F.col("low"), F.ln(F.col("rate") / F.col("k")))
                                          .otherwise(0.0)).over(each))
    rows = rows.withColumn("cdf", F.sum(F.exp("log_p")).over(each) / F.sum(F.exp("log_p")).over(whole))
    return rows.groupBy("source").agg(
        F.min("low").alias("low"),
        F.transform(F.array_sort(F.collect_list(F.struct("k", "cdf"))), lambda x: x["cdf"]).alias("cdf"))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, source_col: str = "source",
                 text_col: str = "text") -> DataFrame:
    """(source, rate) from the characters of each source; a null source is one too.

    ``weights`` are relative; without, all sources weigh the same.  A source
    that is not in ``weights`` weighs nothing; one without any characters keeps
    its documents once.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.coalesce(F.char_length(text_col), F.lit(0)).cast("long")).alias("chars"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        table = docs.sparkSession.createDataFrame(list(weights.items()), "name string, weight double")
        sizes = sizes.join(table, F.col("source").eqNullSafe(F.col("name")), "left").withColumn(
            "weight", F.coalesce("weight", F.lit(0.0)))
    sizes = pin(sizes, "sizes")
    live = F.when(F.col("chars") > 0, F.col("weight"))
    total, weight = sizes.agg(F.sum("chars"), F.sum(live)).first()
    if not weight:
        return sizes.select("source", F.lit(1.0).alias("rate"))
    return sizes.select("source", F.coalesce(
        F.lit(float(total)) * (live / F.lit(float(weight))) / F.col("chars"), F.lit(1.0)).alias("rate"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, seed: str = "mix", id_col: str = "doc_id",
                source_col: str = "source", text_col: str = "text", block: int = 1000) -> DataFrame:
    """The columns of ``docs``, each row as often as drawn, then copy (from 0) and
    place, the uniform number that orders the copies globally.

    Rows of equal ids draw alike, null ids as the empty string; repeated rows
    each give their copies.  Null and empty texts have no characters but are
    repeated like others of their source.  An empty table stays empty.  Columns
    of ``docs`` named copy or place are left out.  Where a rate is too large for a
    table from 0, copies are made in blocks of ``block`` in different tasks.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("copy", "place")])
    name, low, cdf, times, part = fresh(docs, "name", "low", "cdf", "times", "part")
    rates = source_rates(docs, weights, source_col, text_col)
    tables = pin(poisson_tables(rates.where(F.col("rate") > 0)), "rates").select(
        F.col("source").alias(name), F.col("low").alias(low), F.col("cdf").alias(cdf))
    sources, values, largest = tables.agg(F.count("*"), F.sum(F.size(cdf)), F.max(low)).first()
    if sources <= 10_000 and (values or 0) <= 1_000_000:
        tables = F.broadcast(tables)  # at most 8 MB of probabilities and the names
    drawn = docs.join(tables, F.col(source_col).eqNullSafe(F.col(name)))
    below = F.coalesce(F.size(F.filter(F.col(cdf), lambda p: p < uniform(seed, id_col))), F.lit(0))
    copies = drawn.where(F.col(low) == 0).withColumn(
        "copy", F.explode(F.when(below > 0, F.sequence(F.lit(0), below - 1)))).drop(name, low, cdf)
    if largest:
        many = drawn.where(F.col(low) > 0).withColumn(times, F.col(low) + below).drop(name, low, cdf)
        many = many.withColumn(part, F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / block).cast("int"))))
        first = F.col(part) * block
        many = many.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), id_col, part)
        many = many.withColumn("copy", F.explode(F.sequence(
            first, (F.least(first + block, F.col(times)) - 1).cast("int")))).drop(times, part)
        copies = copies.unionByName(many)
    placed = copies.withColumn("place", uniform(seed + "/place", id_col, "copy"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(parts, "place").sortWithinPartitions("place")
