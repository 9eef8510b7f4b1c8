"""Click-through-rate prediction: one-hot and hashed categorical features,
logistic regression, log loss and ROC.

Records carry a unique ``rid``, ``label`` and
``feats`` = array<struct<_1: featureID long, _2: category string>>.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.hashing import feature_key, md5_bucket
from ..functions.ml import log_loss, sigmoid_clamped
from ..plans import broadcast_pinned, cut_lineage, dense_index, running_sums

KEYS = ("rid",)

# Fixed value: features of a record up to which each place is looked up by a join of its own.
MOST_PLACES = 32


def exploded(records: DataFrame) -> DataFrame:
    return records.select(*KEYS, "label", F.explode("feats").alias("f")) \
                  .select(*KEYS, "label", F.col("f").getField("_1").alias("feature_id"),
                          F.col("f").getField("_2").alias("category"))


def distinct_features(records: DataFrame) -> DataFrame:
    return exploded(records).select("feature_id", "category").distinct()


def ohe_dictionary(records: DataFrame) -> DataFrame:
    """(feature_id, category, ohe_index): dense ids in (feature_id, category) order,
    numbered without a single-partition window, and written once for its users."""
    return cut_lineage(dense_index(distinct_features(records), ["feature_id", "category"], "ohe_index"))


def _looked_up(records: DataFrame, feats, table: DataFrame, value: str) -> DataFrame | None:
    """(rid, label, found): ``value`` of every feature of a record that the table has, in
    ``feats`` order.  The table is broadcast and joined once a place, so records stay where
    they are read, unless some rid comes again with its label: then these are put together.
    None if the table is too large for that, or a record has over ``MOST_PLACES`` features."""
    records = records.select(*KEYS, "label", feats.alias("feats"))
    table = broadcast_pinned(cut_lineage(table.select("feature_id", "category", value)))
    places = records.agg(F.max(F.size("feats"))).first()[0] or 0
    if places > MOST_PLACES or "ResolvedHint" not in table._jdf.queryExecution().analyzed().toString():
        return None
    out = records
    for i in range(places):
        side = table.select(*[F.col(c).alias(f"_{c}_{i}") for c in ("feature_id", "category", value)])
        at = F.get("feats", F.lit(i))
        out = out.join(F.broadcast(side), (at["_1"] == F.col(f"_feature_id_{i}")) & (at["_2"] == F.col(f"_category_{i}")),
                       "left").drop(f"_feature_id_{i}", f"_category_{i}")
    found = F.array(*[F.col(f"_{value}_{i}") for i in range(places)])
    out = out.select(*KEYS, "label", F.filter(found, lambda x: x.isNotNull()).alias("found"))
    again = cut_lineage(records.groupBy(*KEYS, "label").count().where(F.col("count") > 1).limit(1))
    if again.isEmpty():
        return out
    return out.groupBy(*KEYS, "label").agg(F.flatten(F.collect_list("found")).alias("found"))


def ohe_encode(records: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(keys, label, indices): sorted dictionary ids of each record's features.
    Categories missing from the dictionary are ignored; records keep a row (left join)."""
    found = _looked_up(records.where(F.size("feats") > 0), F.col("feats"), dictionary, "ohe_index")
    if found is not None:
        return found.select(*KEYS, "label", F.array_sort("found").alias("indices"))
    e = exploded(records).join(dictionary, ["feature_id", "category"], "left")
    return (e.groupBy(*KEYS, "label")
             .agg(F.array_sort(F.filter(F.collect_list("ohe_index"), lambda x: x.isNotNull()))
                  .alias("indices")))


def category_counts(records: DataFrame) -> DataFrame:
    """Distinct categories per feature."""
    return distinct_features(records).groupBy("feature_id").agg(F.count(F.lit(1)).alias("n_categories"))


def feature_frequency(records: DataFrame) -> DataFrame:
    """Histogram of int(ln(number of records using each (feature, category)))."""
    per = exploded(records).groupBy("feature_id", "category").agg(F.count(F.lit(1)).alias("n"))
    return (per.groupBy(F.floor(F.ln("n")).cast("int").alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n_features")))


def bucket_dictionary(records: DataFrame, num_buckets: int) -> DataFrame:
    """(feature_id, category, bucket, shared): the md5 bucket of every different feature,
    hashed once each, and whether another feature has the same one.  Written once."""
    hashed = distinct_features(records).where(F.col("category").isNotNull()).withColumn(
        "bucket", md5_bucket(feature_key(F.col("feature_id"), F.col("category")), num_buckets))
    return cut_lineage(hashed.withColumn(
        "shared", F.count(F.lit(1)).over(Window.partitionBy("bucket")) > 1))


def _once(records: DataFrame) -> DataFrame:
    """(rid, label, feature_id, category): each different feature of a record once; a
    record without any has one row of nulls."""
    return records.select(*KEYS, "label", F.explode_outer(F.array_distinct("feats")).alias("f")).select(
        *KEYS, "label", F.col("f._1").alias("feature_id"), F.col("f._2").alias("category"))


def hashed_indices(records: DataFrame, num_buckets: int) -> DataFrame:
    """(rid, label, indices): the md5 bucket of each different feature of a record, once a
    feature, by the bucket dictionary.  Null categories have none."""
    buckets = bucket_dictionary(records, num_buckets).drop("shared")
    found = _looked_up(records, F.array_distinct("feats"), buckets, "bucket")
    if found is not None:
        return found.select(*KEYS, "label", F.col("found").alias("indices"))
    return _once(records).join(buckets, ["feature_id", "category"], "left").groupBy(*KEYS, "label").agg(
        F.collect_list("bucket").alias("indices"))


def hashed_buckets(records: DataFrame, num_buckets: int) -> DataFrame:
    """(rid, label, bucket, value): md5 bucket counts of each record.

    A bucket that one feature of the dictionary has to itself counts 1 wherever that
    feature stands, so only features of shared buckets are grouped by record."""
    buckets = bucket_dictionary(records, num_buckets)
    side = lambda shared: broadcast_pinned(buckets.where(shared).drop("shared"))
    each = _once(records)
    alone = each.join(side(~F.col("shared")), ["feature_id", "category"]).select(
        *KEYS, "label", "bucket", F.lit(1.0).alias("value"))
    several = each.join(side(F.col("shared")), ["feature_id", "category"]).groupBy(*KEYS, "label", "bucket").agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    return alone.unionByName(several)


def sparsity(records: DataFrame, dictionary_size: int, num_buckets: int) -> DataFrame:
    """Mean share of non-zero entries: one-hot vs hashed (different features, and
    different buckets, of each record)."""
    filled = hashed_buckets(records, num_buckets).count()
    return records.agg(F.avg(F.size(F.array_distinct("feats")) / F.lit(float(dictionary_size))).alias("ohe_sparsity"),
                       (F.lit(float(filled)) / (F.count(F.lit(1)) * F.lit(float(num_buckets)))).alias("hashed_sparsity"))


# ------------------------------------------------------------------ models
def sparse_vectors(encoded: DataFrame, size: int) -> DataFrame:
    """(keys, label, features): the indices of each record as a sparse vector of
    ``size`` places, each as often as it occurs.  Made on the JVM by a count model
    whose vocabulary is the numbers 0 to size - 1; categories never meet the driver."""
    numbers = CountVectorizerModel.from_vocabulary([str(i) for i in range(max(1, size))], inputCol="_numbers",
                                                   outputCol="features")
    words = encoded.withColumn("_numbers", F.transform("indices", lambda i: i.cast("string")))
    return numbers.transform(words).drop("_numbers")


VECTOR = T.StructType([T.StructField("size", T.IntegerType()), T.StructField("indices", T.ArrayType(T.IntegerType())),
                       T.StructField("values", T.ArrayType(T.DoubleType()))])


def _lists(size: np.ndarray, flat: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), flat)


@F.arrow_udf(VECTOR)
def to_vector(indices: pa.Array, size: pa.Array) -> pa.Array:
    """User function: sorted indices -> sparse vector of ones, as its three parts.
    Whole Arrow columns are handed on; nothing has the size of the dictionary."""
    n = pc.fill_null(pc.list_value_length(indices), 0).to_numpy(zero_copy_only=False)
    places = indices.flatten().cast(pa.int32())
    return pa.StructArray.from_arrays([size.cast(pa.int32()), _lists(n, places), _lists(n, pa.array(np.ones(len(places))))],
                                      ["size", "indices", "values"])


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def nonzero(vector: pa.Array) -> pa.Array:
    """User function: vector -> places that are not zero."""
    places, values = vector.field("indices"), vector.field("values").flatten().to_numpy(zero_copy_only=False)
    n = pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False)
    keep = values != 0
    of = np.repeat(np.arange(len(n)), n)[keep]
    return _lists(np.bincount(of, minlength=len(n)), places.flatten().filter(pa.array(keep)))


def logreg(max_iter: int = 20, reg: float = 0.01, elastic: float = 0.0) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                              regParam=reg, elasticNetParam=elastic, standardization=False)


def model_probability(lr_model, features_df: DataFrame) -> DataFrame:
    """p = sigmoid(w . x + b) with the raw score clamped to +-20."""
    from pyspark.ml.functions import vector_to_array
    pred = lr_model.transform(features_df)
    raw = vector_to_array("rawPrediction")[1]
    return pred.withColumn("p", sigmoid_clamped(raw))


def with_log_loss(df: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    return df.withColumn("log_loss", log_loss(p, label))


def mean_log_loss(df: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    return df.agg(F.avg(log_loss(p, label)).alias("log_loss"))


def baseline_log_loss(train: DataFrame, evaluated: DataFrame) -> DataFrame:
    """Mean log loss on ``evaluated`` of predicting the training base rate."""
    rate = train.agg(F.avg("label")).first()[0]
    return evaluated.agg(F.avg(log_loss(F.lit(rate), F.col("label"))).alias("log_loss"),
                         F.lit(rate).alias("base_rate"))


def rate_weights(train: DataFrame) -> tuple[DataFrame, float]:
    """A fixed additive score per (feature, category): its positive rate minus
    the base rate (a transparent stand-in for learned weights); and the base rate.
    One pass over the records: every record counts once in each of its features."""
    sums = cut_lineage(exploded(train).groupBy("feature_id", "category").agg(
        F.sum("label").alias("s"), F.count(F.lit(1)).alias("n")))
    rate = sums.agg(F.sum("s") / F.sum("n")).first()[0]
    return sums.select("feature_id", "category", (F.col("s") / F.col("n") - F.lit(rate)).alias("weight")), rate


def score_with_weights(records: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """p = sigmoid(intercept + sum of the weights of the record's features),
    computed as a join with the weight table (unknown categories weigh 0)."""
    e = exploded(records).join(broadcast_pinned(weights), ["feature_id", "category"], "left")
    raw = F.lit(intercept) + F.sum(F.coalesce("weight", F.lit(0.0)))
    return e.groupBy(*KEYS, "label").agg(sigmoid_clamped(raw).alias("p"))


def roc(scored: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    """(p, tpr, fpr) at each distinct score, highest first.  Rows are aggregated
    per distinct score and written once; totals and running sums (partition
    offsets, no single-partition window) come from that table."""
    per = cut_lineage(scored.groupBy(p).agg(F.sum(F.col(label)).alias("pos"),
                                            F.sum(F.lit(1.0) - F.col(label)).alias("neg")))
    totals = per.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    cum = running_sums(per, [F.desc(p)], ["pos", "neg"])
    return cum.select(p, (F.col("pos_cum") / F.lit(totals["P"])).alias("tpr"),
                      (F.col("neg_cum") / F.lit(totals["N"])).alias("fpr"))
