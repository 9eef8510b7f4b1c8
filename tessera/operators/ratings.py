"""Ratings analysis and ALS recommendation."""
from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, functions as F

from ..plans import broadcast_pinned, cut_lineage, dense_index, written


def item_stats(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, title, n_ratings, avg_rating)."""
    stats = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_ratings"),
                                           F.avg("rating").alias("avg_rating"))
    return stats.join(items, "item_id").select("item_id", "title", "n_ratings", "avg_rating")


def top_items(stats: DataFrame, min_ratings: int, k: int = 20) -> DataFrame:
    """Best mean rating among items with at least ``min_ratings`` ratings."""
    return (stats.where(F.col("n_ratings") >= min_ratings)
                 .orderBy(F.desc("avg_rating"), F.asc("item_id")).limit(k))


def baseline_rmse(train: DataFrame, test: DataFrame) -> DataFrame:
    """RMSE on ``test`` of predicting the training mean rating."""
    mu = train.agg(F.avg("rating")).first()[0]
    d = F.col("rating") - F.lit(mu)
    return test.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.lit(mu).alias("train_mean"))


def new_user_ratings(ratings: DataFrame, user_id: int = 0, n_items: int = 10) -> DataFrame:
    """A new user who rates the ``n_items`` most-rated items with their rounded mean."""
    top = (ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("m"))
                  .orderBy(F.desc("n"), F.asc("item_id")).limit(n_items))
    return top.select(F.lit(user_id).cast("long").alias("user_id"), "item_id",
                      F.round("m").cast("double").alias("rating"))


def add_user(train: DataFrame, user_rows: DataFrame) -> DataFrame:
    return train.unionByName(user_rows)


def unrated_items(items: DataFrame, ratings: DataFrame, user_id: int) -> DataFrame:
    """(user_id, item_id) for every item the user has not rated."""
    rated = ratings.where(F.col("user_id") == user_id).select("item_id")
    return (items.select("item_id").join(rated, "item_id", "left_anti")
                 .select(F.lit(user_id).cast("long").alias("user_id"), "item_id"))


def ids_of(df: DataFrame, col: str, name: str) -> DataFrame:
    """(col, name): a dense number for every different value, for models that take ints only."""
    dense = dense_index(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], name)
    return cut_lineage(dense.withColumn(name, F.col(name).cast("int")))


def indexed(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ratings with user_ix and item_ix in place of their ids, written once, and
    (item_id, item_ix).  ``ratings`` is read three times: hand it in written."""
    users, items = ids_of(ratings, "user_id", "user_ix"), ids_of(ratings, "item_id", "item_ix")
    # an id is dropped as soon as it is looked up: fits and their errors need the numbers only
    out = ratings.join(broadcast_pinned(users), "user_id").drop("user_id")
    return written(out.join(broadcast_pinned(items), "item_id").drop("item_id")), items


def als(rank: int, seed: int = 42, max_iter: int = 5, reg: float = 0.1, blocks: int = 10) -> ALS:
    """``blocks``: how many parts the user and the item factors each are dealt to;
    raise it with the cluster.  Works on the dense ids of ``indexed``.  Factors are
    checkpointed after every pass: the shuffle files of the one before can go then."""
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol="user_ix", numUserBlocks=blocks,
               numItemBlocks=blocks, itemCol="item_ix", ratingCol="rating", coldStartStrategy="drop",
               checkpointInterval=1)


def rmse(pred: DataFrame) -> float:
    pred = pred.where(~F.isnan("prediction"))
    return RegressionEvaluator(predictionCol="prediction", labelCol="rating",
                               metricName="rmse").evaluate(pred)


def train_select_rank(train: DataFrame, val: DataFrame, ranks=(4, 8, 12), seed: int = 42):
    """Fit ALS per rank; return (rows of (rank, val_rmse), best model).
    Train and validation frames are cached for the loop only."""
    rows, best = [], None
    train, val = train.cache(), val.cache()
    try:
        for r in ranks:
            model = als(r, seed).fit(train)
            e = rmse(model.transform(val))
            rows.append((r, float(e)))
            if best is None or e < best[1]:
                best = (model, e)
    finally:
        train.unpersist()
        val.unpersist()
    return rows, best[0]


def recommend(model, candidates: DataFrame, stats: DataFrame, min_ratings: int = 75,
              k: int = 25, user_ix: int = -1) -> DataFrame:
    """The ``k`` best of the candidates of one user among items with more than
    ``min_ratings`` ratings: the user's factors enter as a literal, so candidates
    join item factors on the item alone.  ``candidates`` holds item_id and item_ix."""
    vector = model.userFactors.where(F.col("id") == user_ix).first()
    weights = F.array(*[F.lit(float(x)) for x in (vector["features"] if vector else [0.0] * model.rank)])
    product = F.zip_with(F.transform("features", lambda x: x.cast("double")), weights, lambda a, b: a * b)
    pred = candidates.join(model.itemFactors, candidates.item_ix == F.col("id")).select(
        "item_id", F.aggregate(product, F.lit(0.0), lambda a, x: a + x).cast("float").alias("prediction"))
    if vector is None:
        pred = pred.limit(0)
    j = pred.join(stats, "item_id").where(F.col("n_ratings") > min_ratings)
    return j.orderBy(F.desc("prediction"), F.asc("item_id")).limit(k) \
            .select("item_id", "title", "n_ratings", "prediction")
