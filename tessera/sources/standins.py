"""Record sets the analyses run on, each derived from the driver tables by
Spark itself (so their size grows with the tables):

* web log       — CLF text lines rendered from ``events``
* plays         — lines of ``documents.text``
* catalogues    — ``benchmark`` (A) and ``documents`` (B) for record linkage
* gold pairs    — (item, doc) where the doc contains the item's text
* ratings/items — ``orders`` x ``lineitem`` and ``part`` titles
* power / songs — ``lineitem`` numeric columns
* ad clicks     — ``lineitem`` x ``part`` x ``supplier`` categorical features
* series        — ``embeddings`` arrays
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..functions.weblog import clf_line
from ..plans import broadcast_if_small, broadcast_pinned, cut_lineage
from .tables import table

# The status code each event type stands for in the rendered web log.
STATUS_BY_EVENT = {"view": 200, "click": 200, "signup": 302, "purchase": 304, "error": 404}


# ---------------------------------------------------------------- web log
def status_expr(event_type) -> F.Column:
    e = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = None
    for k, v in STATUS_BY_EVENT.items():
        expr = (F.when(e == k, F.lit(v)) if expr is None else expr.when(e == k, F.lit(v)))
    return expr.otherwise(F.lit(500))


def weblog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CLF line per event in column ``value``.

    host ``u<user_id>.example.com``; path ``/<event_type>/<k>``; status by
    event type; size ``floor(value)``, ``-`` for errors.  Some lines are malformed:
    every 101st event has no path, every 103rd a size with a letter, every 107th
    a status with one."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1)
    status = status_expr("event_type")
    size = F.when(F.col("event_type") == "error", F.lit("-")) \
            .otherwise(F.floor("value").cast("long").cast("string"))
    every = lambda n: F.col("event_id") % n == 0
    size = F.when(every(103), F.concat(F.lit("x"), size)).otherwise(size)
    code = status.cast("string")
    code = F.when(every(107), F.concat(F.substring(code, 1, 1), F.lit("x"), F.substring(code, 3, 1))).otherwise(code)
    path = F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), k, F.lit(" "))
    line = clf_line(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.com")),
                    F.col("ts"), F.lit("GET"), F.when(every(101), F.lit("")).otherwise(path), code, size)
    return ev.select(line.alias("value"))


# ---------------------------------------------------------------- plays
def play_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.explode_outer(T.lines("text")).alias("value")).where(F.col("value").isNotNull())


# ---------------------------------------------------------------- linkage
def catalogue_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("rec_id"), "text")


def catalogue_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("rec_id"), "text")


def _sampled_grams(text_col, k: int, stride: int):
    """k-grams of a text at positions 0, stride, 2*stride, ..., in one pass over it."""
    return F.regexp_extract_all(text_col, F.lit(f"(?s)(?=(.{{{k}}})).{{1,{stride}}}"), F.lit(1))


def _pattern_grams(pat_col, k: int, stride: int):
    """The pattern's k-grams at offsets 0..stride-1."""
    return F.transform(F.sequence(F.lit(0), F.lit(stride - 1)),
                       lambda o: F.substring(pat_col, o + 1, k))


def containment_pairs(patterns: DataFrame, docs: DataFrame, k: int = 16) -> DataFrame:
    """(pat_id, doc_id) for every document whose ``text`` contains ``pat``.

    Exact, without comparing every pattern with every document.  A pattern of
    length L that occurs at text position p covers p..p+L-1.  Index each
    document by its k-grams at positions that are multiples of s = L-k+1:
    one indexed position q lies in [p, p+s-1], and the document k-gram there
    equals the pattern's k-gram at offset q-p < s.  So an equi-join of indexed
    document grams with the pattern's s grams finds every true occurrence, and
    ``instr`` then verifies each candidate.  Patterns of one length class
    share one index: full-length patterns use s = L_max-k+1; shorter ones (if
    any) get a second index at the stride of the shortest of them.  Longer
    grams are more selective, so a gram that is common on both sides (the
    only source of candidate fan-out) is rare; ``instr`` keeps it exact."""
    patterns = patterns.where(F.length("pat") > 0)
    lens = patterns.agg(F.max(F.length("pat")).alias("hi"), F.min(F.length("pat")).alias("lo")).first()
    if lens is None or lens["hi"] is None:
        return patterns.select("pat_id").withColumn("doc_id", F.lit(None).cast("long")).limit(0)
    tiers = [(lens["hi"], lens["hi"])]
    if lens["lo"] < lens["hi"]:
        tiers.append((lens["lo"], lens["hi"] - 1))
    cands = None
    for lo, hi in tiers:
        kk = min(k, lo)
        stride = lo - kk + 1
        tier = patterns.where(F.length("pat").between(lo, hi))
        pg = tier.select("pat_id", F.explode(_pattern_grams(F.col("pat"), kk, stride)).alias("gram"))
        dg = docs.select("doc_id", F.explode_outer(_sampled_grams(F.col("text"), kk, stride)).alias("gram"))
        c = dg.join(broadcast_pinned(cut_lineage(pg.distinct())), "gram").select("pat_id", "doc_id").distinct()
        cands = c if cands is None else cands.unionByName(c)
    # few documents are candidates: their texts need no shuffle then
    cands = broadcast_pinned(cut_lineage(cands.distinct().join(patterns, "pat_id")))
    return docs.join(cands, "doc_id").where(F.instr("text", F.col("pat")) > 0).select("pat_id", "doc_id")


def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, doc_id): the document contains the item's text."""
    pats = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("pat_id"), F.col("text").alias("pat"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return containment_pairs(pats, docs).withColumnRenamed("pat_id", "item_id")


# ---------------------------------------------------------------- ratings
def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating): rating ceil(l_quantity/10) of each
    (o_custkey, l_partkey), averaged over repeats."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return (j.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
             .agg(F.avg(F.ceil(F.col("l_quantity") / 10).cast("double")).alias("rating")))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"),
                                                F.col("p_name").alias("title"))


# ---------------------------------------------------------------- power / songs
def power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric regression table: label l_extendedprice ~ quantity, discount, tax."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                     F.col("l_extendedprice").alias("label"))


# ---------------------------------------------------------------- ad clicks
CTR_FEATURES = ("l_linestatus", "p_brand", "p_type", "p_size", "s_nationkey")


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rid, l_orderkey, l_linenumber, label, feats array<struct<_1 long, _2 string>>).

    (l_orderkey, l_linenumber) is not unique in the table, so each record gets
    ``rid``, a row id assigned on the scan (before any shuffle)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                  "l_suppkey", "l_returnflag", "l_linestatus") \
        .withColumn("rid", F.monotonically_increasing_id())
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(broadcast_if_small(p), li.l_partkey == p.p_partkey) \
          .join(broadcast_if_small(s), li.l_suppkey == s.s_suppkey)
    feats = F.array(*[F.struct(F.lit(i).cast("long").alias("_1"), F.col(c).cast("string").alias("_2"))
                      for i, c in enumerate(CTR_FEATURES)])
    return j.select("rid", "l_orderkey", "l_linenumber",
                    (F.col("l_returnflag") == "R").cast("double").alias("label"),
                    feats.alias("feats"))


# ---------------------------------------------------------------- series
def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label",
                    F.transform("embedding", lambda x: x.cast("double")).alias("values"))
