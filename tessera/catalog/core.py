"""Sources, projections, filters, joins, aggregates, sorts, sets, scalar
functions, UDFs and the catalog — each applied to the driver tables."""
from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Row, Window, functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType)

from ..functions import arrays as A
from ..functions import text as TX
from ..functions.ml import sigmoid_clamped, squared_error
from ..functions.weblog import clf_time
from ..operators import relational as R
from ..operators import weblog as WL
from ..plans import broadcast_if_small, cut_lineage, dense_index
from ..sources import standins as S
from ..sources import text as SRC
from ..sources.tables import table
from .registry import register
from .sqlparts import LOGS_CTE, tokens_expr


def _t(spark, sf, name):
    return table(spark, sf, name)


def _r4(c):
    return F.round(c, 4)


# =========================================================== 2.1 sources
_STATUS_VALUES = ", ".join(f"('{k}', {v})" for k, v in S.STATUS_BY_EVENT.items())


@register("src_local_rows", f"""
SELECT s.status::BIGINT AS status, count(*) AS n
FROM events e JOIN (VALUES {_STATUS_VALUES}) AS s(event_type, status) USING (event_type)
GROUP BY s.status""")
def src_local_rows(spark, sf):
    m = SRC.local_rows(spark, list(S.STATUS_BY_EVENT.items()), ["event_type", "status"])
    return _t(spark, sf, "events").join(m, "event_type").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# Language code -> language name.
_LANGS = [("en", "English"), ("fr", "French"), ("de", "German"), ("es", "Spanish")]


@register("src_local_partitioned", """
SELECT l.name AS language, count(*) AS n
FROM documents d JOIN (VALUES ('en','English'),('fr','French'),('de','German'),('es','Spanish')) AS l(lang, name)
USING (lang) GROUP BY l.name""")
def src_local_partitioned(spark, sf):
    langs = SRC.local_partitioned(spark, _LANGS, ["lang", "name"], 2)
    d = _t(spark, sf, "documents")
    return (d.join(F.broadcast(langs), "lang").groupBy(F.col("name").alias("language"))
             .agg(F.count(F.lit(1)).alias("n")))


@register("src_rows_reflect", """
SELECT s.status_name, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders o JOIN (VALUES ('F','finished'),('O','open'),('P','partial')) AS s(code, status_name)
ON o.o_orderstatus = s.code GROUP BY s.status_name""")
def src_rows_reflect(spark, sf):
    rows = [Row(code="F", status_name="finished"), Row(code="O", status_name="open"),
            Row(code="P", status_name="partial")]
    st = spark.createDataFrame(rows)
    o = _t(spark, sf, "orders")
    return (o.join(F.broadcast(st), o.o_orderstatus == st.code).groupBy("status_name")
             .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))


_LINES_SQL = """
SELECT count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars, count(DISTINCT line) AS n_distinct
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"""


def _staged_doc_lines(spark, sf, files=None):
    d = _t(spark, sf, "documents").select(F.col("text").alias("value"))
    return SRC.stage_lines(d, "doclines", files)


def _line_stats(lines):
    return lines.agg(F.count(F.lit(1)).alias("n_lines"),
                     F.sum(F.length("value")).cast("long").alias("n_chars"),
                     F.countDistinct("value").alias("n_distinct"))


@register("src_text", _LINES_SQL)
def src_text(spark, sf):
    return _line_stats(SRC.read_text(spark, _staged_doc_lines(spark, sf)))


@register("src_text_partitions", _LINES_SQL)
def src_text_partitions(spark, sf):
    return _line_stats(SRC.read_text(spark, _staged_doc_lines(spark, sf), min_partitions=8))


@register("src_dir_multi", """
SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang""")
def src_dir_multi(spark, sf):
    d = _t(spark, sf, "documents").select(F.concat_ws("\t", "lang", F.col("n_chars").cast("string")).alias("value"))
    path = SRC.stage_lines(d, "dir", files=4)
    lines = SRC.read_text(spark, path)
    parts = lines.select(F.split("value", "\t").alias("p"))
    return (parts.groupBy(F.col("p")[0].alias("lang"))
                 .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("p")[1].cast("long")).alias("chars")))


def _stage_lineitem_tsv(spark, sf, header=True):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag",
                                          "l_linestatus")
    path = SRC.staging_path(spark, "tsv")
    li.write.option("sep", "\t").option("header", header).csv(path)
    return path


@register("src_csv_infer", """
SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty, sum(l_orderkey)::BIGINT AS keysum
FROM lineitem GROUP BY l_returnflag""")
def src_csv_infer(spark, sf):
    df = SRC.read_delimited(spark, _stage_lineitem_tsv(spark, sf), sep="\t", header=True)
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"),
                                          F.sum("l_orderkey").cast("long").alias("keysum"))


@register("src_csv_schema", """
SELECT l_partkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY l_partkey""")
def src_csv_schema(spark, sf):
    schema = StructType([StructField("l_orderkey", LongType(), True),
                         StructField("l_partkey", LongType(), True),
                         StructField("l_quantity", DoubleType(), True)])
    df = SRC.read_delimited(spark, _stage_lineitem_tsv(spark, sf), sep="\t", header=True, schema=schema)
    return df.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


# The product-record pattern and its header id.
PRODUCT_RE = r'^(.+),"(.+)",(.*),(.*),(.*)'
_LINEBREAKS = r"[\r\n\x{85}\x{2028}\x{2029}]"


def product_lines(spark, sf):
    d = _t(spark, sf, "documents")
    gen = d.select(F.concat(F.col("doc_id").cast("string"), F.lit(',"'),
                            F.regexp_replace("text", _LINEBREAKS, " "), F.lit('",'), F.col("lang"),
                            F.lit(","), F.col("source"), F.lit(","), F.col("n_chars").cast("string"))
                   .alias("value"))
    fixed = spark.createDataFrame([('"id","name","description","manufacturer","price"',),
                                   ("this line is not a record",)], ["value"])
    return gen.unionByName(fixed)


@register("src_regex_quarantine", r"""
WITH lines AS (
  SELECT CAST(doc_id AS VARCHAR) || ',"' || regexp_replace(text, '[\r\n\x{85}\x{2028}\x{2029}]', ' ', 'g')
         || '",' || lang || ',' || source || ',' || CAST(n_chars AS VARCHAR) AS value FROM documents
  UNION ALL SELECT '"id","name","description","manufacturer","price"'
  UNION ALL SELECT 'this line is not a record')
SELECT status, count(*) AS n,
       sum(length(replace(g1, '"', '')) + length(g2 || ' ' || g3 || ' ' || g4))::BIGINT AS parsed_chars
FROM (SELECT CASE WHEN NOT regexp_matches(value, '^(.+),"(.+)",(.*),(.*),(.*)') THEN -1
                  WHEN regexp_extract(value, '^(.+),"(.+)",(.*),(.*),(.*)', 1) = '"id"' THEN 0 ELSE 1 END AS status,
             regexp_extract(value, '^(.+),"(.+)",(.*),(.*),(.*)', 1) AS g1,
             regexp_extract(value, '^(.+),"(.+)",(.*),(.*),(.*)', 2) AS g2,
             regexp_extract(value, '^(.+),"(.+)",(.*),(.*),(.*)', 3) AS g3,
             regexp_extract(value, '^(.+),"(.+)",(.*),(.*),(.*)', 4) AS g4
      FROM lines)
GROUP BY status""")
def src_regex_quarantine(spark, sf):
    q = SRC.regex_quarantine(product_lines(spark, sf), PRODUCT_RE, header_id='"id"')
    product = F.concat_ws(" ", "g2", "g3", "g4")
    return (q.groupBy("status")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.length(SRC.strip_quotes(F.col("g1"))) + F.length(product)).cast("long")
                  .alias("parsed_chars")))


@register("parse_clf", LOGS_CTE + r"""
SELECT host, strftime(time, '%d/%b/%Y:%H:%M:%S') || ' -0000' AS timestamp, path, status,
       CASE WHEN size_ok THEN content_size END AS content_size FROM logs""")
def parse_clf(spark, sf):
    return WL.parse(S.weblog_lines(spark, sf))


@register("parse_label_features", """
SELECT l_orderkey, l_linenumber, l_extendedprice AS label, p.pos - 1 AS pos, p.value
FROM lineitem, LATERAL (SELECT * FROM (VALUES (1, l_quantity), (2, l_discount), (3, l_tax)) AS v(pos, value)) p""")
def parse_label_features(spark, sf):
    li = _t(spark, sf, "lineitem")
    text = F.concat_ws(",", *[F.col(c).cast("string") for c in
                              ("l_extendedprice", "l_quantity", "l_discount", "l_tax")])
    raw = li.select("l_orderkey", "l_linenumber", text.alias("text"))
    parts = F.split("text", ",")
    parsed = raw.select("l_orderkey", "l_linenumber", parts[0].cast("double").alias("label"),
                        F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: x.cast("double"))
                        .alias("features"))
    return parsed.select("l_orderkey", "l_linenumber", "label",
                         F.posexplode("features").alias("pos", "value"))


_CTR_SQL = """
WITH recs AS (
  SELECT row_number() OVER () AS rid, l.l_orderkey, l.l_linenumber, CASE WHEN l.l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS label,
         l.l_linestatus AS c0, p.p_brand AS c1, p.p_type AS c2, CAST(p.p_size AS VARCHAR) AS c3,
         CAST(s.s_nationkey AS VARCHAR) AS c4
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey),
feats AS (
  SELECT rid, l_orderkey, l_linenumber, label, 0::BIGINT AS feature_id, c0 AS category FROM recs
  UNION ALL SELECT rid, l_orderkey, l_linenumber, label, 1, c1 FROM recs
  UNION ALL SELECT rid, l_orderkey, l_linenumber, label, 2, c2 FROM recs
  UNION ALL SELECT rid, l_orderkey, l_linenumber, label, 3, c3 FROM recs
  UNION ALL SELECT rid, l_orderkey, l_linenumber, label, 4, c4 FROM recs)
"""


@register("parse_indexed_features", _CTR_SQL + """
SELECT l_orderkey, l_linenumber, label, feature_id, category FROM feats""")
def parse_indexed_features(spark, sf):
    recs = S.ad_clicks(spark, sf)
    line = F.concat_ws(",", F.col("label").cast("string"),
                       *[F.col("feats")[i].getField("_2") for i in range(len(S.CTR_FEATURES))])
    raw = recs.select("l_orderkey", "l_linenumber", line.alias("text"))
    parts = F.split("text", ",")
    feats = F.transform(F.slice(parts, 2, F.size(parts) - 1),
                        lambda x, i: F.struct(i.cast("long").alias("_1"), x.alias("_2")))
    parsed = raw.select("l_orderkey", "l_linenumber", parts[0].cast("double").alias("label"),
                        feats.alias("feats"))
    return parsed.select("l_orderkey", "l_linenumber", "label", F.explode("feats").alias("f")) \
                 .select("l_orderkey", "l_linenumber", "label", F.col("f._1").alias("feature_id"),
                         F.col("f._2").alias("category"))


@register("parse_series", """
SELECT vec_id AS x, label AS y, i - 1 AS pos, CAST(embedding[i] AS DOUBLE) AS value
FROM embeddings, range(1, 65) r(i) WHERE i <= len(embedding)""")
def parse_series(spark, sf):
    e = S.series(spark, sf)
    line = F.concat_ws(" ", F.col("vec_id").cast("string"), F.col("label").cast("string"),
                       F.array_join(F.transform("values", lambda x: x.cast("string")), " "))
    raw = e.select(line.alias("value"))
    parts = F.split("value", " ")
    parsed = raw.select(parts[0].cast("long").alias("x"), parts[1].cast("int").alias("y"),
                        F.transform(F.slice(parts, 3, F.size(parts) - 2), lambda v: v.cast("double"))
                        .alias("values"))
    return parsed.select("x", "y", F.posexplode("values").alias("pos", "value"))


# =========================================================== 2.2 projections
@register("proj_select", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def proj_select(spark, sf):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")


@register("proj_compute_alias", """
SELECT l_orderkey, l_linenumber, l_quantity - 1 AS qty_minus_one,
       l_extendedprice * (1 - l_discount) AS disc_price FROM lineitem""")
def proj_compute_alias(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (li.l_quantity - 1).alias("qty_minus_one"),
                     (li.l_extendedprice * (1 - li.l_discount)).alias("disc_price"))


@register("proj_expr", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
       l_tax * 100 AS tax_pct FROM lineitem""")
def proj_expr(spark, sf):
    return _t(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge",
        "l_tax * 100 AS tax_pct")


@register("proj_with_column", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate,
       o_orderpriority, year(o_orderdate)::INTEGER AS o_year FROM orders""")
def proj_with_column(spark, sf):
    o = _t(spark, sf, "orders")
    return (o.withColumn("o_totalprice", F.col("o_totalprice") * 2)
             .withColumn("o_year", F.year("o_orderdate")))


@register("proj_rename", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority FROM orders""")
def proj_rename(spark, sf):
    return (_t(spark, sf, "orders").withColumnRenamed("o_orderkey", "order_id")
            .withColumnRenamed("o_custkey", "customer_id").withColumnRenamed("no_such_column", "x"))


@register("proj_drop", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def proj_drop(spark, sf):
    return _t(spark, sf, "orders").drop("o_orderdate", "o_orderpriority", "no_such_column")


@register("proj_column_refs", """
SELECT event_type, count(*) AS count, count(*) * 2 AS count_x2 FROM events GROUP BY event_type""")
def proj_column_refs(spark, sf):
    c = _t(spark, sf, "events").groupBy("event_type").count()
    return c.select(c.event_type, c["count"], (F.col("count") * 2).alias("count_x2"))


@register("proj_literal", """
SELECT r_regionkey, r_name, 1 AS one, 'region' AS kind, r_name || 's' AS plural FROM region""")
def proj_literal(spark, sf):
    r = _t(spark, sf, "region")
    return r.select("r_regionkey", "r_name", F.lit(1).alias("one"), F.lit("region").alias("kind"),
                    TX.pluralize("r_name").alias("plural"))


@register("proj_case", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class
FROM lineitem""")
def proj_case(spark, sf):
    li = _t(spark, sf, "lineitem")
    q = F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber",
                     F.when(q < 10, "small").when(q < 30, "medium").otherwise("large").alias("size_class"))


@register("proj_cast", r"""
SELECT event_id, CAST(trunc(value) AS INTEGER) AS value_int, CAST(user_id AS DOUBLE) AS user_double,
       TRY_CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k,
       TRY_CAST(event_type AS INTEGER) AS bad_int, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts_sec
FROM events""")
def proj_cast(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", F.col("value").cast("int").alias("value_int"),
                    F.col("user_id").cast("double").alias("user_double"),
                    F.regexp_extract("props", r"(\d+)", 1).try_cast("int").alias("k"),
                    F.col("event_type").try_cast("int").alias("bad_int"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("ts_sec"))


@register("sql_select_alias", """
SELECT n_nationkey AS nation_key, n_name AS nation, n_regionkey AS region FROM nation""")
def sql_select_alias(spark, sf):
    return spark.sql("SELECT n_nationkey AS nation_key, n_name AS nation, n_regionkey AS region FROM {nation}",
                     nation=_t(spark, sf, "nation"))


@register("sql_select_star", "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def sql_select_star(spark, sf):
    return spark.sql("SELECT * FROM {customer} ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
                     customer=_t(spark, sf, "customer"))


# =========================================================== 2.3 filters
@register("filt_compare", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE (l_quantity < 5 OR l_quantity > 45) AND l_linestatus != 'O' AND l_discount >= 0.05 AND l_tax <= 0.04""")
def filt_compare(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.where(((li.l_quantity < 5) | (li.l_quantity > 45)) & (li.l_linestatus != "O")
                    & (li.l_discount >= 0.05) & (li.l_tax <= 0.04)) \
             .select("l_orderkey", "l_linenumber", "l_quantity")


@register("filt_sql_string", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def filt_sql_string(spark, sf):
    return _t(spark, sf, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 100000") \
                                  .select("o_orderkey", "o_totalprice")


@register("filt_and", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'""")
def filt_and(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.where((li.l_returnflag == "A") & (li.l_linestatus == "F")).select("l_orderkey", "l_linenumber")


@register("filt_or_isnull", LOGS_CTE + """
SELECT host, path, status, CASE WHEN size_ok THEN content_size END AS content_size
FROM logs WHERE NOT size_ok OR status IS NULL""")
def filt_or_isnull(spark, sf):
    p = WL.parse(S.weblog_lines(spark, sf))
    cols = ["host", "path", "status", "content_size"]
    return p.where(R.any_null(p, cols)).select(*cols)


@register("filt_not_rlike", "SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '[0-9]')")
def filt_not_rlike(spark, sf):
    return _t(spark, sf, "documents").where(~F.col("text").rlike("[0-9]")).select("doc_id")


# Customer ids excluded by the NOT IN filter.
_EXCLUDED = [0, 1, 2, 3, 5, 8, 13, 21, 34, 55]


@register("filt_not_in", f"""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN ({', '.join(map(str, _EXCLUDED))})""")
def filt_not_in(spark, sf):
    o = _t(spark, sf, "orders")
    return o.where(~o.o_custkey.isin(_EXCLUDED)).select("o_orderkey", "o_custkey")


@register("filt_not_nan", """
SELECT event_id, value AS score FROM events WHERE event_type <> 'error'""")
def filt_not_nan(spark, sf):
    e = _t(spark, sf, "events")
    scored = e.select("event_id", F.when(e.event_type == "error", F.lit(float("nan")))
                      .otherwise(e.value).alias("score"))
    return scored.where(~F.isnan("score"))


@register("filt_nonempty", """
SELECT count(*) AS n_lines FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE line <> ''""")
def filt_nonempty(spark, sf):
    return S.play_lines(spark, sf).where(F.col("value") != "").agg(F.count(F.lit(1)).alias("n_lines"))


@F.pandas_udf(BooleanType())
def _is_even(s: pd.Series) -> pd.Series:
    return s % 2 == 0


@F.pandas_udf(BooleanType())
def _below_100(s: pd.Series) -> pd.Series:
    return s < 100


@register("filt_udf", "SELECT event_id, user_id FROM events WHERE user_id % 2 = 0 AND user_id < 100")
def filt_udf(spark, sf):
    e = _t(spark, sf, "events")
    return e.where(_is_even("user_id") & _below_100("user_id")).select("event_id", "user_id")


@register("filt_key_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 7""")
def filt_key_lookup(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.where(li.l_orderkey == 7).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@register("filt_series_stat", """
SELECT vec_id, round(s, 4) AS stddev FROM (
  SELECT vec_id, list_aggregate(CAST(embedding AS DOUBLE[]), 'stddev_pop') AS s FROM embeddings)
WHERE s > 0.124""")
def filt_series_stat(spark, sf):
    e = S.series(spark, sf).select("vec_id", A.pop_stddev("values").alias("s"))
    return e.where(F.col("s") > 0.124).select("vec_id", _r4(F.col("s")).alias("stddev"))


# =========================================================== 2.4 joins
@register("join_inner", """
SELECT l_orderkey, l_linenumber, o_custkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_inner(spark, sf):
    li, o = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", "o_custkey",
                                                            "o_orderdate")


@register("join_ratio", LOGS_CTE + """
, req AS (SELECT day(time) AS day, count(*) AS requests FROM logs GROUP BY 1),
  hosts AS (SELECT day(time) AS day, count(DISTINCT host) AS hosts FROM logs GROUP BY 1)
SELECT day::INTEGER AS day, round(requests / hosts, 4) AS ratio FROM req JOIN hosts USING (day)""")
def join_ratio(spark, sf):
    logs = WL.logs(S.weblog_lines(spark, sf))
    day = F.dayofmonth("time").alias("day")
    req = logs.groupBy(day).agg(F.count(F.lit(1)).alias("requests"))
    hosts = logs.groupBy(day).agg(F.countDistinct("host").alias("hosts"))
    return req.join(hosts, "day").select("day", _r4(F.col("requests") / F.col("hosts")).alias("ratio"))


@register("join_pair_inner", """
SELECT o.key, c_name AS name, n_orders FROM (SELECT o_custkey AS key, count(*) AS n_orders FROM orders GROUP BY 1) o
JOIN (SELECT c_custkey AS key, c_name FROM customer) c USING (key)""")
def join_pair_inner(spark, sf):
    o = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("n_orders"))
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return o.join(c, on="key")


@register("join_left_default", """
SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def join_left_default(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey")
    o = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return c.join(o, c.c_custkey == o.o_custkey, "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).cast("long").alias("n_orders"))


@register("join_anti", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)""")
def join_anti(spark, sf):
    c, o = _t(spark, sf, "customer"), _t(spark, sf, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", "c_name")


@register("join_broadcast", """
SELECT n_name, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def join_broadcast(spark, sf):
    li, s, n = _t(spark, sf, "lineitem"), _t(spark, sf, "supplier"), _t(spark, sf, "nation")
    dim = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name")
    return (li.join(broadcast_if_small(dim), li.l_suppkey == dim.s_suppkey).groupBy("n_name")
              .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")))


# =========================================================== 2.5 aggregations
@register("agg_group_count", """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2""")
def agg_group_count(spark, sf):
    return _t(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").count()


@register("agg_count_action", "SELECT count(*) AS count FROM lineitem")
def agg_count_action(spark, sf):
    return _t(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("count"))


@register("agg_global", """
SELECT round(avg(l_quantity), 4) AS avg_qty, min(l_extendedprice) AS min_price,
       max(l_extendedprice) AS max_price FROM lineitem""")
def agg_global(spark, sf):
    return _t(spark, sf, "lineitem").agg(_r4(F.avg("l_quantity")).alias("avg_qty"),
                                         F.min("l_extendedprice").alias("min_price"),
                                         F.max("l_extendedprice").alias("max_price"))


@register("agg_multi", """
SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS avg_price, min(o_totalprice) AS min_price,
       max(o_totalprice) AS max_price FROM orders GROUP BY 1""")
def agg_multi(spark, sf):
    return _t(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), _r4(F.avg("o_totalprice")).alias("avg_price"),
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"))


@register("agg_avg_expr", """
SELECT round(avg(l_tax), 6) AS avg_tax, round(sum(l_discount), 4) AS sum_disc FROM lineitem""")
def agg_avg_expr(spark, sf):
    return _t(spark, sf, "lineitem").selectExpr("round(avg(l_tax), 6) AS avg_tax",
                                                "round(sum(l_discount), 4) AS sum_disc")


@register("agg_sum_all_numeric", """
SELECT p_type, sum(p_partkey)::BIGINT AS "sum(p_partkey)", sum(p_size)::BIGINT AS "sum(p_size)",
       round(sum(p_retailprice), 4) AS "sum(p_retailprice)" FROM part GROUP BY p_type""")
def agg_sum_all_numeric(spark, sf):
    p = _t(spark, sf, "part").select("p_type", "p_partkey", "p_size", "p_retailprice")
    s = R.sum_all_numeric(p, "p_type")
    return s.withColumn("sum(p_retailprice)", _r4(F.col("sum(p_retailprice)")))


@register("agg_distinct_count", "SELECT count(DISTINCT l_partkey) AS n_parts FROM lineitem")
def agg_distinct_count(spark, sf):
    return _t(spark, sf, "lineitem").agg(F.countDistinct("l_partkey").alias("n_parts"))


@register("agg_distinct_then_count", """
SELECT o_orderstatus, count(*) AS n_customers FROM (SELECT DISTINCT o_orderstatus, o_custkey FROM orders) GROUP BY 1""")
def agg_distinct_then_count(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderstatus", "o_custkey").distinct()
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_customers"))


@register("agg_two_level_mean", LOGS_CTE + """
SELECT day::INTEGER AS day, round(avg(n), 4) AS avg_reqs_per_host
FROM (SELECT day(time) AS day, host, count(*) AS n FROM logs GROUP BY 1, 2) GROUP BY day""")
def agg_two_level_mean(spark, sf):
    out = WL.daily_mean_per_host_two_level(WL.logs(S.weblog_lines(spark, sf)))
    return out.select("day", _r4(F.col("avg_reqs_per_host")).alias("avg_reqs_per_host"))


@register("agg_null_counts", LOGS_CTE + """
SELECT 0::BIGINT AS host, 0::BIGINT AS timestamp, 0::BIGINT AS path,
       count(*) FILTER (WHERE status IS NULL) AS status, count(*) FILTER (WHERE NOT size_ok) AS content_size FROM logs""")
def agg_null_counts(spark, sf):
    return R.null_counts(WL.parse(S.weblog_lines(spark, sf)))


@register("agg_describe", """
SELECT 'count' AS summary, round(count(l_quantity), 4) AS l_quantity, round(count(l_discount), 4) AS l_discount FROM lineitem
UNION ALL SELECT 'mean', round(avg(l_quantity), 4), round(avg(l_discount), 4) FROM lineitem
UNION ALL SELECT 'stddev', round(stddev_samp(l_quantity), 4), round(stddev_samp(l_discount), 4) FROM lineitem
UNION ALL SELECT 'min', round(min(l_quantity), 4), round(min(l_discount), 4) FROM lineitem
UNION ALL SELECT 'max', round(max(l_quantity), 4), round(max(l_discount), 4) FROM lineitem""")
def agg_describe(spark, sf):
    return R.describe_rounded(_t(spark, sf, "lineitem"), ["l_quantity", "l_discount"])


@register("agg_having", """
SELECT o_custkey, count(*) AS count FROM orders GROUP BY 1 HAVING count(*) > 15""")
def agg_having(spark, sf):
    return _t(spark, sf, "orders").groupBy("o_custkey").count().where(F.col("count") > 15)


@register("agg_group_expr", """
SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class,
       count(*) AS n FROM lineitem GROUP BY 1""")
def agg_group_expr(spark, sf):
    return spark.sql("""
      SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END
             AS size_class, count(*) AS n
      FROM {lineitem} GROUP BY CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium'
                                    ELSE 'large' END""", lineitem=_t(spark, sf, "lineitem"))


@register("agg_fraction", """
SELECT round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 6) AS frac_returned FROM lineitem""")
def agg_fraction(spark, sf):
    return _t(spark, sf, "lineitem").agg(F.round(R.fraction(F.col("l_returnflag") == "R"), 6)
                                         .alias("frac_returned"))


@register("agg_collect_values", """
SELECT l_orderkey, array_to_string(list_sort(list(l_linenumber)), ',') AS linenumbers
FROM lineitem GROUP BY l_orderkey""")
def agg_collect_values(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(F.collect_list("l_linenumber")), ",").alias("linenumbers"))


@register("agg_sum_grouped_values", """
SELECT l_orderkey, sum(l_quantity) AS total_qty FROM lineitem GROUP BY 1""")
def agg_sum_grouped_values(spark, sf):
    return _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total_qty"))


@register("agg_reduce_by_key", """
SELECT l_suppkey, sum(l_quantity) AS total_qty, count(*) AS n FROM lineitem GROUP BY 1""")
def agg_reduce_by_key(spark, sf):
    return _t(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total_qty"),
                                                             F.count(F.lit(1)).alias("n"))


@register("agg_reduce", "SELECT sum(l_quantity) AS total_qty FROM lineitem")
def agg_reduce(spark, sf):
    return _t(spark, sf, "lineitem").agg(F.sum("l_quantity").alias("total_qty"))


@register("agg_rdd_stats", """
SELECT min(o_totalprice) AS min, max(o_totalprice) AS max, round(sum(o_totalprice), 2) AS sum,
       round(avg(o_totalprice), 4) AS mean, count(*) AS count FROM orders""")
def agg_rdd_stats(spark, sf):
    c = F.col("o_totalprice")
    return _t(spark, sf, "orders").agg(F.min(c).alias("min"), F.max(c).alias("max"),
                                       F.round(F.sum(c), 2).alias("sum"), _r4(F.avg(c)).alias("mean"),
                                       F.count(F.lit(1)).alias("count"))


@register("agg_array_elements", """
SELECT i - 1 AS pos, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS mean, round(sum(CAST(embedding[i] AS DOUBLE)), 4) AS total
FROM embeddings, range(1, 65) r(i) WHERE i <= len(embedding) GROUP BY i""")
def agg_array_elements(spark, sf):
    e = R.element_sums(_t(spark, sf, "embeddings"), "embedding")
    return e.select("pos", F.round(F.col("total") / F.col("n"), 6).alias("mean"), _r4(F.col("total")).alias("total"))


@register("agg_array_sizes", "SELECT sum(len(string_split(text, ' ')))::BIGINT AS n_pieces FROM documents")
def agg_array_sizes(spark, sf):
    return _t(spark, sf, "documents").agg(F.sum(F.size(F.split("text", " "))).cast("long").alias("n_pieces"))


@register("agg_label_histogram", "SELECT quality, count(*) AS count FROM labels GROUP BY 1")
def agg_label_histogram(spark, sf):
    return _t(spark, sf, "labels").groupBy("quality").count()


@register("agg_log_histogram", """
SELECT CAST(floor(ln(n)) AS INTEGER) AS bucket, count(*) AS count
FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1""")
def agg_log_histogram(spark, sf):
    per = _t(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(F.ln("n").cast("int").alias("bucket")).count()


@register("agg_bin_counters", """
SELECT CAST(floor(l_discount * 100) AS INTEGER) AS bin, count(*) AS count FROM lineitem GROUP BY 1""")
def agg_bin_counters(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.groupBy((F.col("l_discount") * 100).cast("int").alias("bin")).count()


# =========================================================== 2.6 sort / top-k / numbering
@register("sort_multi", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_totalprice, o_orderkey""")
def sort_multi(spark, sf):
    return _t(spark, sf, "orders").orderBy(F.desc("o_orderdate"), "o_totalprice", "o_orderkey") \
                                  .select("o_orderkey", "o_orderdate", "o_totalprice")


@register("topk_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def topk_rows(spark, sf):
    return R.top_k(_t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10,
                   F.desc("o_totalprice"), F.asc("o_orderkey"))


@register("topk_by_key", """
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 10""")
def topk_by_key(spark, sf):
    return R.top_k(_t(spark, sf, "part").select("p_partkey", "p_retailprice"), 10,
                   F.asc("p_retailprice"), F.asc("p_partkey"))


@register("topk_largest", "SELECT l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC LIMIT 5")
def topk_largest(spark, sf):
    return R.top_k(_t(spark, sf, "lineitem").select("l_extendedprice"), 5, F.desc("l_extendedprice"))


@register("limit_rows", "SELECT least(count(*), 100) AS n FROM orders")
def limit_rows(spark, sf):
    return _t(spark, sf, "orders").limit(100).agg(F.count(F.lit(1)).alias("n"))


@register("row_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx FROM orders""")
def row_index(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return dense_index(o, ["o_orderdate", "o_orderkey"], "idx").select("o_orderkey", "idx")


# =========================================================== 2.7 sets, samples, splits
@register("set_union_all", """
SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT CAST(c_nationkey AS BIGINT), c_name FROM customer""")
def set_union_all(spark, sf):
    s = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = _t(spark, sf, "customer").select("c_nationkey", "c_name")
    return s.union(c)


@register("set_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def set_distinct(spark, sf):
    return _t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@register("set_drop_duplicates", "SELECT DISTINCT o_custkey FROM orders")
def set_drop_duplicates(spark, sf):
    return _t(spark, sf, "orders").dropDuplicates(["o_custkey"]).select("o_custkey")


# Which rows a random sample or split takes differs between engines; what must
# hold of it does not: size, members of the table, no row twice.
def _members(sample, whole):
    """(n_missing) rows of ``sample`` that ``whole`` does not have."""
    keys = ["l_orderkey", "l_linenumber"]
    return sample.join(whole.select(*keys).distinct(), keys, "left_anti").agg(F.count(F.lit(1)).alias("n_missing"))


@register("smp_fraction", "SELECT true AS in_bounds, 0::BIGINT AS n_missing")
def smp_fraction(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    got = li.sample(withReplacement=False, fraction=0.1, seed=42)
    n = li.count()
    bounds = got.agg(F.count(F.lit(1)).between(int(0.08 * n), int(0.12 * n) + 1).alias("in_bounds"))
    return bounds.withColumn("n_missing", F.lit(_members(got, li).first()["n_missing"]))


@register("smp_fixed_n", "SELECT least(50, count(*))::BIGINT AS n, 0::BIGINT AS n_missing FROM lineitem")
def smp_fixed_n(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    got = R.sample_fixed_n(li, 50, seed=42)
    return got.agg(F.count(F.lit(1)).alias("n")).withColumn("n_missing", F.lit(_members(got, li).first()["n_missing"]))


@register("split_weights", """
SELECT count(*) AS n_total, count(*) AS n_distinct, true AS in_bounds FROM lineitem""")
def split_weights(spark, sf):
    li = cut_lineage(_t(spark, sf, "lineitem").select("l_orderkey").withColumn("rid", F.monotonically_increasing_id()))
    weights = [0.6, 0.2, 0.2]
    out = None
    for i, p in enumerate(li.randomSplit(weights, seed=42)):
        p = p.select("rid", F.lit(i).alias("split"))
        out = p if out is None else out.unionByName(p)
    near = [F.abs(F.count_if(F.col("split") == i) / F.count(F.lit(1)) - w) < 0.03 for i, w in enumerate(weights)]
    return out.agg(F.count(F.lit(1)).alias("n_total"), F.count_distinct("rid").alias("n_distinct"),
                   (near[0] & near[1] & near[2]).alias("in_bounds"))


@register("split_by_key", """
SELECT CASE WHEN b < 60 THEN 0 WHEN b < 80 THEN 1 ELSE 2 END AS split, count(*) AS n
FROM (SELECT ((l_orderkey * 8 + l_linenumber) * 7919 + 13) % 100 AS b FROM lineitem) GROUP BY 1""")
def split_by_key(spark, sf):
    li = _t(spark, sf, "lineitem").withColumn("key", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    parts = R.split_by_key(li, "key", [0.6, 0.2, 0.2])
    out = None
    for i, p in enumerate(parts):
        c = p.agg(F.count(F.lit(1)).alias("n")).withColumn("split", F.lit(i))
        out = c if out is None else out.unionByName(c)
    return out


# =========================================================== 2.8 scalar functions
@register("fn_concat", """
SELECT c_custkey, c_name || ' (' || c_mktsegment || ')' AS label, c_mktsegment || 's' AS plural FROM customer""")
def fn_concat(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("label"),
                    TX.pluralize("c_mktsegment").alias("plural"))


@register("fn_length", "SELECT p_partkey, length(p_name) AS name_len FROM part")
def fn_length(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", F.length("p_name").alias("name_len"))


@register("fn_clean_text", """
SELECT lower(trim(regexp_replace(line, '[[:punct:]]', '', 'g'))) AS value
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""")
def fn_clean_text(spark, sf):
    return S.play_lines(spark, sf).select(TX.clean_text("value").alias("value"))


@register("fn_regex_extract", r"SELECT event_id, regexp_extract(props, '(\d+)', 1) AS k FROM events")
def fn_regex_extract(spark, sf):
    return _t(spark, sf, "events").select("event_id", F.regexp_extract("props", r"(\d+)", 1).alias("k"))


@register("fn_split_getitem", """
SELECT c_custkey, string_split(c_name, '#')[1] AS prefix, string_split(c_name, '#')[2] AS number FROM customer""")
def fn_split_getitem(spark, sf):
    parts = F.split("c_name", "#")
    return _t(spark, sf, "customer").select("c_custkey", parts.getItem(0).alias("prefix"),
                                            parts.getItem(1).alias("number"))


@register("fn_explode", """
SELECT item_id, unnest(string_split(text, ' ')) AS piece FROM benchmark""")
def fn_explode(spark, sf):
    return _t(spark, sf, "benchmark").select("item_id", F.explode(F.split("text", " ")).alias("piece"))


@register("fn_getfield", _CTR_SQL + """
SELECT l_orderkey, l_linenumber, c1 AS brand, c3 AS size FROM recs""")
def fn_getfield(spark, sf):
    r = S.ad_clicks(spark, sf)
    return r.select("l_orderkey", "l_linenumber", F.col("feats")[1].getField("_2").alias("brand"),
                    F.col("feats")[3].getField("_2").alias("size"))


@register("fn_size", """
SELECT item_id, len(string_split(text, ' '))::INTEGER AS n_pieces FROM benchmark""")
def fn_size(spark, sf):
    return _t(spark, sf, "benchmark").select("item_id", F.size(F.split("text", " ")).alias("n_pieces"))


@register("fn_format_number", "SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price FROM orders")
def fn_format_number(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", F.format_number("o_totalprice", 2).alias("price"))


@register("fn_clf_timestamp", LOGS_CTE + "SELECT time FROM logs")
def fn_clf_timestamp(spark, sf):
    p = WL.parse(S.weblog_lines(spark, sf))
    return p.select(clf_time("timestamp").alias("time"))


@register("fn_dayofmonth", "SELECT event_id, day(ts)::INTEGER AS day FROM events")
def fn_dayofmonth(spark, sf):
    return _t(spark, sf, "events").select("event_id", F.dayofmonth("ts").alias("day"))


@register("fn_hour", "SELECT event_id, hour(ts)::INTEGER AS hour FROM events")
def fn_hour(spark, sf):
    return _t(spark, sf, "events").select("event_id", F.hour("ts").alias("hour"))


@register("fn_log", """
SELECT event_type, count(*) AS n, round(ln(count(*)), 6) AS log_n FROM events GROUP BY 1""")
def fn_log(spark, sf):
    c = _t(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("log_n", F.round(F.ln("n"), 6))


@register("fn_sigmoid", """
SELECT l_orderkey, l_linenumber,
       round(1.0 / (1.0 + exp(-least(greatest((l_quantity - 25) / 5.0, -20.0), 20.0))), 8) AS p FROM lineitem""")
def fn_sigmoid(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(sigmoid_clamped((F.col("l_quantity") - 25) / 5.0), 8).alias("p"))


@register("fn_squared_error", """
SELECT l_orderkey, l_linenumber, round((l_extendedprice - l_quantity * 1000) * (l_extendedprice - l_quantity * 1000), 4) AS se
FROM lineitem""")
def fn_squared_error(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     _r4(squared_error(F.col("l_extendedprice"), F.col("l_quantity") * 1000)).alias("se"))


@register("fn_fillna", LOGS_CTE + "SELECT host, path, status, content_size FROM logs")
def fn_fillna(spark, sf):
    p = WL.parse(S.weblog_lines(spark, sf))
    return p.na.fill({"content_size": 0}).select("host", "path", "status", "content_size")


@register("fn_row_hash", """
SELECT l_orderkey, l_linenumber,
       sha256(concat_ws(' ', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_returnflag, l_linestatus)) AS h
FROM lineitem""")
def fn_row_hash(spark, sf):
    li = _t(spark, sf, "lineitem")
    h = F.sha2(F.concat_ws(" ", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                           "l_returnflag", "l_linestatus"), 256)
    return li.select("l_orderkey", "l_linenumber", h.alias("h"))


_SIMPLE_TOKENS = r"list_filter(regexp_split_to_array(lower(text), '\W+'), lambda t: t <> '')"


@register("fn_tokenize", f"""
SELECT item_id, i - 1 AS pos, toks[i] AS token
FROM (SELECT item_id, {_SIMPLE_TOKENS} AS toks FROM benchmark), LATERAL (SELECT unnest(range(1, len(toks) + 1)) AS i)""")
def fn_tokenize(spark, sf):
    b = _t(spark, sf, "benchmark")
    return b.select("item_id", F.posexplode(TX.simple_tokenize("text")).alias("pos", "token"))


@register("fn_stopwords", f"""
SELECT item_id, i - 1 AS pos, toks[i] AS token
FROM (SELECT item_id, {tokens_expr('text')} AS toks FROM benchmark), LATERAL (SELECT unnest(range(1, len(toks) + 1)) AS i)""")
def fn_stopwords(spark, sf):
    b = _t(spark, sf, "benchmark")
    return b.select("item_id", F.posexplode(TX.tokenize("text")).alias("pos", "token"))


@register("fn_array_slice", """
SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_0, CAST(embedding[2] AS DOUBLE) AS first_1,
       CAST(embedding[len(embedding)] AS DOUBLE) AS last_0 FROM embeddings""")
def fn_array_slice(spark, sf):
    e = S.series(spark, sf)
    head, tail = F.slice("values", 1, 2), F.slice("values", -1, 1)
    return e.select("vec_id", head[0].alias("first_0"), head[1].alias("first_1"), tail[0].alias("last_0"))


@register("fn_array_concat", """
SELECT vec_id, len(embedding[1:2] || embedding[len(embedding) - 1:]) AS n,
       CAST((embedding[1:2] || embedding[len(embedding) - 1:])[3] AS DOUBLE) AS third FROM embeddings""")
def fn_array_concat(spark, sf):
    e = S.series(spark, sf)
    c = F.concat(F.slice("values", 1, 2), F.slice("values", -2, 2))
    return e.select("vec_id", F.size(c).alias("n"), c[2].alias("third"))


@register("fn_dot", """
SELECT vec_id, round(list_sum(list_transform(range(1, len(embedding) + 1),
       lambda i: CAST(embedding[i] AS DOUBLE) * (i - 1))), 4) AS dot FROM embeddings""")
def fn_dot(spark, sf):
    e = S.series(spark, sf)
    idx = F.transform("values", lambda x, i: i.cast("double"))
    return e.select("vec_id", _r4(A.dot("values", idx)).alias("dot"))


@register("fn_elementwise", """
SELECT vec_id, round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * 3.0)), 4) AS scaled_sum,
       round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)), 4) AS product_sum FROM embeddings""")
def fn_elementwise(spark, sf):
    e = S.series(spark, sf)
    return e.select("vec_id", _r4(A.total(A.scale("values", 3.0))).alias("scaled_sum"),
                    _r4(A.total(A.multiply("values", "values"))).alias("product_sum"))


@register("fn_norm", """
SELECT vec_id, round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 6) AS norm
FROM embeddings""")
def fn_norm(spark, sf):
    e = S.series(spark, sf)
    return e.select("vec_id", F.round(A.norm("values"), 6).alias("norm"))


@register("fn_array_minmax", """
SELECT vec_id, CAST(list_min(embedding) AS DOUBLE) AS min_value, CAST(list_max(embedding) AS DOUBLE) AS max_value
FROM embeddings""")
def fn_array_minmax(spark, sf):
    e = S.series(spark, sf)
    return e.select("vec_id", F.array_min("values").alias("min_value"), F.array_max("values").alias("max_value"))


# =========================================================== 2.9 user-defined functions
@F.pandas_udf(LongType())
def _name_len(s: pd.Series) -> pd.Series:
    return s.str.len().astype("int64")


@F.pandas_udf(StringType())
def _upper(s: pd.Series) -> pd.Series:
    return s.str.upper()


@register("udf_scalar", "SELECT p_partkey, length(p_name)::BIGINT AS name_len, upper(p_name) AS upper_name FROM part")
def udf_scalar(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", _name_len("p_name").alias("name_len"), _upper("p_name").alias("upper_name"))


@F.arrow_udf(ArrayType(StructType([StructField("idx", LongType()), StructField("word", StringType())])))
def _indexed_words(col: pa.Array) -> pa.Array:
    rows = [None if s is None else [{"idx": i, "word": w} for i, w in enumerate(s.split(" "))] for s in col.to_pylist()]
    return pa.array(rows, pa.list_(pa.struct([("idx", pa.int64()), ("word", pa.string())])))


@register("udf_array_struct", """
SELECT item_id, i - 1 AS idx, string_split(text, ' ')[i] AS word
FROM benchmark, LATERAL (SELECT unnest(range(1, len(string_split(text, ' ')) + 1)) AS i)""")
def udf_array_struct(spark, sf):
    b = _t(spark, sf, "benchmark").select("item_id", F.explode(_indexed_words("text")).alias("w"))
    return b.select("item_id", F.col("w.idx").alias("idx"), F.col("w.word").alias("word"))


@register("rdd_map", "SELECT l_orderkey, l_linenumber, l_quantity * 2 AS double_qty FROM lineitem")
def rdd_map(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2).alias("double_qty"))


@register("rdd_map_values", "SELECT o_custkey AS key, count(*) * 10 AS value FROM orders GROUP BY 1")
def rdd_map_values(spark, sf):
    kv = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    return kv.withColumn("value", F.col("value") * 10)


@register("udtf_flatmap", """
SELECT item_id, unnest(string_split(text, ' ')) AS piece FROM benchmark""")
def udtf_flatmap(spark, sf):
    from collections.abc import Iterator

    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.functions import arrow_udtf

    @arrow_udtf(returnType="item_id bigint, piece string")
    class Pieces:
        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:  # whole batches; null texts give nothing
            parts = pc.split_pattern(rows.column("text"), " ")
            yield pa.table({"item_id": rows.column("item_id").take(pc.list_parent_indices(parts)),
                            "piece": pc.list_flatten(parts)})

    spark.udtf.register("tessera_pieces", Pieces)
    return spark.sql("SELECT * FROM tessera_pieces(TABLE({benchmark}))",
                     benchmark=_t(spark, sf, "benchmark").select("item_id", "text"))


@register("udaf_accumulator", """
SELECT label, i - 1 AS pos, round(sum(CAST(embedding[i] AS DOUBLE)), 4) AS total
FROM embeddings, range(1, 65) r(i) WHERE i <= len(embedding) GROUP BY label, i""")
def udaf_accumulator(spark, sf):
    e = R.element_sums(_t(spark, sf, "embeddings"), "embedding", "label")
    return e.select("label", "pos", _r4(F.col("total")).alias("total"))


# =========================================================== 2.10 catalog
@register("cat_temp_view", """
SELECT r_name, count(*) AS n_nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def cat_temp_view(spark, sf):
    _t(spark, sf, "nation").createOrReplaceTempView("tv_nation")
    _t(spark, sf, "region").createOrReplaceTempView("tv_region")
    spark.sql("SELECT r_name, count(*) AS n_nations FROM tv_nation JOIN tv_region ON n_regionkey = r_regionkey "
              "GROUP BY r_name").createOrReplaceTempView("tv_nations_per_region")
    return spark.table("tv_nations_per_region")
