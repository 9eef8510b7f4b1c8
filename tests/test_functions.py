"""Unit goldens for the column helpers (values from the original exercises)."""
import math

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as T
from tessera.functions.hashing import feature_key, md5_bucket
from tessera.functions.ml import log_loss, sigmoid_clamped
from tessera.functions.weblog import clf_time, parse_clf_columns


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_simple_tokenize(spark):
    got = one(spark, [("A quick brown fox jumps over the lazy dog.",), (" ",), ("!!!!123A/456_B/789C.123A",),
                      ("fox fox",)], "s string", T.simple_tokenize("s"))
    assert got == [["a", "quick", "brown", "fox", "jumps", "over", "the", "lazy", "dog"], [],
                   ["123a", "456_b", "789c", "123a"], ["fox", "fox"]]


def test_tokenize_drops_stopwords_keeps_duplicates(spark):
    got = one(spark, [("The fox and the fox",)], "s string", T.tokenize("s"))
    assert got == [["fox", "fox"]]


def test_clean_text(spark):
    got = one(spark, [(" The Elephant's 4 cats. ",), ("Hi, you!",), (" *      Remove punctuation then spaces  * ",)],
              "s string", T.clean_text("s"))
    assert got == ["the elephants 4 cats", "hi you", "remove punctuation then spaces"]


def test_md5_buckets_match_goldens(spark):
    def buckets(sample, m):
        rows = [(fid, cat) for fid, cat in sample]
        df = spark.createDataFrame(rows, "fid long, cat string")
        b = df.select(md5_bucket(feature_key(F.col("fid"), F.col("cat")), m).alias("b")).collect()
        out = {}
        for r in b:
            out[r.b] = out.get(r.b, 0.0) + 1.0
        return out
    assert buckets([(0, "mouse"), (1, "black")], 4) == {3: 2.0}
    assert buckets([(0, "bear"), (1, "black"), (2, "salmon")], 100) == {80: 1.0, 82: 1.0, 51: 1.0}


def test_md5_bucket_equals_python_bigint(spark):
    import hashlib
    keys = [f"k{i}:{i % 7}" for i in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for m in (3, 1000, 2 ** 15, 2 ** 31 - 1):
        got = [r[0] for r in df.select(md5_bucket("k", m)).collect()]
        want = [int(hashlib.md5(k.encode()).hexdigest(), 16) % m for k in keys]
        assert got == want


def test_log_loss_goldens(spark):
    rows = [(.5, 1), (.5, 0), (.99, 1), (.99, 0), (.01, 1), (.01, 0), (1., 1)]
    got = one(spark, rows, "p double, label long", log_loss("p", "label"))
    want = [0.6931471805599451, 0.6931471805599451, 0.010050335853501338, 4.60517018598808,
            4.605170185988081, 0.010050335853501338, -0.0]
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(got, want))


def test_sigmoid_clamped(spark):
    got = one(spark, [(0.0,), (100.0,), (-100.0,)], "x double", sigmoid_clamped("x"))
    assert got[0] == 0.5
    assert math.isclose(got[1], 1 / (1 + math.exp(-20)))
    assert math.isclose(got[2], 1 / (1 + math.exp(20)))


def test_folds_goldens(spark):
    df = spark.createDataFrame([([0., 1., 2., 3., 4., 5.],)], "v array<double>")
    r = df.select(A.fold_by_phase("v", 2), A.fold_by_phase("v", 3), A.fold_by_block("v", 2),
                  A.fold_by_block("v", 3)).first()
    assert list(r[0]) == [6.0, 9.0] and list(r[1]) == [3.0, 5.0, 7.0]
    assert list(r[2]) == [1.0, 5.0, 9.0] and list(r[3]) == [3.0, 12.0]


def test_dot_norm_elementwise(spark):
    df = spark.createDataFrame([([1., 2., 3.], [4., 5., 6.])], "a array<double>, b array<double>")
    r = df.select(A.dot("a", "b"), A.norm("a"), A.multiply("a", "b"), A.scale("a", 2.0)).first()
    assert r[0] == 32.0 and math.isclose(r[1], math.sqrt(14))
    assert list(r[2]) == [4.0, 10.0, 18.0] and list(r[3]) == [2.0, 4.0, 6.0]


def test_two_way_products(spark):
    df = spark.createDataFrame([([2., 3.],)], "v array<double>")
    r = df.select(F.concat("v", A.outer_flat("v"))).first()[0]
    assert list(r) == [2.0, 3.0, 4.0, 6.0, 6.0, 9.0]


def test_clf_parse_and_time(spark):
    line = 'gw7.example.net - - [01/Aug/1995:00:00:01 -0400] "GET /docs/2/index-05.txt HTTP/1.0" 200 1839'
    bad = 'host - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 404 -'
    df = spark.createDataFrame([(line,), (bad,)], "value string")
    p = df.select(*parse_clf_columns("value")).withColumn("time", clf_time("timestamp")).collect()
    assert p[0].host == "gw7.example.net" and p[0].path == "/docs/2/index-05.txt"
    assert p[0].status == 200 and p[0].content_size == 1839
    assert str(p[0].time) == "1995-08-01 00:00:01"
    assert p[1].status == 404 and p[1].content_size is None


def test_clf_malformed_fields(spark):
    head = 'h - - [01/Aug/1995:00:00:01 -0400] '
    rows = [head + '"GET HTTP/1.0" 200 5', head + '"GET /x HTTP/1.0" 200 x9', head + '"GET /x HTTP/1.0" 200 -9',
            head + '"GET /x HTTP/1.0" 4x4 7', "nothing like it", "", None]
    p = spark.createDataFrame([(r,) for r in rows], "value string").select(*parse_clf_columns("value")).collect()
    assert [r.path for r in p] == ["", "/x", "/x", "/x", "", "", None]
    assert [r.status for r in p] == [200, 200, 200, None, None, None, None]
    assert [r.content_size for r in p] == [5, None, None, 7, None, None, None]
