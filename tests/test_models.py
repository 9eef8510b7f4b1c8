"""Fits by sums over the rows, against plain recomputations and Spark ML."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.hashing import md5_bucket
from tessera.operators import ctr as CT
from tessera.operators import linear as LN
from tessera.operators import pca as PC
from tessera.operators import regression as RG
from tessera.operators import trees as TR


def _points(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 10, 0.1] + [1000, 0, -5]
    y = x @ [2.0, -1.0, 30.0] + rng.normal(size=n) + 1e5
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "key long, a double, b double, c double, label double")


def test_cv_ridge_equals_cross_validator(spark):
    df = _points(spark).withColumn("fold", (F.col("key") % 3).cast("int"))
    regs = [0.01, 0.1, 5.0]
    rows, total = RG.cv_ridge(df, ["a", "b", "c"], F.col("fold"), regs)
    cv = RG.cv_linear(df, ["a", "b", "c"], regs, fold_col="fold")
    assert np.allclose([e for _, e in rows], cv.avgMetrics, rtol=1e-6)
    lr = RG.linear_pipeline(["a", "b", "c"], reg=5.0).fit(df).stages[-1]
    intercept, weights = total.ridge(5.0)
    assert np.allclose(weights, lr.coefficients.toArray(), rtol=1e-6) and np.isclose(intercept, lr.intercept, rtol=1e-8)
    pred = RG.with_line(df, ["a", "b", "c"], intercept, weights)
    assert np.isclose(RG.rmse_r2(pred).first()["rmse"], total.rmse(intercept, weights), rtol=1e-6)


def test_fold_moments_skip_nulls_and_constant_features(spark):
    df = spark.createDataFrame([(0, 1.0, 7.0, 2.0), (1, 2.0, 7.0, 4.0), (0, 3.0, 7.0, 6.0), (1, None, 7.0, 1.0),
                                (1, 5.0, 7.0, None)], "f int, a double, k double, label double")
    m = RG.fold_moments(df, ["a", "k"], F.col("f"))
    assert m[0].gram[0, 0] == 2 and m[1].gram[0, 0] == 1
    intercept, weights = (m[0] + m[1]).ridge(0.0)
    assert np.allclose([intercept, *weights], [0, 2, 0], atol=1e-9)
    assert RG.fold_moments(df.limit(0), ["a", "k"], F.col("f")) == {}
    with pytest.raises(ValueError):
        RG.cv_ridge(df.where("f = 0"), ["a", "k"], F.col("f"))


def test_gradient_descent_equals_the_loop(spark):
    rng = np.random.default_rng(1)
    x, y = rng.random((500, 4)), rng.random(500) * 100
    df = spark.createDataFrame([(x[i].tolist(), float(y[i])) for i in range(500)] + [(None, 1.0), ([1.0] * 4, None)],
                               "features array<double>, label double").repartition(3)
    w, errors, history = LN.gradient_descent(df, 20)
    v = np.zeros(4)
    for i in range(20):
        e = x @ v - y
        assert np.isclose(errors[i], np.sqrt((e * e).mean()), rtol=1e-10)
        v = v - 1.0 / (500 * np.sqrt(i + 1)) * (x.T @ e)
        assert np.allclose(history[i], v, rtol=1e-10)
    assert w == history[-1] and LN.gradient_descent(df.limit(0), 3) == ([], [], [])


@pytest.mark.parametrize("n, d, k, width", [(400, 24, 5, 16), (300, 120, 4, 8), (6, 40, 10, 16), (50, 1, 3, 16)])
def test_leading_components(spark, n, d, k, width):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, d)) * np.geomspace(5, 0.5, d) + 3
    df = spark.createDataFrame([(r.tolist(),) for r in x] + [(None,)], "values array<double>").repartition(3)
    mean, vals, vecs, rows = PC.leading(df, k, width=width)
    c = np.cov(x.T, bias=True).reshape(d, d)
    want = np.linalg.eigvalsh(c)[::-1][:k]
    assert rows == n and np.allclose(mean, x.mean(0)) and np.allclose(vals, want, atol=1e-9 * want[0])
    assert np.abs(c @ vecs - vecs * vals).max() < 1e-8 * want[0] and np.allclose(vecs.T @ vecs, np.eye(len(vals)), atol=1e-9)
    assert (vecs[np.abs(vecs).argmax(0), range(vecs.shape[1])] > 0).all()
    assert np.isclose(PC.total_variance(df, mean), np.trace(c))


@pytest.mark.parametrize("buckets", [1, 7, 2 ** 15, 2 ** 31 - 1, 1000])
def test_md5_bucket(spark, buckets):
    keys = [f"k{i}" for i in range(40)] + ["", "é"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = dict(df.select("k", md5_bucket("k", buckets)).collect())
    assert got == {k: int(hashlib.md5(k.encode()).hexdigest(), 16) % buckets for k in keys}


def test_hashed_buckets_with_shared_ones_and_repeats(spark):
    rng = np.random.default_rng(3)
    recs = [(i, float(i % 2), [(int(f), str(rng.integers(0, 9))) for f in rng.integers(0, 6, int(rng.integers(0, 9)))])
            for i in range(120)] + [(500, 0.0, [(1, None), (1, "x"), (1, "x")]), (501, 1.0, [])]
    df = spark.createDataFrame(recs, "rid long, label double, feats array<struct<_1:bigint,_2:string>>")
    for m in (5, 64, 2 ** 15):
        want = {}
        for rid, label, feats in recs:
            for f, c in {x for x in feats if x[1] is not None}:
                b = int(hashlib.md5(f"{c}:{f}".encode()).hexdigest(), 16) % m
                want[rid, b] = want.get((rid, b), 0.0) + 1
        assert {(r["rid"], r["bucket"]): r["value"] for r in CT.hashed_buckets(df, m).collect()} == want
        indices = {r["rid"]: sorted(r["indices"]) for r in CT.hashed_indices(df, m).collect()}
        assert len(indices) == len(recs)
        assert all(indices[i] == sorted(b for (r, b), v in want.items() if r == i for _ in range(int(v))) for i in indices)
        got = CT.sparsity(df, 10, m).first()
        assert np.isclose(got["hashed_sparsity"], len(want) / len(recs) / m)


def test_trees_equal_spark_ml_by_fold(spark):
    from pyspark.ml.regression import DecisionTreeRegressor

    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 30, 900), rng.integers(0, 8, 900), rng.integers(0, 5, 900)]).astype(float)
    y = 1e5 + 50 * (x[:, 0] > 12) * x[:, 1] - 80 * (x[:, 2] == 3) + rng.normal(size=900)
    cols = ["a", "b", "c"]
    df = spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(900)],
                               "key long, a double, b double, c double, label double").repartition(3)
    trees, errors, cuts = TR.grow(df, cols, F.col("key") % 3, 3)
    for depth in (0, 2, 3):
        for k in (0, 1, 2) if depth else (1,):
            ml = DecisionTreeRegressor(maxDepth=depth, maxBins=100).fit(
                RG.assembler(cols).transform(df.where(F.col("key") % 3 != k)))
            held = df.where(F.col("key") % 3 == k)
            want = ml.transform(RG.assembler(cols).transform(held)).withColumnRenamed("prediction", "want")
            got = TR.with_tree(want, cols, trees[k], depth, cuts)
            assert got.where(F.abs(F.col("want") - F.col("prediction")) > 1e-6).count() == 0
            assert np.isclose(RG.rmse_r2(got).first()["rmse"], errors[k, depth], rtol=1e-8)


def test_trees_of_nulls_constants_many_values_and_empty_tables(spark):
    rows = [(i % 2, None if i % 5 == 0 else float(i), 7.0, None if i == 3 else float(i % 5 == 0) * 10) for i in range(400)]
    df = spark.createDataFrame(rows, "f int, a double, k double, label double")
    trees, errors, cuts = TR.grow(df, ["a", "k"], F.col("f"), 1, max_bins=16)
    assert cuts[1] == [] and 1 < len(cuts[0]) < 16 and set(trees) == {None, 0, 1}
    assert trees[None].splits[1].feature == 0  # nulls are in the last bin, all others left of it
    pred = TR.with_tree(df, ["a", "k"], trees[None], 1, cuts)
    assert {r["prediction"] for r in pred.where("a is null").collect()} == {10.0} and max(errors[k, 1] for k in (0, 1)) < 1e-6
    constant = TR.grow(df.withColumn("label", F.lit(1.0)), ["a"], F.col("f"), 2)[0]
    assert all(not t.splits and np.isclose(t.values[1], 1.0) for t in constant.values())
    assert TR.grow(df.limit(0), ["a"], F.col("f"), 2)[0] == {}
    with pytest.raises(ValueError):
        TR.cv_tree(df.where("f = 0"), ["a"], F.col("f"))


@pytest.mark.parametrize("key", ["als_evaluate", "als_recommend"])
def test_ratings_are_worked_out_once(spark, monkeypatch, key):
    from tessera.catalog import QUERIES, analyses as AN

    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(40) for i in range(1, 31) if (u + i) % 3]
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    ratings = spark.createDataFrame([*rows, (None, 5, 2.0), (7, None, 3.0)], "user_id long, item_id long, rating double")
    monkeypatch.setattr(AN.S, "ratings", lambda spark, sf: ratings.mapInArrow(count, ratings.schema))
    assert QUERIES[key](spark, "/root/testdata/sf0.001").count() > 0
    assert read.value == len(rows) + 2


def test_numbered_ratings_carry_no_ids(spark):
    from tessera.operators import ratings as RT

    df = spark.createDataFrame([(10, 7, 1.0), (30, 7, 2.0), (20, 5, 3.0), (None, 5, 4.0), (10, None, 5.0)],
                               "user_id long, item_id long, rating double")
    numbered, items = RT.indexed(df)
    assert sorted((r.user_ix, r.item_ix, r.rating) for r in numbered.collect()) == [(0, 1, 1.0), (1, 0, 3.0), (2, 1, 2.0)]
    assert set(numbered.columns) == {"user_ix", "item_ix", "rating"}
    assert sorted(map(tuple, items.collect())) == [(5, 0), (7, 1)]


def test_factors_are_checkpointed_every_pass_and_stay_the_same(spark):
    from tessera.operators import ratings as RT

    df = spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(9) if (u + i) % 4],
                               "user_ix int, item_ix int, rating double")
    estimator = RT.als(3)
    assert estimator.getCheckpointInterval() == 1
    never = RT.als(3).setCheckpointInterval(-1)
    factors = [{r.id: list(r.features) for r in e.fit(df).itemFactors.collect()} for e in (estimator, never)]
    assert factors[0] == factors[1] and len(factors[0]) == 9
