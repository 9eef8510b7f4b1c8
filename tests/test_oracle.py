"""Every registered query with a SQL twin equals DuckDB on sf0.001; the
rest run and satisfy their invariants."""
import math

import pytest

import __spark_entry__ as E

SF_SMALL = "/root/testdata/sf0.001"

SQL_KEYS = sorted(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_matches_duckdb(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[key])
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    want = _canon([d[0] for d in cur.description], cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["path", "count"]
    assert df.count() > 0


def test_pca_components_orthonormal_and_eigen(spark):
    import numpy as np
    from tessera.operators import pca as PC
    from tessera.sources import standins as S
    s = S.series(spark, SF_SMALL)
    mean, vals, vecs, comps = PC.pca(s, 3)
    cov = PC.covariance(PC.center(s, mean))
    d = len(mean)
    m = np.zeros((d, d))
    for r in cov.collect():
        m[r.i, r.j] = r.cov
    assert np.allclose(vecs.T @ vecs, np.eye(d), atol=1e-8)
    for k in range(3):
        assert np.allclose(m @ vecs[:, k], vals[k] * vecs[:, k], atol=1e-8)
    assert all(vals[i] >= vals[i + 1] for i in range(d - 1))
    assert math.isclose(float(np.trace(m)), float(vals.sum()), rel_tol=1e-9)
    assert comps.count() == 3


def test_gradient_descent_lowers_error(spark):
    rows = E.queries()["lin_gradient_descent"](spark, SF_SMALL).orderBy("iteration").collect()
    assert rows[0].rmse >= rows[-1].rmse


def test_linear_regression_matches_normal_equations(spark):
    import numpy as np
    from tessera.operators import regression as RG
    from tessera.sources import standins as S
    p = S.power(spark, SF_SMALL)
    pipe = RG.linear_pipeline(("l_quantity", "l_discount", "l_tax"), reg=0.0)
    lr = pipe.fit(p).stages[-1]
    data = np.array([(r.l_quantity, r.l_discount, r.l_tax, r.label) for r in p.collect()])
    x = np.hstack([data[:, :3], np.ones((len(data), 1))])
    beta = np.linalg.lstsq(x, data[:, 3], rcond=None)[0]
    assert np.allclose(list(lr.coefficients) + [lr.intercept], beta, rtol=1e-3, atol=1e-2)
