"""Plan-shape checks and helper correctness."""
import math

import pytest
from pyspark.sql import Window, functions as F

from tessera.catalog import ORACLE, QUERIES
from tessera.plans import assert_no_cartesian, assert_no_python_udf, dense_index, physical_plan, running_sums
from tessera.sources import standins as S

SF_SMALL = "/root/testdata/sf0.001"


def test_filters_and_columns_reach_the_scan(spark):
    df = QUERIES["filt_sql_string"](spark, SF_SMALL)
    plan = physical_plan(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_topk_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in physical_plan(QUERIES["topk_rows"](spark, SF_SMALL))


def test_hot_paths_have_no_cartesian_and_no_python(spark):
    for k in ("log_top_error_paths", "wc_top", "er_cosine_inverted", "er_threshold_counts",
              "ctr_hash_features", "ctr_ohe_encode", "rat_item_stats", "join_broadcast"):
        df = QUERIES[k](spark, SF_SMALL)
        assert_no_cartesian(df)
        assert_no_python_udf(df)


def test_gold_pairs_equal_brute_force(spark):
    got = {tuple(r) for r in S.gold_pairs(spark, SF_SMALL).collect()}
    items = [(r.item_id, r.text) for r in S.catalogue_a(spark, SF_SMALL)
             .withColumnRenamed("rec_id", "item_id").collect()]
    docs = [(r.rec_id, r.text) for r in S.catalogue_b(spark, SF_SMALL).collect()]
    want = {(i, d) for i, p in items if p for d, t in docs if p in t}
    assert got == want and len(want) > 0


def test_containment_handles_short_patterns(spark):
    pats = spark.createDataFrame([(1, "abc"), (2, "hello world, again and again"), (3, "zz")],
                                 "pat_id long, pat string")
    docs = spark.createDataFrame([(10, "xxabcxx hello world, again and again!"), (11, "zz top"), (12, "nothing")],
                                 "doc_id long, text string")
    got = {tuple(r) for r in S.containment_pairs(pats, docs).collect()}
    assert got == {(1, 10), (2, 10), (3, 11)}


def test_dense_index_matches_row_number(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderdate").repartition(5)
    got = dense_index(o, ["o_orderdate", "o_orderkey"], "idx")
    w = Window.orderBy("o_orderdate", "o_orderkey")
    want = o.withColumn("idx", F.row_number().over(w) - 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_running_sums_match_window(spark):
    df = spark.range(0, 1000).select((F.col("id") % 97).alias("k"), (F.col("id") % 13).cast("double").alias("v"))
    per = df.groupBy("k").agg(F.sum("v").alias("v"))
    got = {r.k: r.v_cum for r in running_sums(per, [F.desc("k")], ["v"]).collect()}
    w = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    want = {r.k: r.c for r in per.withColumn("c", F.sum("v").over(w)).collect()}
    assert got == want


def test_tokenizer_runs_once_per_catalogue(spark):
    # explode_outer keeps Spark from inferring a size(tokens) > 0 filter and
    # pushing a second copy of the tokenizer below the input spread
    plan = physical_plan(QUERIES["er_idf"](spark, SF_SMALL))
    lines = [l for l in plan.splitlines() if "regexp_replace(lower(" in l]
    assert len(lines) == 2, lines
    assert not any(l.strip().lstrip("+-: ").startswith("Filter") for l in lines), lines


PYTHON_KEYS = {"filt_udf", "udf_scalar", "udf_array_struct", "udtf_flatmap", "pca_covariance",
               "pca_center", "pca_project_line", "udf_vector", "udf_array_int", "agg_array_elements", "udaf_accumulator"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_and_python_only_where_meant(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert_no_cartesian(df)
    if key not in PYTHON_KEYS:
        assert_no_python_udf(df)


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in ORACLE))
def test_queries_without_a_twin(spark, key):
    rows = QUERIES[key](spark, SF_SMALL).collect()
    assert rows
    numbers = [v for r in rows for v in r.asDict().values() if isinstance(v, float)]
    assert all(math.isfinite(v) for v in numbers)
    if key == "als_train_select_rank":
        assert [r["rank"] for r in rows] == [4, 8, 12] and all(r["val_rmse"] > 0 for r in rows)
    if key in ("reg_forest", "lin_poly_pipeline", "lin_interaction_fit", "lin_elastic_fit"):
        assert rows[0]["rmse"] > 0 and rows[0].asDict().get("r2", 1) > -0.05  # prices are noise here
    if key == "reg_compare":
        assert {r["model"] for r in rows} == {"linear", "tree", "forest"} and all(r["r2"] > -0.05 for r in rows)
    if key == "reg_cv_linear":
        assert len(rows) == 10
    if key == "ctr_evaluate":
        loss = {(r["model"], r["part"]): r["log_loss"] for r in rows}
        assert len(loss) == 6 and all(0 < v < 2 for v in loss.values())
    if key == "pca_eigenvalues":
        v = [r["eigenvalue"] for r in rows]
        assert v == sorted(v, reverse=True) and v[-1] > -1e-9


def test_python_keys_work_on_whole_batches(spark):
    for key in ("udf_vector", "udf_array_int", "udtf_flatmap", "agg_array_elements", "udaf_accumulator"):
        plan = physical_plan(QUERIES[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "Arrow" in plan and "posexplode" not in plan


def test_element_sums(spark):
    from tessera.operators.relational import element_sums

    rows = [("a", 1, [1.0, 2.0]), ("a", 1, [3.0, None, 5.0]), ("b", 1, None), (None, 2, [7.0]), ("a", 2, []), (None, 2, [1.0])]
    df = spark.createDataFrame(rows * 50, "k string, m int, v array<double>").repartition(3)
    got = {(r["k"], r["m"], r["pos"]): (r["total"], r["n"]) for r in element_sums(df, "v", "k", "m").collect()}
    assert got == {("a", 1, 0): (200.0, 100), ("a", 1, 1): (100.0, 50), ("a", 1, 2): (250.0, 50), (None, 2, 0): (400.0, 100)}
    assert {r["pos"]: r["total"] for r in element_sums(df, "v").collect()} == {0: 600.0, 1: 100.0, 2: 250.0}
    assert element_sums(df.limit(0), "v", "k").count() == 0


def test_broadcasts_follow_real_sizes(spark):
    for key in ("ctr_ohe_encode", "ctr_probability"):
        assert "BroadcastHashJoin" in physical_plan(QUERIES[key](spark, SF_SMALL))


def test_pca_null_and_ragged_rows(spark):
    from tessera.operators import pca

    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 6.0],), (None,)], "values array<double>")
    assert pca.column_means(df) == [2.0, 4.0]
    cov = {(r.i, r.j): r["cov"] for r in pca.covariance(pca.center(df, [2.0, 4.0])).collect()}
    assert cov == {(0, 0): 1.0, (0, 1): 2.0, (1, 0): 2.0, (1, 1): 4.0}
    for bad in ([([1.0, 2.0, 9.0],), ([3.0],)], [([1.0, None],)]):
        with pytest.raises(Exception):
            pca.column_means(spark.createDataFrame(bad, "values array<double>").coalesce(1))


def _links(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    words = [f"w{k}" for k in range(60)]
    a = [(i, list(rng.choice(words, 8, p=np.r_[[0.3], np.full(59, 0.7 / 59)]))) for i in range(40)]
    b = [(100 + i, a[i][1][:6] + ["new"] if i % 4 == 0 else list(rng.choice(words, 9))) for i in range(60) if i < 40 or i % 4]
    return (spark.createDataFrame(a, "rec_id long, tokens array<string>"),
            spark.createDataFrame(b, "rec_id long, tokens array<string>"))


def test_similar_pairs_equal_all_pairs(spark):
    from tessera.operators import linkage as LK

    ra, rb = _links(spark)
    tf = LK.tf(LK.corpus_union(ra, rb))
    w = LK.tfidf(tf, LK.idf_from_tf(tf, ra.count() + rb.count()))
    u = LK.normalized(w)
    ua, ub = (u.where(F.col("source") == s).drop("source") for s in "AB")
    df = u.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    vec = {}
    for r in u.collect():
        vec.setdefault((r.source, r.rec_id), {})[r.token] = r.u
    sims = {(x, y): sum(v * vb[t] for t, v in va.items() if t in vb)
            for (s, x), va in vec.items() if s == "A" for (t_, y), vb in vec.items() if t_ == "B"}
    for least in (0.01, 0.2, 0.6):
        got = {(r.id_a, r.id_b): r.sim for r in LK.similar_pairs(ua, ub, df, least).collect()}
        want = {k: v for k, v in sims.items() if v >= least}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
        split = LK.candidates(ua, ub, df, least, per_part=3)  # hot tokens in parts: the same candidates
        assert {tuple(r) for r in split.collect()} == {tuple(r) for r in LK.candidates(ua, ub, df, least).collect()}
        met = LK.prefixes(ua, df, least).select(F.col("rec_id").alias("a"), "token").join(
            LK.prefixes(ub, df, least).select(F.col("rec_id").alias("b"), "token"), "token").select("a", "b").distinct()
        assert len(want) <= split.count() <= met.count()
    assert abs(LK.similarity_total(ua, ub).first()["total"] - sum(sims.values())) < 1e-9


def test_frequent_tokens_leave_the_prefixes(spark):
    from tessera.catalog.analyses import _Link
    from tessera.operators import linkage as LK

    link = _Link(spark, SF_SMALL)
    unit, df = link.units
    whole = unit.where(F.col("source") == "B").count()
    assert LK.prefixes(link.ub, df, 0.3).count() < whole
    top = df.orderBy(F.desc("df")).first()["token"]
    assert LK.prefixes(link.ub, df, 0.3).where(F.col("token") == top).count() < unit.where(
        (F.col("source") == "B") & (F.col("token") == top)).count()


def test_tf_adds_up_records_that_come_again(spark):
    from tessera.operators import linkage as LK

    rows = [(1, ["a", "b", "a"]), (1, ["a", "c", "c"]), (1, ["a"]), (2, []), (3, None), (None, ["x"]), (None, ["x"]), (4, ["é", "a"])]
    rt = spark.createDataFrame(rows, "rec_id long, tokens array<string>").repartition(3)
    want = {(1, "a", 1.0, 3), (1, "b", 1 / 3, 1), (1, "c", 2 / 3, 1), (1, "a", 1.0, 1), (None, "x", 2.0, 1),
            (4, "é", 0.5, 1), (4, "a", 0.5, 1)}
    got = sorted((str(r.rec_id), r.token, r.tf) for r in LK.tf(rt).collect())
    assert got == sorted((str(i), t, f) for i, t, f, _ in want)
    assert sorted(map(str, LK.tf(LK.term_counts(rt)).collect())) == sorted(map(str, LK.tf(rt).collect()))


def test_unique_records_are_counted_without_a_shuffle(spark):
    from tessera.operators import linkage as LK

    ra, rb = _links(spark)
    assert "Exchange" not in physical_plan(LK.tf(LK.corpus_union(ra, rb)))


def test_idf_join_by_parts_of_the_vocabulary(spark):
    from tessera.operators import linkage as LK

    ra, rb = _links(spark)
    tf = LK.tf(LK.corpus_union(ra, rb))
    idf = LK.idf_from_tf(tf, 100)
    rows = lambda df: sorted((r.source, r.rec_id, r.token, r.idf) for r in df.collect())
    want = rows(tf.join(idf, "token"))
    for most in (0, 600, 1 << 30):
        assert rows(LK.with_idf(tf, idf, most)) == want
    plan = physical_plan(LK.with_idf(tf, idf, 600))
    assert "BroadcastHashJoin" in plan and "ShuffledHashJoin" in plan


def test_units_hold_what_a_similarity_needs(spark):
    from tessera.catalog.analyses import _Link
    from tessera.operators import linkage as LK

    link = _Link(spark, SF_SMALL)
    whole = LK.normalized(LK.tfidf(link.tf_all, link.idf))
    ua, ub = link.side(whole, "A"), link.side(whole, "B")
    df = whole.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    want = {(r.id_a, r.id_b): r.sim for r in LK.similar_pairs(ua, ub, df).collect()}
    got = {(r.id_a, r.id_b): r.sim for r in link.sims().collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert link.units[0].count() < whole.count()
    total = LK.similarity_total(ua, ub).first()["total"]
    assert abs(LK.similarity_total(*link.every_unit).first()["total"] - total) < 1e-9 * max(1, total)


def test_sampled_grams_cover_the_text(spark):
    from tessera.sources.standins import _sampled_grams

    text = "aé\n😀bcdefghij" * 5
    df = spark.createDataFrame([(text,), ("ab",), (None,)], "t string")
    for k, stride in ((4, 3), (3, 7), (5, 5)):
        got = [r.g for r in df.select(_sampled_grams(F.col("t"), k, stride).alias("g")).collect()]
        assert got == [[text[i:i + k] for i in range(0, len(text) - k + 1, stride)], [], None]


def test_encoding_leaves_records_where_they_are_read(spark):
    from tessera.operators import ctr as CT

    rows = [(1, 1.0, [(0, "a"), (1, "x"), (0, "a")]), (2, 0.0, [(0, "b"), (1, None)]), (3, None, []), (4, 1.0, None), (5, 0.0, [(1, "new")])]
    recs = spark.createDataFrame(rows, "rid long, label double, feats array<struct<_1: long, _2: string>>")
    known = spark.createDataFrame([(0, "a", 0), (0, "b", 1), (1, "x", 2)], "feature_id long, category string, ohe_index long")
    coded = CT.ohe_encode(recs, known)
    assert sorted(map(tuple, coded.collect())) == [(1, 1.0, [0, 0, 2]), (2, 0.0, [1]), (5, 0.0, [])]
    hashed = CT.hashed_indices(recs, 1 << 15)
    assert {r.rid: len(r.indices) for r in hashed.collect()} == {1: 2, 2: 1, 3: 0, 4: 0, 5: 1}
    few, most = [sorted(map(str, coded.collect())), sorted((r.rid, sorted(r.indices)) for r in hashed.collect())], CT.MOST_PLACES
    for df in (coded, hashed):
        assert "hashpartitioning(rid" not in physical_plan(df)
    CT.MOST_PLACES = 0
    try:
        assert few == [sorted(map(str, CT.ohe_encode(recs, known).collect())),
                       sorted((r.rid, sorted(r.indices)) for r in CT.hashed_indices(recs, 1 << 15).collect())]
    finally:
        CT.MOST_PLACES = most


def test_records_that_come_again_are_encoded_together(spark):
    from tessera.operators import ctr as CT

    recs = spark.createDataFrame([(1, 1.0, [(0, "a"), (1, "x")]), (1, 1.0, [(0, "a"), (1, "new")]), (1, 0.0, [(0, "b")])],
                                 "rid long, label double, feats array<struct<_1: long, _2: string>>").repartition(3)
    known = spark.createDataFrame([(0, "a", 0), (0, "b", 1), (1, "x", 2)], "feature_id long, category string, ohe_index long")
    assert sorted(map(tuple, CT.ohe_encode(recs, known).collect())) == [(1, 0.0, [1]), (1, 1.0, [0, 0, 2])]
    hashed = {r.label: len(r.indices) for r in CT.hashed_indices(recs, 1 << 15).collect()}
    assert hashed == {1.0: 4, 0.0: 1}


def test_records_are_counted_from_their_text(spark):
    from tessera.operators import linkage as LK

    odd = ["Ab ab_1 the AB", "", None, "a\0b c", "KKm İx café CAFÉ É", " ,.; ", "the a of", "x" * 40 + "\nx\t\tX", "😀a😀"]
    recs = spark.createDataFrame(list(enumerate(odd)) + [(0, odd[0]), (0, "ab"), (None, "q q")], "rec_id long, text string").repartition(3)
    rows = lambda df: sorted((str(r.rec_id), r.token, r.tf) for r in df.collect())
    want = rows(LK.tf(LK.record_tokens(recs)))
    assert want and rows(LK.tf(recs)) == want == rows(LK.tf(LK.term_counts(recs), LK.repeated_keys(recs)))
    assert "BatchEvalPython" not in physical_plan(LK.term_counts(recs)) and "filter(" not in physical_plan(LK.term_counts(recs))


def test_lengths_and_units_of_wanted_records(spark):
    from tessera.operators import linkage as LK

    a = [(i, " ".join(f"w{j}" for j in range(i, i + 4))) for i in range(1, 9)] + [(2, "w2 w3 w3"), (2, "w9 w2 w3"), (None, "w1 w2")]
    b = [(i, " ".join(f"w{j % 11} z{i}" for j in range(i, i * 2))) for i in range(1, 30)] + [(3, "w3 w4 w5 z3"), (31, "z31"), (32, "")]
    frames = [spark.createDataFrame(r, "rec_id long, text string").repartition(2) for r in (a, b)]
    texts = LK.corpus_union(*frames)
    counted, again = LK.term_counts(texts), LK.repeated_keys(texts)
    tf = LK.tf(counted, again)
    idf = LK.idf_from_tf(tf, len(a) + len(b)).cache()
    w = LK.tfidf(tf, idf)
    want = {(r.source, r.rec_id): r.norm for r in LK.norms(w).collect()}
    both = {(r.source, r.rec_id): r.norm for r in LK.norms(w.where("shared")).collect()}
    for most in (0, 900, 2000, 1 << 30):
        got = {(r.source, r.rec_id): r for r in LK.lengths(tf, idf, most).collect()}
        assert got.keys() == want.keys()
        assert all(abs(r.norm - want[k]) < 1e-12 * want[k] and abs(r.shared - both.get(k, 0.0)) < 1e-9 for k, r in got.items())
    pairs = spark.createDataFrame([(2, 3), (2, 30), (5, 7)], "id_a long, id_b long")
    norm = LK.of_pairs(LK.lengths(tf, idf), pairs)
    rows = lambda df: sorted((r.source, r.rec_id, r.token, round(r.u, 12)) for r in df.collect())
    whole = [r for r in rows(LK.normalized(w)) if (r[0], r[1]) in {("A", 2), ("A", 5), ("B", 3), ("B", 7)}]
    assert rows(LK.units(counted, idf, norm, again)) == whole
    plan = LK.units(counted, idf, norm, again)._jdf.queryExecution().optimizedPlan().toString()
    assert min(plan.find(x) for x in ("Join Inner, ((source",)) >= 0 and plan.rfind("Join Inner, ((source") > plan.find("Generate")


def test_common_tokens_are_listed_while_candidates_are_verified(spark):
    from tessera.operators import linkage as LK

    near = [(1, "x", 0.8), (1, "y", 0.6), (2, "x", 0.1), (2, "z", 0.995), (None, "x", 1.0), (3, "y", 1.0), (3, "y", 1.0)]
    ua = spark.createDataFrame(near, "rec_id long, token string, u double")
    ub = spark.createDataFrame([(7, "x", 0.8), (7, "y", 0.6), (8, "x", 0.1), (8, "w", 0.995)], ua.schema)
    pairs = spark.createDataFrame([(1, 7), (1, 8), (2, 8), (2, 7), (3, 7)], "id_a long, id_b long")
    for least in (0.01, 0.05, 0.9):
        kept = LK.cosine_of_pairs(pairs, ua, ub).where(F.col("sim") >= least)
        want = sorted(map(str, LK.common_tokens(kept, ua, ub).collect()))
        both = LK.common_tokens(pairs, ua, ub, least)
        assert want and sorted(map(str, both.collect())) == want
        plan = both._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join Inner") == 2  # each side is joined once
    counted = both.select("id_a", "id_b", "n_common")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in counted


def test_total_similarity_comes_from_products_with_token_sums(spark):
    from tessera.catalog.analyses import _Link
    from tessera.operators import linkage as LK

    a = [(i, " ".join(f"w{j}" for j in range(i, i + 4))) for i in range(1, 9)] + [(2, "w2 w3 w3"), (2, "w9 w2 w3"), (None, "w1 w2")]
    b = [(i, " ".join(f"w{j % 11} z{i}" for j in range(i, i * 2))) for i in range(1, 30)] + [
        (3, "w3 w4 w5 z3"), (31, "z31"), (32, ""), (None, "w1 z1")]
    texts = LK.corpus_union(*[spark.createDataFrame(r, "rec_id long, text string").repartition(2) for r in (a, b)])
    tf = LK.tf(texts)
    idf = LK.idf_from_tf(tf, len(a) + len(b)).cache()
    unit = LK.normalized(LK.tfidf(tf, idf))
    ua, ub = (unit.where(F.col("source") == x).drop("source") for x in "AB")
    want = LK.similarity_total(ua, ub).first()["total"]
    for most in (0, 900, 2000, 1 << 30):
        got = LK.lengths(tf.where(F.col("source") == "B"), LK.weighed(idf, ua), most)
        assert abs(LK.similarity_total(ua, got).first()["total"] - want) < 1e-9 * want
    link = _Link(spark, SF_SMALL)
    ua, products = link.products
    assert "token" not in products.columns  # no vector of B is made
    total = LK.similarity_total(ua, products).first()["total"]
    assert abs(LK.similarity_total(*link.every_unit).first()["total"] - total) < 1e-9 * max(1, total)
    known, alone = ({(r.source, r.rec_id): (r.norm, r.shared) for r in x.lengths.collect()} for x in (link, _Link(spark, SF_SMALL)))
    assert known.keys() == alone.keys() and all(abs(known[k][i] - alone[k][i]) <= 1e-9 * alone[k][0] for k in alone for i in (0, 1))


def test_every_pair_that_shares_a_token_is_reported(spark, tmp_path, monkeypatch):
    from tessera.operators import linkage as LK

    frequent = [f"word {' '.join(f'own{i}x{j}' for j in range(300))}" for i in range(40)]
    items = [(1, "word rare alpha"), (2, "alpha beta"), (3, "lonely"), (None, "word")]
    docs = [*enumerate(frequent, 100), (200, "beta rare word word"), (201, "none of these"), (None, "alpha")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {(a, b): sorted(set(x.split()) & set(y.split())) for a, x in items for b, y in docs
            if None not in (a, b) and set(x.split()) & set(y.split())}
    rows = lambda key: QUERIES[key](spark, str(tmp_path)).collect()
    sims = {(r.id_a, r.id_b): r.sim for r in rows("er_cosine_inverted")}
    assert sims.keys() == want.keys() and min(sims.values()) < 0.01 < max(sims.values())
    assert {(r.id_a, r.id_b): r.tokens.split() for r in rows("er_common_tokens")} == want
    assert {(r.id_a, r.id_b): r.n_common for r in rows("join_token_inverted")} == {k: len(v) for k, v in want.items()}
    # a side that is not broadcast: the records of frequent tokens are split among parts
    monkeypatch.setattr(LK, "broadcast_pinned", lambda df: df)
    a, b = [spark.createDataFrame([(t, i) for i, x in side for t in set(x.split())], "token string, rec_id long")
            for side in (items, docs)]
    got = LK.token_pairs(a, b, per_part=7).collect()
    assert len(got) == sum(map(len, want.values())) and {(r.id_a, r.id_b) for r in got} == want.keys()
    assert len({r.part for r in got}) == 6


def test_rows_are_measured_not_files_before_a_broadcast(spark, tmp_path):
    from tessera.plans import broadcast_if_small

    spark.range(20_000).select("id", F.lit("one and the same long name").alias("name")).repartition(1).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    assert int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 400_000  # of the compressed file
    rows = spark.range(50).withColumnRenamed("id", "k")
    join = lambda most: rows.join(broadcast_if_small(t, most), F.col("k") == F.col("id"))
    assert "BroadcastHashJoin" not in physical_plan(join(400_000)) and join(400_000).count() == 50
    assert "BroadcastHashJoin" in physical_plan(join(2_000_000)) and join(2_000_000).count() == 50


@pytest.mark.parametrize("key", ["ctr_logreg", "ctr_logreg_hashed", "ctr_evaluate"])
def test_click_records_are_joined_once(spark, monkeypatch, key):
    from tessera.catalog import analyses as AN

    clicks = AN.S.ad_clicks(spark, SF_SMALL)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    monkeypatch.setattr(AN.S, "ad_clicks", lambda spark, sf: clicks.mapInArrow(count, clicks.schema))
    assert QUERIES[key](spark, SF_SMALL).count() > 0
    assert read.value == clicks.count()
