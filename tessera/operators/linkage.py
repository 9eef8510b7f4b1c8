"""Record linkage by TF-IDF weights and cosine similarity.

Weights are kept in long form ``(rec_id, token, w)``; every per-record
dictionary and broadcast dictionary of the original programs becomes a join.
Similar pairs come from an exact prefix-filtered join: of each record only the
rarest tokens are joined, down to where the rest of its unit vector is shorter
than the least similarity asked for; the pairs found are verified on all tokens.
Sums over all pairs are taken per token, without any pair.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import STOPWORDS, tokenize
from ..plans import broadcast_pinned, cut_lineage
from ..plans.joins import DEFAULT_BROADCAST_BYTES

# Threshold sweep resolution (100 thresholds, 101 bins) and the
# least similarity of a pair that is reported (one step of that sweep).
N_THRESHOLDS = 100
LEAST_SIM = 1 / N_THRESHOLDS
SEPARATOR = "\0"  # of packed tokens
# what a byte of lower-cased UTF-8 is to the tokenizer: itself in a word, else a space
_WORD = np.array([b if chr(b).isascii() and (chr(b).isalnum() or b == ord("_")) else 32 for b in range(256)], np.uint8)


def record_tokens(recs: DataFrame, text_col: str = "text") -> DataFrame:
    """(rec_id, tokens): lower-cased ``\\W+`` tokens, stop words removed, duplicates kept."""
    return recs.select("rec_id", tokenize(text_col).alias("tokens"))


def token_total(rt: DataFrame) -> DataFrame:
    return rt.agg(F.sum(F.size("tokens")).cast("long").alias("total_tokens"))


def biggest_record(rt: DataFrame) -> DataFrame:
    return (rt.select("rec_id", F.size("tokens").alias("n_tokens"))
              .orderBy(F.desc("n_tokens"), F.asc("rec_id")).limit(1))


def _keys(df: DataFrame) -> list[str]:
    return ["source", "rec_id"] if "source" in df.columns else ["rec_id"]


def _lists(size: np.ndarray, flat: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), flat)


def _split(texts: pa.Array) -> pa.ListArray:
    """Lower-cased texts at their runs of other bytes than those of words; empty strings may remain."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    words = _WORD[np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]]
    return pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), pa.py_buffer(words)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(record key, tokens or lower-cased text) -> (record key, _n, words, counts), some
    hundred records at a time."""
    for part in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
        *keys, tokens = part.columns
        raw = not pa.types.is_list(tokens.type)
        if raw:
            tokens = _split(tokens)
        size = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = tokens.flatten().dictionary_encode()
        of, word = np.repeat(np.arange(len(size)), size), coded.indices.to_numpy()
        if raw:
            kept = ~np.isin(coded.dictionary.to_numpy(zero_copy_only=False), ["", *STOPWORDS])[word]
            of, word = of[kept], word[kept]
            size = np.bincount(of, minlength=len(size))
        live = pa.array(size > 0)
        n_words = max(1, len(coded.dictionary))
        pair, count = np.unique(of * n_words + word, return_counts=True)
        of, word = np.divmod(pair, n_words)
        per = np.bincount(of, minlength=len(size))
        words = pc.binary_join(_lists(per, coded.dictionary.take(pa.array(word))), SEPARATOR)
        counts = _lists(per, pa.array(count, pa.int32()))
        yield pa.RecordBatch.from_arrays([c.filter(live) for c in (*keys, pa.array(size), words, counts)],
                                         names=[*part.schema.names[:-1], "_n", "words", "counts"])


def term_counts(rt: DataFrame) -> DataFrame:
    """(record key, _n, words, counts): each record's different tokens, joined, and how
    often each occurs among its ``_n``.  A record is counted where it is read; records
    without tokens have no row.  ``rt`` holds ``tokens``, or the ``text`` that
    ``record_tokens`` would split."""
    keys = _keys(rt)
    schema = ", ".join(f"`{k}` {rt.schema[k].dataType.simpleString()}" for k in keys)
    last = F.col("tokens") if "tokens" in rt.columns else F.lower("text")
    return rt.select(*keys, last).mapInArrow(_counted, f"{schema}, _n long, words string, counts array<int>")


def _terms(counted: DataFrame, keys: list[str]) -> DataFrame:
    # an inner explode would make Spark filter on the size of the split, and split twice
    return counted.select(*keys, "_n", "counts", F.posexplode_outer(F.split("words", SEPARATOR)).alias("_at", "token")) \
                  .select(*keys, "_n", "token", F.get("counts", F.col("_at")).cast("long").alias("count"))


def repeated_keys(rt: DataFrame) -> DataFrame:
    """The record keys that come again in ``rt``, written once."""
    return cut_lineage(rt.groupBy(*_keys(rt)).count().where(F.col("count") > 1).drop("count"))


def tf(rt: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """(rec_id, token, tf): occurrences of the token / tokens in the record.
    A ``source`` column, when present, is kept as part of the record key.

    ``rt`` holds tokens, texts or their ``term_counts``, which may have each record's
    ``norm``.  Only records whose key and number of tokens come again are added up by
    a shuffle; ``again`` are their ``repeated_keys``, if known."""
    keys = _keys(rt)
    kept = [*keys, *(c for c in ("norm",) if c in rt.columns)]
    ids = repeated_keys(rt) if again is None else again
    pack = (lambda r: r) if "words" in rt.columns else term_counts
    if ids.isEmpty():
        terms = _terms(pack(rt), kept)
    else:
        ids = broadcast_pinned(ids.select(*[F.col(k).alias(f"_again_{k}") for k in keys]))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_again_{k}")) for k in keys))
        come = _terms(pack(rt.join(ids, same, "left_semi")), kept)
        terms = _terms(pack(rt.join(ids, same, "left_anti")), kept).unionByName(
            come.groupBy(*kept, "_n", "token").agg(F.sum("count").alias("count")))
    return terms.select(*kept, "token", (F.col("count") / F.col("_n")).alias("tf"))


def corpus_union(rt_a: DataFrame, rt_b: DataFrame) -> DataFrame:
    """Both catalogues as one corpus, tagged ``A`` / ``B``."""
    return (rt_a.withColumn("source", F.lit("A"))
                .unionByName(rt_b.withColumn("source", F.lit("B"))))


def idf_from_tf(tf_df: DataFrame, n_records: int) -> DataFrame:
    """(token, idf = N / n(t), df): the TF table has one row per (record, token),
    so n(t) is its row count per token — no second pass over the text.  With a
    ``source`` column there, also ``shared``: whether both catalogues have the token."""
    aggs = [F.count(F.lit(1)).alias("count")]
    if "source" in tf_df.columns:
        aggs.append((F.max(F.col("source") == "A") & F.max(F.col("source") == "B")).alias("shared"))
    per = tf_df.groupBy("token").agg(*aggs)
    return per.select("token", (F.lit(float(n_records)) / F.col("count")).alias("idf"),
                      F.col("count").alias("df"), *per.columns[2:])


def idf(corpus: DataFrame) -> DataFrame:
    """(token, idf) with idf = N / n(t) — records in the corpus over records
    containing the token (no logarithm).  ``corpus`` has (source, rec_id, tokens)."""
    return idf_from_tf(tf(corpus), corpus.count())


def _level():
    return F.floor(F.log2("idf"))


def _commonest(idf_df: DataFrame, max_bytes: int) -> tuple[bool, int | None]:
    """Whether the vocabulary fits ``max_bytes``, and the ``_level`` up to which it does (None: no level)."""
    width = 16 * len(idf_df.columns) + F.octet_length("token")
    cut, used = None, 0
    for r in sorted(idf_df.groupBy(_level().alias("level")).agg(F.sum(width.cast("long")).alias("bytes")).collect()):
        used += r["bytes"]
        if used > max_bytes:
            break
        cut = r["level"]
    return used <= max_bytes, cut


def with_idf(rows: DataFrame, idf_df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``rows`` joined by token with ``idf_df``, which is written once.  Of a vocabulary
    over ``max_bytes`` the commonest tokens, which most rows have, are broadcast as far
    as they fit; only rows of the others are shuffled."""
    idf_df = cut_lineage(idf_df)
    fits, cut = _commonest(idf_df, max_bytes)
    if fits:
        return rows.join(F.broadcast(idf_df), "token")
    if cut is None:
        return rows.join(idf_df, "token")
    common = F.broadcast(idf_df.where(_level() <= cut))
    rare = rows.join(common.select("token"), "token", "left_anti")
    return rows.join(common, "token").unionByName(rare.join(idf_df.where(_level() > cut).hint("shuffle_hash"), "token"))


def tfidf(tf_df: DataFrame, idf_df: DataFrame) -> DataFrame:
    """(rec_id, token, w = tf * idf).  Tokens missing from ``idf_df`` drop out; its
    ``shared`` column, when present, is kept."""
    also = [c for c in ("shared",) if c in idf_df.columns]
    return with_idf(tf_df, idf_df).select(*_keys(tf_df), "token", (F.col("tf") * F.col("idf")).alias("w"), *also)


def norms(weights: DataFrame) -> DataFrame:
    keys = _keys(weights)
    return weights.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def lengths(tf_df: DataFrame, idf_df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """(record key, norm, shared): the length of each record's weights, and that of those
    on tokens which both catalogues have.  With a ``weight`` of tokens in ``idf_df`` also
    ``dot``: the product of the record's weights and these.

    One pass over ``tf_df``: the squares of tokens commoner than ``max_bytes`` allow to
    broadcast are added up by record where they are read; of the others only the rows
    (one a record and token) go on to a join with their part of ``idf_df``."""
    keys = _keys(tf_df)
    idf_df = idf_df.drop("df")  # more tokens fit without it
    fits, cut = _commonest(idf_df, max_bytes)
    names = ["_all", "_shared", *(["dot"] if "weight" in idf_df.columns else [])]

    def parts(w, square):
        shared = F.when(F.col("shared"), square).otherwise(F.lit(0.0))
        return [c.alias(n) for n, c in zip(names, (square, shared, w * F.col("weight") if "dot" in names else None))]

    def sums(parts):
        return [F.sum(c).alias(n) for n, c in zip(names, parts)]

    w = F.col("tf") * F.col("idf")
    if fits or cut is None:
        known = tf_df.join(F.broadcast(idf_df) if fits else idf_df, "token").groupBy(*keys).agg(*sums(parts(w, w * w)))
    else:
        met = tf_df.join(F.broadcast(idf_df.where(_level() <= cut)), "token", "left")
        added = cut_lineage(met.groupBy(*keys, F.when(F.col("idf").isNull(), F.col("token")).alias("token")).agg(
            *sums(parts(w, w * w)), F.sum(F.col("tf") * F.col("tf")).alias("_tf2"),
            *([F.sum("tf").alias("_tf")] if "dot" in names else [])))
        rare = added.where(F.col("token").isNotNull()).drop(*names).join(idf_df.where(_level() > cut), "token")
        rare = rare.select(*keys, *parts(F.col("_tf") * F.col("idf"), F.col("_tf2") * F.col("idf") * F.col("idf")))
        known = added.where(F.col("token").isNull()).select(*keys, *names).unionByName(rare)
        known = known.groupBy(*keys).agg(*sums(names))
    return known.select(*keys, F.sqrt("_all").alias("norm"), F.sqrt("_shared").alias("shared"), *names[2:])


def inverted_index(weights: DataFrame) -> DataFrame:
    """(token, rec_id) — the long weight table read by token."""
    return weights.select("token", "rec_id")


def token_pairs(a: DataFrame, b: DataFrame, per_part: int = 10_000) -> DataFrame:
    """(token, id_a, id_b, other columns of both sides): a row for each token that a pair of
    records shares, for every pair.

    ``a`` is broadcast while it is small.  Else both sides are shuffled by token, and the
    records of a token with over ``per_part`` of them in ``b`` are split among parts by a
    hash, which the other side visits."""
    a, b = a.withColumnRenamed("rec_id", "id_a"), b.withColumnRenamed("rec_id", "id_b")
    a = cut_lineage(a.where(F.col("id_a").isNotNull()))
    b = b.where(F.col("id_b").isNotNull())
    small = broadcast_pinned(a)
    if small is not a:
        return b.join(small, "token")
    b = cut_lineage(b)
    common = F.broadcast(cut_lineage(b.groupBy("token").count().where(F.col("count") > per_part).select(
        "token", F.ceil(F.col("count") / F.lit(float(per_part))).cast("int").alias("parts"))))
    parts = F.coalesce("parts", F.lit(1))
    a = a.join(common, "token", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    b = b.join(common, "token", "left").withColumn("part", F.pmod(F.hash("id_b"), parts)).drop("parts")
    return b.join(a, ["token", "part"])


def tokens_of_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """(id_a, id_b, n_common, tokens): number and sorted list of the tokens that two records
    share, for every pair that shares one.  ``a`` and ``b`` are inverted indices."""
    return token_pairs(a, b).groupBy("id_a", "id_b").agg(
        F.count(F.lit(1)).alias("n_common"), F.array_sort(F.collect_list("token")).alias("tokens"))


def cosine_inverted(ua: DataFrame, ub: DataFrame) -> DataFrame:
    """(id_a, id_b, sim) of every pair of unit vectors that shares a token."""
    pairs = token_pairs(ua.withColumnRenamed("u", "u_a"), ub.withColumnRenamed("u", "u_b"))
    return pairs.groupBy("id_a", "id_b").agg(F.sum(F.col("u_a") * F.col("u_b")).alias("sim"))


def common_tokens(pairs: DataFrame, a: DataFrame, b: DataFrame, least: float | None = None) -> DataFrame:
    """(id_a, id_b, n_common, tokens): number and sorted list of the tokens that each given
    pair shares.  With ``least``, ``a`` and ``b`` are unit vectors and only pairs of at
    least that similarity remain: ``candidates`` are verified and listed in one pass."""
    also = [F.count(F.lit(1)).alias("n_common"), F.array_sort(F.collect_list("token")).alias("tokens")]
    if least is not None:
        return _sims(pairs, a, b, *also).where(F.col("sim") >= least).drop("sim")
    return _shared(pairs, a.select("rec_id", "token"), b.select("rec_id", "token")).groupBy("id_a", "id_b").agg(*also)


def _shared(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """The tokens that the records of each pair share, with other columns of both sides."""
    a = a.withColumnRenamed("rec_id", "id_a")
    b = b.withColumnRenamed("rec_id", "id_b")
    return pairs.select("id_a", "id_b").join(a, "id_a").join(b, ["id_b", "token"])


def normalized(weights: DataFrame) -> DataFrame:
    """(record key, token, u = w / norm): unit-length weight vectors."""
    keys = _keys(weights)
    return weights.join(norms(weights), keys).select(*keys, "token", (F.col("w") / F.col("norm")).alias("u"))


def units(counted: DataFrame, idf_df: DataFrame, norm: DataFrame, again: DataFrame) -> DataFrame:
    """(record key, token, u = tf * idf / norm) of the records in ``norm``, on the tokens of
    ``idf_df``.  ``counted`` are ``term_counts``: records are joined before they are
    unpacked, so that only those wanted are, and no token row is shuffled for its norm."""
    keys = _keys(counted)
    rows = with_idf(tf(counted.join(broadcast_pinned(norm.select(*keys, "norm")), keys), again), idf_df)
    return rows.select(*keys, "token", (F.col("tf") * F.col("idf") / F.col("norm")).alias("u"))


def of_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of both catalogues whose records are in ``pairs`` (id_a, id_b)."""
    ids = pairs.select(F.lit("A").alias("source"), F.col("id_a").alias("rec_id")).unionByName(
        pairs.select(F.lit("B").alias("source"), F.col("id_b").alias("rec_id"))).distinct()
    return df.join(broadcast_pinned(cut_lineage(ids)), ["source", "rec_id"], "left_semi")


def prefixes(unit: DataFrame, idf_df: DataFrame, least: float = LEAST_SIM) -> DataFrame:
    """(rec_id, token, df, u, tail, out) of the rarest tokens of each record, without the
    commonest ones whose weights together are shorter than ``least``; tail is the length
    of the record's weights on tokens commoner than this one, out on those left out."""
    commonest = Window.partitionBy("rec_id").orderBy(F.desc("df"), "token")
    record = Window.partitionBy("rec_id")
    ranked = unit.join(idf_df.select("token", "df"), "token").withColumn(
        "_rest", F.sqrt(F.sum(F.col("u") * F.col("u")).over(commonest)))
    kept = F.col("_rest") >= least * (1 - 1e-9)
    ranked = ranked.withColumn("tail", F.coalesce(F.lag("_rest").over(commonest), F.lit(0.0))).withColumn(
        "out", F.coalesce(F.max(F.when(~kept, F.col("_rest"))).over(record), F.lit(0.0)))
    return ranked.where(kept).select("rec_id", "token", "df", "u", "tail", "out")


def candidates(ua: DataFrame, ub: DataFrame, idf_df: DataFrame, least: float = LEAST_SIM,
               per_part: int = 10_000) -> DataFrame:
    """(id_a, id_b) that may have sim >= ``least``: all that do, and few others.

    Prefixes are joined by token, and the products of a pair's common prefix tokens are
    added up.  Any other token that both records have is commoner than each of these,
    and outside one of the prefixes; so what is missing is at most the product of the
    shortest tails, and at most out_a * tail_b + tail_a * out_b.  Pairs that stay below
    ``least`` with that are dropped in the same aggregate.  The records of a token with
    a df over ``per_part`` are split among parts by a hash, which the other side visits."""
    parts = F.ceil(F.col("df") / F.lit(float(per_part))).cast("int")
    a = prefixes(ua, idf_df, least).select(
        F.col("rec_id").alias("id_a"), "token", F.col("u").alias("u_a"), F.col("tail").alias("t_a"),
        F.col("out").alias("o_a"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    b = prefixes(ub, idf_df, least).select(
        F.col("rec_id").alias("id_b"), "token", F.col("u").alias("u_b"), F.col("tail").alias("t_b"),
        F.col("out").alias("o_b"), F.pmod(F.hash("rec_id"), parts).alias("part"))
    met = a.join(b, ["token", "part"]).groupBy("id_a", "id_b").agg(
        F.sum(F.col("u_a") * F.col("u_b")).alias("p"), F.min("t_a").alias("t_a"), F.min("t_b").alias("t_b"),
        F.min("o_a").alias("o_a"), F.min("o_b").alias("o_b"))
    missing = F.least(F.col("t_a") * F.col("t_b"), F.col("o_a") * F.col("t_b") + F.col("t_a") * F.col("o_b"))
    return met.where(F.col("p") + missing >= least * (1 - 1e-9)).select("id_a", "id_b")


def similar_pairs(ua: DataFrame, ub: DataFrame, idf_df: DataFrame, least: float = LEAST_SIM) -> DataFrame:
    """(id_a, id_b, sim) for every pair of unit vectors with sim >= ``least``.

    If no token is in both prefixes, every shared token lies in what one of the
    prefixes leaves out, so the product is below ``least``.  Frequent tokens fall
    out of the prefixes by their weight; candidates are summed over all tokens."""
    return _sims(candidates(ua, ub, idf_df, least), ua, ub).where(F.col("sim") >= least)


def _sims(pairs: DataFrame, ua: DataFrame, ub: DataFrame, *also) -> DataFrame:
    a = ua.withColumnRenamed("u", "u_a")
    b = ub.withColumnRenamed("u", "u_b")
    return _shared(pairs, a, b).groupBy("id_a", "id_b").agg(F.sum(F.col("u_a") * F.col("u_b")).alias("sim"), *also)


def cosine_of_pairs(pairs: DataFrame, ua: DataFrame, ub: DataFrame) -> DataFrame:
    """Cosine of given (id_a, id_b) pairs (0 when they share no token); only the records
    in them are read on."""
    pairs = cut_lineage(pairs)
    of = lambda u, name: u.join(broadcast_pinned(cut_lineage(
        pairs.select(F.col(name).alias("rec_id")).distinct())), "rec_id", "left_semi")
    ua, ub = of(ua, "id_a"), of(ub, "id_b")
    return (pairs.join(_sims(pairs, ua, ub), ["id_a", "id_b"], "left")
                 .select("id_a", "id_b", F.coalesce("sim", F.lit(0.0)).alias("sim")))


def weighed(idf_df: DataFrame, unit: DataFrame) -> DataFrame:
    """``idf_df`` with the ``weight`` of each token: its sum over the vectors in ``unit``."""
    sums = broadcast_pinned(cut_lineage(unit.groupBy("token").agg(F.sum("u").alias("weight"))))
    return cut_lineage(idf_df.join(sums, "token", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0))))


def similarity_total(ua: DataFrame, ub: DataFrame) -> DataFrame:
    """(total): the sum of the similarities of all pairs, token by token, or record by
    record if ``ub`` holds ``lengths`` with their ``dot`` by an ``idf_df`` that was
    ``weighed`` with ``ua``: then no vector of ``ub`` is unpacked."""
    if "dot" in ub.columns:
        known = ub.where(F.col("rec_id").isNotNull())
        return known.agg(F.coalesce(F.sum(F.col("dot") / F.col("norm")), F.lit(0.0)).alias("total"))
    a = ua.groupBy("token").agg(F.sum("u").alias("s_a"))
    b = ub.groupBy("token").agg(F.sum("u").alias("s_b"))
    return a.join(b, "token").agg(F.coalesce(F.sum(F.col("s_a") * F.col("s_b")), F.lit(0.0)).alias("total"))


def gold_eval(gold_sims: DataFrame, total: float, n_pairs: int) -> DataFrame:
    """Number and mean similarity of the gold pairs and of all ``n_pairs`` others."""
    g = gold_sims.agg(F.count(F.lit(1)).alias("true_pairs"), F.avg("sim").alias("avg_sim_true"),
                      F.coalesce(F.sum("sim"), F.lit(0.0)).alias("_s"))
    others = F.lit(n_pairs) - F.col("true_pairs")
    return g.select("true_pairs", "avg_sim_true", others.cast("long").alias("other_pairs"),
                    ((F.lit(total) - F.col("_s")) / others).alias("avg_sim_other"))


def _first_threshold_above(sim):
    """Smallest n with sim < n/100 (the exact double comparison the sweep uses)."""
    b = (sim * N_THRESHOLDS).cast("int")
    return (F.when(sim < b / F.lit(float(N_THRESHOLDS)), b)
             .when(sim < (b + 1) / F.lit(float(N_THRESHOLDS)), b + 1)
             .otherwise(b + 2))


def threshold_counts(sims: DataFrame, gold_sims: DataFrame, n_pairs: int) -> DataFrame:
    """(threshold_bin n, threshold n/100, tp, fp, fn) for n = 0..99.

    fp(n): pairs that are not gold whose bin int(sim*100) >= n (suffix sum; for
    n = 0 all of them, ``n_pairs`` less the gold ones, and for n > 0 those of
    ``sims``, the pairs of at least one step); fn(n): gold pairs with sim < n/100
    (prefix sum); tp = gold - fn.  The running sums run over a table of 103 bins."""
    spark = sims.sparkSession
    others = sims.join(gold_sims.select("id_a", "id_b"), ["id_a", "id_b"], "left_anti")
    fp = others.groupBy((F.col("sim") * N_THRESHOLDS).cast("int").alias("n")).agg(
        F.count(F.lit(1)).alias("fp_bin"), F.lit(0).cast("long").alias("fn_bin"))
    fn = gold_sims.groupBy(_first_threshold_above(F.col("sim")).alias("n")).agg(
        F.lit(0).cast("long").alias("fp_bin"), F.count(F.lit(1)).alias("fn_bin"))
    spine = spark.range(0, N_THRESHOLDS + 3).select(
        F.col("id").cast("int").alias("n"), F.lit(0).cast("long").alias("fp_bin"), F.lit(0).cast("long").alias("fn_bin"))
    t = spine.unionByName(fp).unionByName(fn).groupBy("n").agg(F.sum("fp_bin").alias("fp_bin"),
                                                               F.sum("fn_bin").alias("fn_bin"))
    suffix = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(0))
    t = (t.withColumn("fp", F.sum("fp_bin").over(suffix))
          .withColumn("fn", F.sum("fn_bin").over(prefix))
          .withColumn("n_gold", F.sum("fn_bin").over(everything)))
    t = t.where((F.col("n") >= 0) & (F.col("n") < N_THRESHOLDS))
    fp_all = F.when(F.col("n") == 0, F.lit(n_pairs) - F.col("n_gold")).otherwise(F.col("fp"))
    return t.select(F.col("n").alias("threshold_bin"),
                    (F.col("n") / F.lit(float(N_THRESHOLDS))).alias("threshold"),
                    (F.col("n_gold") - F.col("fn")).cast("long").alias("tp"),
                    fp_all.cast("long").alias("fp"),
                    F.col("fn").cast("long").alias("fn"))


def pr_curve(counts: DataFrame) -> DataFrame:
    """Precision, recall and F-measure per threshold (0 where undefined)."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    out = counts.select("threshold_bin", "threshold", p.alias("precision"), r.alias("recall"))
    f = F.when(F.col("precision") + F.col("recall") > 0,
               2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))) \
         .otherwise(F.lit(0.0))
    return out.withColumn("f_measure", f)
