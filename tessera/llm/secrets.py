"""Secrets in texts, with weak candidates linked to the other parts of a credential.

Strong findings stand alone: assignments to a password or token, access key
ids, long hexadecimal runs.  Weak ones (names of identities, endpoints, random
looking strings) are reported only when the parts that complete a credential
lie within ``scope`` characters: an interval join of each weak part with the
parts of its text, by blocks of ``scope`` characters.  Spark SQL only.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pin


@dataclass(frozen=True)
class Kind:
    """pattern: Java regular expression; group: the part that must have ``least``
    characters; role: identity, secret or endpoint; strong: reported alone."""

    name: str
    role: str
    pattern: str
    least: int = 1
    group: int = 0
    strong: bool = False


KINDS = (
    Kind("assign", "secret", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
         r"([A-Za-z0-9+/_.=-]+)", 6, 2, True),
    Kind("access", "identity", r"AKIA[A-Z0-9]+", 20, strong=True),
    Kind("hex", "secret", r"[0-9a-f]{24,}", 24, strong=True),  # whole runs, as [0-9a-f]+ has them
    Kind("identity", "identity", r"""((?i:client_?id|access_?key_?id|key_?id|app_?id|account|user_?name|user|login))"""
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]+)""", 4, 2),
    Kind("endpoint", "endpoint", r"(?i:https?|ftp|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\x00-\x20\"'<>]+",
         10),
    Kind("random", "secret", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])"
         r"(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}", 20),
)


def _lengths(text: Column, kind: Kind) -> Column:
    """For each match: the characters between it and the one before, its own,
    and those of the group that is measured."""
    pattern = F.lit(kind.pattern)
    gaps = F.transform(F.split(text, kind.pattern), F.char_length)
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    group = F.transform(F.regexp_extract_all(text, pattern, F.lit(kind.group)), F.char_length) if kind.group else found
    return F.when(text.rlike(kind.pattern), F.arrays_zip(
        F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("own"), group.alias("group")))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 200,
                 kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, an array of (start, rank,
    kind, end) by start, then by the order of ``kinds``; positions count code
    points, ends are exclusive.

    Matches of a kind are leftmost and do not overlap; those too short are
    dropped.  Weak matches that overlap a strong one are dropped; others stay if
    complete within ``scope`` characters: an identity needs a secret, a secret an
    identity or an endpoint, an endpoint both others.  Null and empty texts have
    none; repeated rows each give a row; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [k.name for k in kinds]
    # what the texts hold, without the texts; rows get numbers that stay
    found = pin(docs.select(F.col(id_col).alias("id"), *[_lengths(text, k).alias(k.name) for k in kinds])
                .withColumn("row", F.monotonically_increasing_id()), "found")
    spans = []
    for rank, k in enumerate(kinds):
        e = found.where(F.col(k.name).isNotNull()).select("row", F.posexplode(k.name).alias("at", "m")).select(
            "row", F.lit(rank).alias("rank"), "at", F.col("m.gap").alias("gap"), F.col("m.own").alias("own"),
            (F.col("m.group") >= k.least).alias("ok"))
        spans.append(e)
    every = spans[0]
    for e in spans[1:]:
        every = every.union(e)
    before = Window.partitionBy("row", "rank").orderBy("at")
    end = F.sum(F.col("gap") + F.col("own")).over(before)
    every = every.withColumn("end", end).where("ok").select(
        "row", "rank", (F.col("end") - F.col("own")).alias("start"), "end")
    every = pin(every, "parts")
    role = {r: F.col("o.rank").isin([i for i, k in enumerate(kinds) if k.role == r])
            for r in ("identity", "secret", "endpoint")}
    strong = [i for i, k in enumerate(kinds) if k.strong]
    weak = every.where(~F.col("rank").isin(strong))
    w = weak.withColumn("block", F.explode(F.sequence(
        F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))))
    o = every.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))))
    near = w.alias("w").join(o.alias("o"), (F.col("w.row") == F.col("o.row")) & (F.col("w.block") == F.col("o.block"))
                             & (F.col("o.start") <= F.col("w.end") + scope) & (F.col("o.end") >= F.col("w.start") - scope))
    over = F.col("o.rank").isin(strong) & (F.col("o.start") < F.col("w.end")) & (F.col("o.end") > F.col("w.start"))
    linked = near.groupBy("w.row", "w.rank", "w.start", "w.end").agg(
        F.max(over).alias("over"), *[F.max(c).alias(r) for r, c in role.items()])
    is_ = {r: F.col("rank").isin([i for i, k in enumerate(kinds) if k.role == r]) for r in role}
    whole = (F.when(is_["identity"], F.col("secret")).when(is_["secret"], F.col("identity") | F.col("endpoint"))
             .otherwise(F.col("identity") & F.col("secret")))
    kept = every.where(F.col("rank").isin(strong)).union(
        linked.where(~F.col("over") & whole).select("row", "rank", "start", "end"))
    kind = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("rank") + 1)
    per_row = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        F.col("start").cast("long").alias("start"), "rank", kind.alias("kind"),
        F.col("end").cast("long").alias("end")))).alias("spans"))
    out = found.select("row", "id").join(per_row, "row", "left")
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return out.select(F.col("id").alias(id_col), F.coalesce("spans", empty).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digest(spans: Column) -> Column:
    return F.sha2(span_text(spans), 256)


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
