"""Personal data: patterns, and terms that disclose what the patterns protect.

Emails, addresses, card and phone numbers are found by pattern; each different
value is a protected entity.  Terms in documents that mention an entity may give
it away even when it is masked.  How strongly is estimated from the corpus: with
n(e) documents that mention e, n(t) that hold t, n(e, t) that do both, and N in
all, the pointwise mutual information log(N n(e, t) / (n(e) n(t))) is the part of
e's information content log(N / n(e)) that t discloses, or 1 + log p / log(N / n(e))
with p = n(e, t) / n(t).  As p is seen in few documents, its lower confidence bound
(Wilson's, at ``z`` standard errors) stands for it, so rare entities count too and
need no least number of documents.  Only different contexts (the words around the
mentions and the term) are evidence, so copies of one passage are worth one.
Wherever it stands in a document that mentions e, a term that discloses
``general`` of it or more is generalised to a placeholder, one that discloses
``remove`` or more is removed.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .common import fresh, pin

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
# Terms: three letters or digits, two of scripts without spaces; with underscores also whole.
TERM = re.compile(r"[^\W_]{3,}|[\u3005-\u3007\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7a3\uf900-\ufaff\U00020000-\U0003ffff]{2}")
JOINED = re.compile(r"(?<![^\W_])[^\W_]++(?:_++[^\W_]++)+")

SPAN = "struct<rank:int,start:int,end:int>"
FOUND = f"struct<base:array<{SPAN}>,mentions:array<struct<entity:bigint,context:bigint>>>"
MASKED = "array<struct<start:int,end:int,part:double>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(rank of the kind, start, end) by kind, then start."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:  # the local part is the run before the sign, up to the match before
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def number(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(),
                          "little", signed=True)


def all_terms(text: str) -> set[str]:
    found = set(TERM.findall(text))
    if "_" in text:
        found.update(JOINED.findall(text))
    return {w.lower() for w in found}


def term_places(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, term) of all terms that overlap none of the spans; of those
    that start together the longest comes first."""
    out = [(m.start(), m.end(), m[0].lower()) for m in TERM.finditer(text)]
    if "_" in text:
        out += [(m.start(), m.end(), m[0].lower()) for m in JOINED.finditer(text)]
        out.sort(key=lambda m: (m[0], -m[1]))
    cover, clear = [], []
    for a, b in sorted((a, b) for _, a, b in spans):
        if cover and a < cover[-1][1]:
            cover[-1][1] = max(b, cover[-1][1])
        else:
            cover.append([a, b])
    at = 0
    for m in out:
        while at < len(cover) and cover[at][1] <= m[0]:
            at += 1
        if at == len(cover) or cover[at][0] >= m[1]:
            clear.append(m)
    return clear


class Contexts:
    """Hashes of the terms within ``window`` characters of a place."""

    def __init__(self, places: list[tuple[int, int, str]], window: int):
        self.places, self.window = places, window
        self.starts = [a for a, _, _ in places]

    def of(self, start: int, end: int) -> int:
        lo, hi = (bisect_left(self.starts, x) for x in (start - self.window, end + self.window))
        return number(" ".join(t for _, b, t in self.places[lo:hi] if b <= end + self.window))


def mentions(text: str, spans: list[tuple[int, int, int]], window: int) -> list[dict]:
    """Each entity of the spans with one hash of all its contexts; an entity is
    its kind and its letters and digits, kept as a hash only."""
    contexts, out = Contexts(term_places(text, spans), window), {}
    for rank, start, end in spans:
        entity = number(KINDS[rank], re.sub(r"[^\w@]", "", text[start:end].lower()))
        out.setdefault(entity, set()).add(contexts.of(start, end))
    return [{"entity": e, "context": number(*map(str, sorted(c)))} for e, c in out.items()]


def _scan(window: int):
    @arrow_udf(FOUND)
    def scan(col: pa.Array) -> pa.Array:
        rows = []
        for t in col:
            t = t.as_py() or ""
            spans = base_spans(t)
            rows.append({"base": [{"rank": k, "start": a, "end": b} for k, a, b in spans],
                         "mentions": mentions(t, spans, window) if spans else []})
        return pa.array(rows, pa.struct([
            ("base", pa.list_(pa.struct([("rank", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))),
            ("mentions", pa.list_(pa.struct([("entity", pa.int64()), ("context", pa.int64())])))]))

    return scan


def _terms(window: int, common: Broadcast):
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, term, context) of every different term of each (row, text, need) but
        the ``common`` ones that stand in more than ``need`` documents."""
        often = common.value
        for batch in batches:
            for row, text, need in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py()
                places = term_places(text, base_spans(text))
                contexts, first = Contexts(places, window), {}
                for a, b, t in places:
                    if t not in first and often.get(t, 0) <= need:
                        first[t] = (a, b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(first), pa.int64()), pa.array(list(first), pa.string()),
                     pa.array([contexts.of(a, b) for a, b in first.values()], pa.int64())], ["row", "term", "context"])

    return terms


def _masked():
    @arrow_udf(MASKED)
    def masked(texts: pa.Array, told: pa.Array) -> pa.Array:
        """Where the terms of (term, part) stand in each text, longest ones only."""
        rows = []
        for text, told_here in zip(texts, told):
            text, parts, out = text.as_py(), {x["term"]: x["part"] for x in told_here.as_py() or []}, []
            for a, b, t in term_places(text, base_spans(text)) if text and parts else []:
                if t not in parts:
                    continue
                if out and a < out[-1]["end"]:
                    out[-1]["part"] = max(out[-1]["part"], parts[t])
                else:
                    out.append({"start": a, "end": b, "part": parts[t]})
            rows.append(out)
        return pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("part", pa.float64())])))

    return masked


def document_frequencies(docs: DataFrame, terms: DataFrame | None, text_col: str, most: int = 100_000) -> DataFrame:
    """(term, n_t): in how many documents each term of ``terms`` (None: any) stands.

    Up to ``most`` terms travel to the tasks; beyond, all terms are counted and
    joined.  Tasks sum up before the shuffle, in counters of bounded size.
    """
    few = terms is not None and terms.count() <= most
    wanted = frozenset(r[0] for r in terms.limit(most).collect()) if few else None  # a few MB at most
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only, n = shared.value, Counter()

        def full():
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())],
                                              ["term", "n"])

        for batch in batches:
            for t in batch.column(0):
                words = all_terms(t.as_py() or "")
                n.update(words if only is None else words & only)
                if len(n) > 200_000:
                    yield full()
                    n.clear()
        yield full()

    out = docs.select(text_col).mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_t"))
    return out if few or terms is None else out.join(terms, "term", "left_semi")


def join_dealt(rows: DataFrame, each: DataFrame, key: str, weight: str, most: int = 10_000) -> DataFrame:
    """``rows`` (with a column ``row``) joined with ``each``, which has one row a
    ``key`` and says in ``weight`` how many of ``rows`` bear it: a key of over
    ``most`` rows is dealt to several tasks."""
    parts = F.ceil(F.col(weight) / most).cast("int")
    heavy = each.where(F.col(weight) > most).select(key, parts.alias("parts"))
    few = F.broadcast if heavy.count() <= 100_000 else (lambda d: d)  # 40 bytes a row when broadcast
    rows = rows.join(few(heavy), key, "left").withColumn(
        "deal", F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    each = each.withColumn("deal", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return rows.join(each, [key, "deal"]).drop("deal")


def most_common(n_t: DataFrame, most: int = 100_000) -> dict[str, int]:
    """The terms that make up more than a ``most``-th of all (document, term) pairs
    each, so fewer than ``most``; the longest words are left to the join."""
    total = n_t.agg(F.sum("n_t")).first()[0] or 0
    top = n_t.where((F.col("n_t") > total / most) & (F.octet_length("term") <= 64)).toArrow()
    return dict(zip(top.column("term").to_pylist(), top.column("n_t").to_pylist()))


def told_part(n: float, n_e: Column, n_t: Column, n_et: Column, contexts: Column, z: float) -> Column:
    """The part of an entity's information that a term discloses, by the lower
    bound of p = n(e, t) / n(t) seen in ``contexts`` / p independent documents."""
    p = F.least(F.lit(1.0), n_et / n_t)
    m = contexts / p
    low = (p + z * z / (2 * m) - z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    return 1 + F.log(low) / F.log(F.lit(n) / n_e)


def disclosures(docs: DataFrame, found: DataFrame, text_col: str, window: int, general: float,
                z: float) -> DataFrame:
    """(row, hash, w, told): for each different text with entities one of its rows,
    how many rows bear it, and its terms that disclose ``general`` of an entity or
    more, with the largest part.

    Documents of equal text are one class.  Entities of one text alone are alike
    for every term, so each text has one for all of them.  Entities and terms of a
    text meet in blocks of entities and slices of terms, and only where even
    n(e, t) = n(e) in as many contexts as e has texts would disclose enough, so
    n(t) is at most ``need`` = N ** (1 - general) * n(e) ** general.
    """
    n = float(found.count())
    each = found.select("row", "hash", F.explode("mentions").alias("x")).select("row", "hash", "x.entity", "x.context")
    classes = pin(each.groupBy("entity", "hash").agg(F.min("row").alias("row"), F.min("context").alias("near"),
                                                     F.count("*").alias("w")), "classes")
    n_e = pin(classes.groupBy("entity").agg(F.sum("w").alias("n_e"), F.count("*").alias("texts")), "entities")
    alone = F.col("texts") == 1
    classes = join_dealt(classes, n_e, "entity", "texts").where(F.col("n_e") < n).select(
        F.when(alone, F.xxhash64("row", F.lit("alone"))).otherwise(F.col("entity")).alias("entity"),
        "row", "hash", F.when(alone, F.lit(0)).otherwise(F.col("near")).alias("near"), "w", "n_e", "texts")
    classes = pin(classes.distinct(), "mentions")
    by_row = classes.groupBy("row").agg(
        F.first("hash").alias("hash"), F.first("w").alias("w"), F.ceil(F.count("*") / 256).cast("int").alias("blocks"),
        F.max(F.pow(F.lit(n), 1 - general) * F.pow("n_e", F.lit(general)) * (1 + 1e-9)).alias("need"))
    texts = found.where(F.size("mentions") > 0).select("row", "text").join(by_row, "row").withColumn(
        "slices", F.ceil((F.length("text") + 1) / 100_000).cast("int"))
    texts = pin(texts, "texts")
    n_t = pin(document_frequencies(docs, None, text_col), "frequencies")
    common = docs.sparkSession.sparkContext.broadcast(most_common(n_t))
    held = texts.select("row", "text", "need").mapInArrow(
        _terms(window, common), "row long, term string, context long").join(n_t, "term")
    size = texts.select("row", "blocks", "slices")
    held = held.join(size, "row").withColumn("slice", F.pmod(F.xxhash64("term"), "slices").cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "slices")
    dealt = classes.join(size, "row").withColumn("block", F.pmod(F.xxhash64("entity"), "blocks").cast("int")).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("blocks", "slices", "hash")
    n_t, n_e, most = F.col("n_t"), F.col("n_e"), F.least("n_e", "n_t", "texts")
    pairs = held.join(dealt, ["row", "block", "slice"]).where(
        told_part(n, n_e, n_t, F.least(n_e, n_t), most, z) >= general - 1e-9)
    pairs = pin(pairs.select("row", "entity", "term", "near", "context", "w", "n_e", "n_t"), "pairs")
    by_context = pairs.groupBy("entity", "term", "near", "context").agg(
        F.sum("w").alias("n"), F.max("n_e").alias("n_e"), F.max("n_t").alias("n_t"))
    told = by_context.groupBy("entity", "term").agg(
        F.sum("n").alias("n_et"), F.count("*").alias("contexts"), F.max("n_e").alias("n_e"),
        F.max("n_t").alias("n_t"))
    told = told.select("entity", "term", told_part(
        n, n_e, F.greatest("n_t", "n_et"), F.col("n_et"), F.col("contexts"), z).alias("part")).where(
        F.col("part") >= general)
    terms = pairs.select("row", "entity", "term").join(told, ["entity", "term"]).groupBy("row", "term").agg(
        F.max("part").alias("part"))
    terms = terms.groupBy("row").agg(F.collect_list(F.struct("term", "part")).alias("told"))
    return texts.select("row", "hash", "w", "text").join(terms, "row")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 80,
             general: float = 0.8, z: float = 1.0) -> DataFrame:
    """One row per row of ``docs``: its id, ``hash`` (of the text), ``base`` (spans
    of patterns: rank of the kind, start, end; by rank, then start) and ``terms``
    (start, end, part: what the most disclosed entity of the row loses by the
    term; every place of the term in the text, by start).  Of different contexts
    the words within ``window`` characters tell.

    Positions count code points, ends are exclusive.  Null and empty texts have
    no spans.  Repeated rows each give a row and count as documents; an empty
    table gives no rows.  Other columns, whatever their names, play no part.
    Whole texts are searched, and the statistics are over all documents.  An
    entity that all documents mention has no information that a term could
    disclose.
    """
    found = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"),
                        F.col(text_col).alias("text"), _scan(window)(F.col(text_col)).alias("f"),
                        F.monotonically_increasing_id().alias("row"))
    found = pin(found.select("row", "id", "hash", "f.base", "f.mentions",
                             F.when(F.size("f.mentions") > 0, F.col("text")).alias("text")), "found")
    told = disclosures(docs, found, text_col, window, general, z)
    masked = pin(told.select("hash", "w", _masked()("text", "told").alias("terms")), "masks")
    some, none = F.size("mentions") > 0, F.array().cast(MASKED)
    # a text of many rows meets its mask in several tasks; texts without entities need none
    with_terms = join_dealt(found.where(some).select("row", "id", "hash", "base"), masked, "hash", "w")
    known = with_terms.select("row", "id", "hash", "base", "terms")
    heavy = masked.select("hash")
    few = F.broadcast if heavy.count() <= 100_000 else (lambda d: d)
    rest = found.where(some).join(few(heavy), "hash", "left_anti").union(
        found.where(~some).select("hash", *[c for c in found.columns if c != "hash"]))
    out = known.union(rest.select("row", "id", "hash", "base", none.alias("terms")))
    return out.select(F.col("id").alias(id_col), "hash", "base", "terms")


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with spans (start, end, what stands for them) replaced; of
    overlapping ones the first stands for all."""
    out, at = [], 0
    for start, end, instead in sorted(spans):
        if start < at:
            if end > at:
                at = end
            continue
        out += [text[at:start], instead]
        at = end
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 80,
             general: float = 0.8, remove: float = 0.95, z: float = 1.0) -> DataFrame:
    """``docs`` with [EMAIL], [IP], [CARD] and [PHONE] for what the patterns find,
    [TERM] for terms that disclose ``general`` of an entity of the text, and nothing
    for those that disclose ``remove``.  Other texts, and all other columns, stay."""
    i, h, t = fresh(docs, "i", "h", "t")
    spans = find_pii(docs, id_col, text_col, window, general, z).where(F.size("terms") > 0)
    spans = pin(spans.select(F.col(id_col).alias(i), F.col("hash").alias(h), F.col("terms").alias(t))
                .dropDuplicates([i, h]), "spans")
    size = spans.agg(F.count("*") * 80 + F.coalesce(F.sum(F.size(t)), F.lit(0)) * 32).first()[0]
    if size <= 32 << 20:
        spans = F.broadcast(spans)

    @arrow_udf("string")
    def clean(texts: pa.Array, terms: pa.Array) -> pa.Array:
        out = []
        for text, more in zip(texts, terms):
            text, more = text.as_py(), more.as_py() or []
            if text:
                found = [(a, b, f"[{KINDS[k].upper()}]") for k, a, b in base_spans(text)]
                found += [(m["start"], m["end"], "" if m["part"] >= remove else "[TERM]") for m in more]
                text = redact(text, found) if found else text
            out.append(text)
        return pa.array(out, pa.string())

    joined = docs.join(spans, F.col(id_col).eqNullSafe(F.col(i)) & (
        F.md5(F.coalesce(F.col(text_col), F.lit(""))) == F.col(h)), "left")
    return joined.select(*[clean(F.col(c), F.col(t)).alias(c) if c == text_col else F.col(c) for c in docs.columns])


def all_spans(base: Column, terms: Column) -> Column:
    """kind:start:end of all spans by kind, then start; ``term`` comes last."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.concat(
        F.transform(base, lambda s: F.concat_ws(":", F.element_at(name, s["rank"] + 1), s["start"], s["end"])),
        F.transform(terms, lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["end"]))), ",")


def count_rank(base: Column, rank: int) -> Column:
    return F.size(F.filter(base, lambda s: s["rank"] == rank)).cast("long")
