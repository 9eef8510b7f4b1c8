"""Terms that disclose protected entities, against counts over all pairs in plain Python."""
from __future__ import annotations

import math
import re
from collections import defaultdict

import pytest

from tessera.llm import pii
from tessera.sources.tables import table

from .test_operators import brute_pii, docs_of, spread


def clear_places(text, spans):
    """All terms that overlap no span, as (start, end, term)."""
    both = {(m.start(), m.end()) for p in (pii.TERM, pii.JOINED) for m in p.finditer(text)}
    return [(a, b, text[a:b].lower()) for a, b in sorted(both, key=lambda x: (x[0], -x[1]))
            if not any(s < b and a < e for _, s, e in spans)]


def around(places, a, b, window=80):
    return tuple(t for s, e, t in places if a - window <= s < b + window and e <= b + window)


def brute_told(texts, general=0.8, z=1.0):
    """Per text the terms with the part they disclose, by loops over all pairs."""
    n, docs = len(texts), []
    n_t, n_e = defaultdict(int), defaultdict(int)
    for text in texts:
        text = text or ""
        spans = brute_pii(text)
        places = clear_places(text, spans)
        entities, terms = defaultdict(set), {}
        for k, a, b in spans:
            entities[k, re.sub(r"[^\w@]", "", text[a:b].lower())].add(around(places, a, b))
        for a, b, t in places:
            terms.setdefault(t, around(places, a, b))
        for t in {m[0].lower() for p in (pii.TERM, pii.JOINED) for m in p.finditer(text)}:
            n_t[t] += 1
        for e in entities:
            n_e[e] += 1
        docs.append((entities, terms))
    seen, both = defaultdict(set), defaultdict(int)
    for entities, terms in docs:
        for e, near in entities.items():
            for t, context in terms.items():
                both[e, t] += 1
                seen[e, t].add((frozenset(near), context))
    part = {}
    for (e, t), k in both.items():
        if n_e[e] < n:
            p = k / n_t[t]
            m = len(seen[e, t]) / p
            centre, spread_ = p + z * z / (2 * m), z * math.sqrt(p * (1 - p) / m + z * z / (4 * m * m))
            part[e, t] = math.log(n * (centre - spread_) / (1 + z * z / m) / n_e[e]) / math.log(n / n_e[e])
    out = []
    for entities, terms in docs:
        told = {t: max((part.get((e, t), -9) for e in entities), default=-9) for t in terms}
        out.append({t: x for t, x in told.items() if x >= general})
    return out


def check(spark, df, id_col="doc_id"):
    texts = dict(df.select(id_col, "text").collect())
    want = dict(zip(texts, brute_told(list(texts.values()))))
    n = 0
    for r in pii.find_pii(df).collect():
        text, told = texts[r[id_col]], want[r[id_col]]
        spans = []
        for a, b, t in clear_places(text or "", brute_pii(text or "")):
            if t in told:
                if spans and a < spans[-1][1]:
                    spans[-1][2] = max(spans[-1][2], told[t])
                else:
                    spans.append([a, b, told[t]])
        assert [[s["start"], s["end"]] for s in r["terms"]] == [s[:2] for s in spans]
        assert [s["part"] for s in r["terms"]] == pytest.approx([s[2] for s in spans], abs=1e-9)
        n += len(spans)
    return n


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_terms_of_the_tables(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents")
    assert check(spark, docs) > (50 if sf == "sf0.01" else 0)


def test_terms_of_copies_lists_and_shared_entities(spark):
    common = "words that all of these texts hold in one order or another"
    texts = [f"{common} filler{k % 7} more of it {k % 5} end" for k in range(80)]
    texts += [f"{common} jane_{'abcdef'[k]} doe{k} writes to hr@corp.org from gate{k % 2} doe{k}" for k in range(6)]
    texts += ["kilroy was here, once, at lone@corp.org and 10.1.2.3, 10.1.2.4"]  # entities of one text
    texts += [f"{common} copied passage zanzibar kim@corp.org {common}"] * 9
    texts += [f"list {' '.join(f'u{i}@corp.org' for i in range(600))} listed{k}" for k in range(2)]  # many blocks
    texts += [None, "", "hr@corp.org", "zanzibar", "doe3 alone"]
    df = spread(docs_of(spark, texts))
    assert check(spark, df) > 10
    shown = {r["doc_id"]: {texts[r["doc_id"]][s["start"]:s["end"]] for s in r["terms"]} for r in pii.find_pii(df).collect()}
    assert "kilroy" in shown[86] and "writes" in shown[80]  # one document is evidence, if less of it
    assert not any("zanzibar" in x or "words" in x for x in shown.values())  # copies are not


def test_keys_of_many_rows_are_dealt(spark):
    rows = spark.range(500).selectExpr("id as row", "if(id < 400, 'a', concat('b', id)) as k")
    each = rows.groupBy("k").count()
    got = pii.join_dealt(rows, each, "k", "count", most=10)
    assert sorted(map(tuple, got.select("row", "k", "count").collect())) == sorted(
        map(tuple, rows.join(each, "k").select("row", "k", "count").collect()))


def test_one_document_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "only bob@corp.org here", "x", 2)], "doc_id long, text string, w string, row long")
    assert [r["terms"] for r in pii.find_pii(df).collect()] == [[]]  # all documents mention it
    assert pii.sanitise(df).first()["text"] == "only [EMAIL] here"
