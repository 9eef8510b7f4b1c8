"""Registered queries and the pipeline on the small tables."""
import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import langid, pii
from tessera.llm.catalog import ORACLE, QUERIES
from tessera.llm.common import pin
from tessera.sources.tables import table

from .test_operators import brute_components, brute_fingerprint, brute_pii

SMALL = "/root/testdata/sf0.001"


def test_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_runs(spark, key):
    df = QUERIES[key](spark, SMALL)
    n = df.count()
    if key.startswith(("op2_", "op3_", "op4_", "op7_", "op9_", "op12_", "op13_")):
        assert n == table(spark, SMALL, "documents").count()
    assert n > 0 and len(set(df.columns)) == len(df.columns)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, key):
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    want = con.execute(ORACLE[key])
    columns = [d[0] for d in want.description]
    df = QUERIES[key](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_pipeline_against_brute_force(spark):
    """Each stage on its own input: plain Python over the collected rows."""
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        was = before.collect()
        after = pin(stage(spark, before, SMALL), name)
        now = after.collect()
        if name != "pack":
            assert after.columns == columns
        if name == "language_id":
            model = langid.train(before)
            keep = [r for r in was if (p := model.predict(r["text"]))[0] != "und" and p[1] >= model.reject]
            assert sorted(now) == sorted(keep) and len(keep) > 0.95 * len(was)
        elif name == "simhash_dedup":
            ids = [r["doc_id"] for r in was]
            want = brute_components(ids, [brute_fingerprint(r["text"]) for r in was], 4)
            assert sorted(r["doc_id"] for r in now) == sorted(set(want.values()))
            assert {tuple(r) for r in now} <= {tuple(r) for r in was}
        elif name == "pii":
            told = {r["doc_id"]: r["terms"] for r in pii.find_pii(before).collect()}
            for r, new in zip(sorted(was), sorted(now)):
                spans = [(a, b, f"[{pii.KINDS[k].upper()}]") for k, a, b in brute_pii(r["text"])]
                spans += [(t["start"], t["end"], "" if t["part"] >= 0.95 else "[TERM]") for t in told[r["doc_id"]]]
                assert new["text"] == (pii.redact(r["text"], spans) if spans else r["text"])
                assert (new["doc_id"], new["lang"], new["source"]) == (r["doc_id"], r["lang"], r["source"])
        elif name == "mix":
            chars = Counter()
            for r in was:
                chars[r["source"]] += len(r["text"])
            want = Counter()
            for r in was:
                rate = sum(chars.values()) / len(chars) / chars[r["source"]]
                u = (int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:13], 16) + 1) / 2 ** 52
                p, k, total = math.exp(-rate), 0, math.exp(-rate)
                while total < u:
                    k += 1
                    p *= rate / k
                    total += p
                want[tuple(r)] += k
            assert Counter(map(tuple, now)) == +want
        else:
            check_packing_of_copies(now, was)
        before = after
    assert sorted(corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "length", "ids_crc32").collect()) == sorted(
        after.select("doc_id", "piece", "length", "ids_crc32").collect())


def check_packing_of_copies(pieces, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, full = Counter(), 2048
    for r in docs:
        ids = np.array(tok.encode(r["text"], add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) if len(ids) <= full else len(ids) % full or full
        cuts = [0, first, *range(first + full, len(ids) + 1, full)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == want
    bins = Counter()
    for p in pieces:
        bins[p["sequence_id"]] += p["length"]
    assert max(bins.values()) <= full
    assert len(bins) <= -(-sum(bins.values()) // full) + 3
