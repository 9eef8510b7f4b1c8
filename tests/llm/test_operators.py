"""Every operator against brute force on small tables, with nulls, empty and long
texts, ties, repeated rows, empty tables and columns that clash."""
import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import e8, langid, mixing, packing, permutation, pii, secrets, simhash, tokencount, warc
from tessera.llm.common import connected_components, shared_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, **more):
    rows = [(k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def spread(df):
    return df.repartition(3)


# ---------------------------------------------------------------- common

def test_connected_components(spark):
    rng = np.random.default_rng(0)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, int(x)) for x in rng.integers(101, 200, 60)] + [(7, 7), (300, 299)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert all(got[k] == 0 for k in range(61)) and got[300] == got[299] == 299
    assert {v for k, v in got.items() if 100 <= k < 200} == {100}
    empty = spark.createDataFrame([], "a long, b long")
    assert connected_components(empty, "a", "b").count() == 0


# ---------------------------------------------------------------- 1

def brute_search(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for at, (q, x) in enumerate(good):
        if q % 20 == 0:
            near = sorted((-float((x * y).sum()), i) for b, (i, y) in enumerate(good) if b != at)[:k]
            out[q] = near
    return out


def test_permutation_search(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(400)]
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] + [1.0] * 7), (1003, [None] + [1.0] * 7),
             (1004, [1.0, 2.0]), (1020, [float("inf")] * 8), (1040, rows[0][1]), (1041, rows[0][1])]
    df = spread(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = permutation.permutation_search(df, F.col("vec_id") % 20 == 0, k=5, pivots=32, prefix=16, shard_rows=100,
                                         query_block=7).collect()
    want = brute_search([r for r in rows if r[0] != 1004], 5)
    assert {r["query_id"] for r in got} == set(want)
    for q, near in want.items():
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[1] for m in mine] == [i for _, i in near]  # shards are small: all of them is reranked
        assert np.allclose([m[2] for m in mine], [-s for s, _ in near], rtol=0, atol=1e-12)


def test_permutation_recall_and_few_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=32).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = permutation.permutation_search(df, F.col("vec_id") % 100 == 0, k=20, least=20, share=0.15, shard_rows=1500)
    x = np.array([r[1] for r in rows])
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in found:
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert len(found) == 30 and hits >= 0.9 * 600
    assert permutation.permutation_search(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert permutation.permutation_search(df.limit(1), F.lit(True)).count() == 0


def test_permutation_copies_and_a_cluster(spark):
    rng = np.random.default_rng(13)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    one, centre = unit(rng.normal(size=(2, 32)))
    x = np.concatenate([unit(rng.normal(size=(1000, 32))), unit(centre + 0.05 * rng.normal(size=(1000, 32))),
                        np.tile(one, (1000, 1))])  # a third each: apart, in a cluster, copies
    x = x[rng.permutation(len(x))]
    df = spread(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"))
    got = permutation.permutation_search(df, F.col("vec_id") % 30 == 0, k=10, pivots=64, prefix=32, least=50, share=0.12)
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    copies = [i for i, v in enumerate(x) if (v == one).all()]
    hits = {"apart": [], "cluster": []}
    for q, mine in found.items():
        mine = [i for _, i in sorted(mine)]
        if q in copies:
            assert mine == [i for i in copies if i != q][:10]  # the smallest ids
            continue
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(len(x)), -s))[:10]
        hits["cluster" if x[q] @ centre > 0.7 else "apart"].append(len(set(mine) & set(want.tolist())) / 10)
    assert len(found) == 100 and all(len(h) > 20 and np.mean(h) >= 0.85 for h in hits.values()), {
        k: np.mean(h) for k, h in hits.items()}
    units = permutation.apart(np.concatenate([np.tile(one, (50, 1)), unit(rng.normal(size=(20, 32)))]), 64)
    assert len(units) == 21  # equal vectors give one pivot


# ---------------------------------------------------------------- 2

PII_TEXT = ("mail a.b@x.org, a@b@c.d.e or +1 (743) 555-3824, 10.0.0.256 10.0.0.1.2.3.4 "
            "4785 3805-9239 1139 1234567890123456 é +12 --@x.y @z.w ")


def brute_pii(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15)]
    return [(k, m.start(), m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, t) if ok(m)]


def test_pii_base_spans():
    rng = np.random.default_rng(3)
    texts = [PII_TEXT, "", "a" * 200_000 + "@", "1" * 100_000, "1." * 5000, "+" * 5000, "@" * 3000]
    texts += ["".join(rng.choice(list("ab0129.@+- ()é"), 60)) for _ in range(3000)]
    for t in texts:
        if len(t) < 3000:
            assert pii.base_spans(t) == brute_pii(t), t
        else:
            pii.base_spans(t)  # ends in time
    assert len(pii.base_spans(PII_TEXT)) >= 5


def test_pii_terms_and_sanitise(spark):
    filler = "plain words that stand in every document of the corpus here"
    texts = [f"{filler} number {chr(97 + k % 26) * 4} nothing at all" for k in range(60)]
    texts += [f"{filler} quixotic reaches {'abcde'[k]}day bob@corp.org {filler}" for k in range(5)]
    texts += [f"{filler} copied uniqueword ann@corp.org {filler}"] * 6  # one passage, six times
    texts += [None, "", "call +1 (743) 555-3824 now", "quixotic alone"]
    df = spread(docs_of(spark, texts).withColumn("hash", F.lit(1)).withColumn("base", F.lit("x")))
    got = {r["doc_id"]: r for r in pii.find_pii(df).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        assert [(s["rank"], s["start"], s["end"]) for s in got[k]["base"]] == brute_pii(t or "")
    shown = {texts[k][s["start"]:s["end"]] for k in got for s in got[k]["terms"]}
    assert "quixotic" in shown and "reaches" in shown and not shown & {"uniqueword", "copied", "words", "corpus"}
    clean = {r["doc_id"]: r for r in pii.sanitise(df).collect()}
    assert pii.sanitise(df).columns == df.columns
    assert "bob@corp.org" not in clean[60]["text"] and "quixotic" not in clean[60]["text"]
    assert "[EMAIL]" in clean[60]["text"] and "[PHONE]" in clean[73]["text"] and clean[71]["text"] is None
    assert clean[74]["text"] == "quixotic alone" and all(clean[k]["text"] == texts[k] for k in range(60))
    assert pii.find_pii(df.limit(0)).count() == 0 and pii.sanitise(df.limit(0)).count() == 0


def test_pii_terms_of_whole_documents(spark):
    far = "plain words that stand in every document of the corpus here and fill more than a window " * 2
    names = ["alpha", "bravo", "carol", "delta", "early"]
    texts = [f"{far} number {k} nothing at all" for k in range(60)]
    texts += [f"quixotic {far} {w} bob@corp.org {far} kz91x {w}, \u674e\u660e. {far} jo_77 {w} quixotic" for w in names]
    passage = f"{far} uniqueword {far} ann@corp.org {far}"  # one passage in six different documents
    texts += [f"{'uvwxyz'[k] * 4} {passage} {'uvwxyz'[k] * 5}" for k in range(6)]
    df = spread(docs_of(spark, texts))
    shown = {}
    for r in pii.find_pii(df).collect():
        t = texts[r["doc_id"]]
        shown[r["doc_id"]] = [t[s["start"]:s["end"]] for s in r["terms"]]
    for k in range(60, 65):
        assert shown[k] == ["quixotic", "kz91x", "\u674e\u660e", "jo_77", "quixotic"]
    assert not any(shown[k] for k in shown if not 60 <= k < 65)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert not any(w in clean[k] for k in range(60, 65) for w in ("quixotic", "kz91x", "\u674e\u660e", "jo_77"))


def test_pii_frequencies_without_broadcast(spark):
    df = docs_of(spark, ["one two two", "two three", None, ""])
    terms = spark.createDataFrame([("two",), ("three",)], "term string")
    for most in (100, 1):
        got = {r["term"]: r["n_t"] for r in pii.document_frequencies(df, terms, "text", most).collect()}
        assert got == {"two": 2, "three": 1}


# ---------------------------------------------------------------- 3

def test_language_id(spark):
    rng = np.random.default_rng(4)
    words = {"aa": ["lumo", "sel", "kanta", "mori"], "bb": ["zwei", "strass", "fühl", "krantz"]}
    rows = [(k, " ".join(rng.choice(words[lang], 30)), lang, None, 0) for k in range(300) for lang in [("aa", "bb")[k % 2]]]
    rows += [(900, None, "aa", None, 0), (901, "123 !?", "bb", None, 0), (902, "lumo", None, None, 0),
             (None, "lumo sel", "aa", None, 0), (903, "lumo sel kanta " * 20_000, None, None, 0)]
    df = spread(spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("x")))
    model = langid.train(df)
    out = {r["doc_id"]: r for r in langid.predict(df, model).withColumn("held", langid.is_held_out("doc_id")).collect()}
    assert len(out) == len(rows) and out[900]["lang_pred"] == out[901]["lang_pred"] == "und"
    assert out[900]["rejected"] and out[901]["score"] == 0 and not out[None]["held"]
    assert all(out[k]["held"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k in range(300))
    held = [k for k in range(300) if out[k]["held"]]
    assert held and all(out[k]["lang_pred"] == ("aa", "bb")[k % 2] and not out[k]["rejected"] for k in held)
    assert out[903]["lang_pred"] == "aa" and all(0 <= r["score"] <= 1 for r in out.values())
    nothing = langid.train(df.limit(0))
    assert langid.predict(df.limit(0), nothing).count() == 0
    assert {r["lang_pred"] for r in langid.predict(df, nothing).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(rng.choice(["lumo", "sel", "kanta"], 30)), "aa") for k in range(200)]
    rows += [(1000 + k, " ".join(rng.choice(["zwei", "strass", "krantz"], 15_000)), "bb") for k in range(40)]  # long ones only
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["aa", "bb"] and model.predict("krantz zwei strass")[0] == "bb"
    many = [(k, f"w{k} text{k % 7}", f"l{k % 1500:04}") for k in range(6000)]  # four of a language, crc32 holds some back
    df = spark.createDataFrame(many + [many[0]] * 50, "doc_id long, text string, lang string")
    shown = {r[0] for r in df.where(~langid.is_held_out("doc_id")).select("lang").distinct().collect()}
    model = langid.train(df, most_rows=1500)
    assert set(model.langs) == shown and model.predict("any text")[0] in shown
    with pytest.raises(ValueError):
        langid.train(df, most_langs=100)


# ---------------------------------------------------------------- 4

BASE = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         lambda m: len(m[2]) >= 6), ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]


def test_secrets(spark):
    rng = np.random.default_rng(5)
    rand = "aB3dE5gH7jK9mN1pQ3sT"
    far = "word " * 200
    texts = ["token=token:abcdef", "é😀 password = 'hunter22' x", "AKIA" + "A" * 16 + " AKIAB", None, "", "f" * 30,
             f"client_id=alice77 {rand} https://api.example.org/v1",  # all parts: three links
             f"client_id=alice77 {far}{rand}", f"{rand} alone", "https://api.example.org alone",
             f"see https://api.example.org/v1 {rand}", "token=" + rand, "a" * 300_000 + " token=abcdefg"]
    texts += ["".join(rng.choice(["token", "=", ":", "'", " ", "ab12cd", "AKIA", "XYZ" * 6, "0a" * 13, "é", "\n"], 25))
              for _ in range(300)]
    df = spread(docs_of(spark, texts).withColumn("row", F.lit(0)).withColumn("spans", F.lit(0)))
    got = {r["doc_id"]: r["spans"] for r in secrets.secret_spans(df).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        want = sorted((m.start(), n, m.end()) for n, (_, p, ok) in enumerate(BASE) for m in re.finditer(p, t or "") if ok(m))
        assert [(s["start"], s["rank"], s["end"]) for s in got[k] if s["rank"] < 3] == want, t
    weak = lambda k: [s["kind"] for s in got[k] if s["rank"] >= 3]
    assert weak(6) == ["identity", "random", "endpoint"] and weak(7) == weak(8) == weak(9) == weak(11) == []
    assert weak(10) == ["random"]
    again = secrets.secret_spans(df.union(df)).groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("spans").alias("d"))
    assert again.where("n <> 2 or d <> 1").count() == 0
    assert secrets.secret_spans(df.limit(0)).count() == 0
    digest = secrets.secret_spans(df).select("doc_id", secrets.span_digest(F.col("spans")).alias("d")).where("doc_id = 3").first()
    assert digest["d"] == hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- 5

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for k, t in enumerate(texts):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for n, r in enumerate(sorted(by[k], key=lambda r: r["piece"])):
            part = ids[at:at + r["length"]]
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(part.tobytes()))
            assert n == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark):
    rng = np.random.default_rng(6)
    texts = [None, "", " ", "a  b \n c", "<|endoftext|> x", "x" * 5000, "één  twee\tdrie", " lead", "trail ", "tab\t x",
             "don't  stop 123 45é6 😀 ‥   　z"]
    texts += [" ".join(rng.choice(["the", "Of,", "été", "x1.", "don't", "\n", ""], int(n))) for n in rng.integers(1, 300, 80)]
    df = spread(docs_of(spark, texts).withColumn("piece", F.lit(1)).withColumn("offset", F.lit(1)))
    rows = packing.pack_documents(df, BYTES, 256, part_rows=30).collect()
    n = check_packing(rows, texts, 256)
    whole = packing.best_fit_decreasing(np.array([r["length"] for r in rows]), 256)[2]
    bound = packing.lower_bound(np.bincount([r["length"] for r in rows], minlength=257), 256)
    assert bound <= n <= len(whole) + 1  # parts of 30 rows pack about as well as all at once
    assert packing.pack_documents(df.limit(0), BYTES, 256).count() == 0
    twice = packing.pack_documents(df.union(df), BYTES, 256).collect()
    assert len(twice) == 2 * len(rows) and sum(r["length"] for r in twice) == 2 * sum(r["length"] for r in rows)


def test_lower_bounds():
    rng = np.random.default_rng(7)
    for _ in range(60):
        n = rng.integers(1, 101, int(rng.integers(1, 40)))
        where, offset, room = packing.best_fit_decreasing(n, 100)
        assert packing.lower_bound(np.bincount(n, minlength=101), 100) <= len(room)
        assert (np.bincount(where, weights=n) == 100 - room).all()
    assert packing.lower_bound(np.bincount([51] * 9, minlength=101), 100) == 9
    assert packing.lower_bound(np.bincount([34] * 9, minlength=101), 100) == 5


# ---------------------------------------------------------------- 6

def test_warc(spark):
    pages = [(5, "http://a/5", "<p>é</p>"), (3, "http://a/3", "<p>é</p>"), (9, None, None), (8, "", ""), (1, "u", "x" * 400_000),
             (2, "v", "x" * 400_000), (4, "w\r\nX: y", "a\r\n\r\nb"), (None, "n", "<p>é</p>"), (7, "z", "solo"), (7, "z", "solo")]
    df = spread(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("id", F.lit(0)))
    folder = shared_path(spark, "warc-test")
    index = warc.write_bundles(df, folder, frame_bytes=1000)
    got = warc.read_records(index, folder).collect()
    assert len(got) == len(pages)
    first = {}
    for i, _, h in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(h or "", i)
    for i, _, h in pages:
        data = (h or "").encode()
        r = next(r for r in got if r["id"] == i)
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first[h or ""] == i else ("revisit", first[h or ""]))
        assert r["payload"] == (data if r["record_type"] == "response" else b"")
    one = warc.read_records(index.where("id = 4"), folder).collect()  # a single record by its frame
    assert [r["payload"] for r in one] == [b"a\r\n\r\nb"]
    import zstandard

    fs, root = warc.filesystem(folder)
    name = index.first()["bundle"]
    data = fs.open_input_file(f"{root}/{name}").read()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1\r\n")  # any Zstandard reader takes the file
    least = warc.write_bundles(df, shared_path(spark, "warc-test"), least_bytes=100)
    assert least.count() == len(pages)
    assert warc.write_bundles(df.limit(0), shared_path(spark, "warc-test")).count() == 0


# ---------------------------------------------------------------- 7

def brute_fingerprint(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = re.findall("[^\x20\x09-\x0d]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= bits:
                root[find(a)] = find(b)
    least = {}
    for a in range(len(ids)):
        least[find(a)] = min(least.get(find(a), ids[a]), ids[a])
    return {ids[a]: least[find(a)] for a in range(len(ids))}


def test_simhash(spark):
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(200)]
    texts = [None, "", " \n ", "ÀB C D E\x1cF", "one", "one two"]
    for _ in range(40):
        base = list(rng.choice(words, 120))
        texts.append(" ".join(base))
        for _ in range(int(rng.integers(0, 4))):
            base[int(rng.integers(0, 120))] = "changed"
            texts.append("\t".join(base).upper())
    texts.append("long word " * 40_000)
    df = spread(docs_of(spark, texts).withColumn("fp", F.lit("x")).withColumn("id", F.lit("y")))
    fps = [brute_fingerprint(t) for t in texts]
    want = brute_components(list(range(len(texts))), fps, 4)
    for rows in (1024, 1):  # 1: every key that two share is crowded, so words between link them
        got = {r["doc_id"]: r for r in simhash.simhash_components(df, bucket_rows=rows).collect()}
        assert {k: r["component_id"] for k, r in got.items()} == want
        assert all(r["fp"] % (1 << 64) == fps[k] for k, r in got.items())
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == set(want.values())
    twice = simhash.drop_near_duplicates(df.union(df))
    assert sorted(r["doc_id"] for r in twice.collect()) == sorted(set(want.values()))
    assert simhash.simhash_components(df.limit(0)).count() == 0 and simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_golay_keys_meet():
    rng = np.random.default_rng(9)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64) << np.uint64(1)
    for bits in (0, 1, 2, 3, 4, 5):
        other = fps.copy()
        for k in range(len(other)):
            for b in rng.choice(64, bits, replace=False):
                other[k] ^= np.uint64(1 << int(b))
        a = set(zip(*(x.tolist() for x in simhash.golay_keys(fps))))
        hit = {i for key, i in zip(*(x.tolist() for x in simhash.golay_keys(other))) if (key, i) in a}
        assert len(hit) == len(fps)


# ---------------------------------------------------------------- 8

def test_mixture(spark):
    rows = [(k, "x" * (10 + k % 5), "en", "big" if k < 800 else f"s{k % 4}", 0) for k in range(1000)]
    rows += [(2000, None, None, None, None), (2001, "", "en", "blank", 0), (None, "abc", "en", "s0", 3)]
    df = spread(spark.createDataFrame(rows, DOCS).withColumn("rate", F.lit(1)).withColumn("copy", F.lit(1)))
    out = mixing.mix_sources(df)
    assert out.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "rate", "copy", "place"]
    got = out.collect()
    assert len({(r["doc_id"], r["copy"]) for r in got}) == len(got)
    chars = {}
    for r in got:
        chars[r["source"]] = chars.get(r["source"], 0) + len(r["text"] or "")
    mean = sum(len(r[1] or "") for r in rows) / 5
    assert all(abs(chars[s] / mean - 1) < 0.35 for s in ("big", "s0", "s1", "s2", "s3"))
    again = mixing.mix_sources(df.repartition(5)).collect()
    assert sorted((r["doc_id"] or -1, r["copy"]) for r in got) == sorted((r["doc_id"] or -1, r["copy"]) for r in again)
    only = mixing.mix_sources(df, {"s1": 1.0}).collect()
    assert {r["source"] for r in only} - {"s1"} <= {"blank", None}
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_poisson_table(spark):
    from math import exp, factorial

    rates = spark.createDataFrame([("a", 0.3), ("b", 4.0), (None, 900.0)], "source string, rate double")
    got = {r["source"]: r["cdf"] for r in mixing.poisson_tables(rates).collect()}
    for s, m in (("a", 0.3), ("b", 4.0)):
        assert np.allclose(got[s][:8], np.cumsum([exp(-m) * m ** k / factorial(k) for k in range(8)]), atol=1e-12)
    assert abs(got[None][-1] - 1) < 1e-9 and abs(sum(1 - c for c in got[None]) - 900) < 1e-3


def test_poisson_of_large_rates(spark):
    from math import erf, sqrt

    rates = spark.createDataFrame([("a", 1e6), ("b", 2.5e7), (None, 1001.5)], "source string, rate double")
    for r in mixing.poisson_tables(rates).collect():
        m = {"a": 1e6, "b": 2.5e7, None: 1001.5}[r["source"]]
        cdf = np.array(r["cdf"])
        assert len(cdf) <= 24 * sqrt(m) + 64 and r["low"] < m  # the state grows with the root
        assert abs(cdf[-1] - 1) < 1e-12 and cdf[0] < 1e-12
        p = np.diff(cdf, prepend=0)
        k = r["low"] + np.arange(len(cdf))
        assert abs((p * k).sum() / m - 1) < 1e-9 and abs((p * (k - m) ** 2).sum() / m - 1) < 1e-4
        at = int(m + sqrt(m)) - r["low"]
        assert abs(cdf[at] - (1 + erf(1 / sqrt(2))) / 2) < 2 / sqrt(m) + 1e-6
    # one short document beside a large source: its rate is 1e6
    rows = [(1, "x", "en", "tiny", 1), (2, "y" * 1_999_999, "en", "large", 1_999_999)]
    out = mixing.mix_sources(spark.createDataFrame(rows, DOCS)).where("source = 'tiny'")
    n, low, high, different = out.agg(F.count("*"), F.min("copy"), F.max("copy"), F.countDistinct("copy")).first()
    assert abs(n - 1e6) < 6e3 and (low, high, different) == (0, n - 1, n)


# ---------------------------------------------------------------- 9

@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts(spark, name):
    rng = np.random.default_rng(10)
    path = public_tokenizers.path(name)
    texts = [None, "", " ", "  ", "a  b", " a", "a ", "▁a ▁", "<s> </s> <unk> <|endoftext|>", "x" * 20_000, "é ü 　 ﬁ",
             "line\n next \n\n\tq", "😀 😀😀 \x1c \x85 z"]
    texts += ["".join(rng.choice(["a", "the", " ", " ", "  ", "\n", "é", "1", ",", "▁", "\t", "😀"], 40)) for _ in range(400)]
    texts.append("many words " * 30_000)
    df = spread(docs_of(spark, texts).withColumn("n", F.lit(0)).withColumn("n_tokens", F.lit(0)))
    got = {r["doc_id"]: r for r in tokencount.count_tokens(df, path).collect()}
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        want = [len(SentencePieceProcessor(model_file=path).encode(t or "")) for t in texts]
    else:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        want = [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert [got[k]["n_tokens"] for k in range(len(texts))] == want
    assert all(got[k]["n_bytes"] == len((t or "").encode()) and got[k]["over_limit"] == (want[k] > 4096)
               for k, t in enumerate(texts))
    assert tokencount.count_tokens(df.limit(0), path).count() == 0


# ---------------------------------------------------------------- 10

def brute_links(rows, least):
    good = {k: np.array(v, float) for k, (_, v) in enumerate(rows)
            if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)}
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in good:
        for b in good:
            if a < b and (good[a] * good[b]).sum() / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= least:
                n[a] += 1
                n[b] += 1
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return sorted((i, n[k], low[find(k)], i == low[find(k)]) for k, (i, _) in enumerate(rows))


def test_lattice(spark):
    rng = np.random.default_rng(11)
    rows, k = [], 0
    for _ in range(40):
        c = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((k, (c + 0.12 * rng.normal(size=16)).tolist()))
            k += 1
    rows += [(k, rows[0][1]), (k + 1, rows[0][1]), (k + 1, rows[0][1]), (k + 2, None), (k + 3, [0.0] * 16),
             (k + 4, [float("nan")] * 16), (k + 5, [None] * 16), (k + 6, [1.0]), (k + 7, [2 * x for x in rows[3][1]])]
    df = spread(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("copies", F.lit(0)))
    want = brute_links(rows, 0.9)
    for bucket in (4096, 3):  # 3: most cells are compared in blocks
        got = sorted(tuple(r) for r in e8.lattice_components(df, tables=12, bucket_rows=bucket).collect())
        assert got == want
    assert e8.lattice_components(df.limit(0)).count() == 0
    assert e8.lattice_components(df.where("embedding is null")).collect()[0]["n_links"] == 0


def test_lattice_with_shipped_parameters(spark):
    rng = np.random.default_rng(14)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(rng.normal(size=(3000, 64)))
    away = rng.normal(size=x.shape)
    away = unit(away - (away * x).sum(1, keepdims=True) * x)
    cosine = np.repeat([0.9 + 1e-9, 0.915, 0.93], 1000)[:, None]
    y = cosine * x + np.sqrt(1 - cosine ** 2) * away  # one pair each, nothing else is as near
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([x, y]))]
    df = spread(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    links = {r["vec_id"]: r["n_links"] for r in e8.lattice_components(df, least=0.9).collect()}
    recall = [np.mean([links[k] for k in range(a, a + 1000)]) for a in (0, 1000, 2000)]
    print("recall at 0.9, 0.915, 0.93:", recall)
    assert all(links[k] == links[k + 3000] <= 1 for k in range(3000))
    assert recall[0] >= 0.98 and recall[1] >= 0.99 and recall[2] >= 0.995


def test_e8_decode():
    rng = np.random.default_rng(12)
    y = rng.normal(0, 2, (2000, 8))
    c = e8.decode(y)
    whole = np.abs(c - np.rint(c)).max(1) < 1e-9
    half = np.abs(c - .5 - np.rint(c - .5)).max(1) < 1e-9
    assert (whole | half).all() and (np.rint(c.sum(1)) % 2 == 0).all() and len(e8.ROOTS) == 240
    d = ((y - c) ** 2).sum(1)
    assert (d <= 1 + 1e-9).all()  # the covering radius
    assert all((((y[k] - c[k] - e8.ROOTS) ** 2).sum(1) >= d[k] - 1e-9).all() for k in range(200))
