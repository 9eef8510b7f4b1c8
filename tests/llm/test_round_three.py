"""Whitening, token alignment, rarity digests and the batch tokenizer against plain
recomputations, with nulls, empty and long texts, ties, repeats, empty tables and clashing names."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import alignment, batchtokens, rarity, whitening

from .test_operators import docs_of, spread

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [" ", "  ", "\n", "\t", "a", "foo", "bar,", "Ünï", "日本語", "▁", "<|endoftext|>", "12", "'s", " ", "　", "</s>",
       "<0x41>", "\r\n", "😀", "é", "\x1c", "\x85"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


# ---------------------------------------------------------------- batch tokenizer

@pytest.mark.parametrize("lead", [False, True])
def test_batch_tokens_equal_the_library(lead):
    texts = odd_texts(3000) + [None, "", "x" * 20_000, " ".join(["word,", "été"] * 200_000)]
    plain = batchtokens.encoder(BYTES, plain=True)
    cases = [(plain, lambda t: plain.tokenizer.encode((" " + t if lead else t), add_special_tokens=False).ids)]
    if not lead:
        usual, pieces = batchtokens.encoder(BYTES), batchtokens.encoder(PIECES)
        cases += [(usual, lambda t: usual.tokenizer.encode(t, add_special_tokens=False).ids),
                  (pieces, lambda t: pieces.model.encode(t))]
    for tok, want in cases:
        got = tok.encode(pa.array(texts), lead)
        for k, t in enumerate(texts):
            if t or not lead:
                assert got.ids[got.start[k]:got.stop[k]].tolist() == want(t or ""), t
    assert len(plain.encode(pa.array([], pa.string())).ids) == 0
    assert list(batchtokens.slices_by_bytes(pa.array(["aa", None, "b" * 9, "c"]), 4)) == [(0, 2), (2, 3), (3, 4)]


# ---------------------------------------------------------------- 11

def brute_whitening(rows, k):
    good = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}), np.int64)
    n, s = len(fit), fit.sum(0)
    y = fit - s / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    keep = min(k, int((e > 1e-9 * e[0]).sum()))
    dev = {}
    white = []
    for i, x in good:
        dev.setdefault(i, set()).add(sum((n * a - int(b)) ** 2 for a, b in zip(x, s)))
        white.append((i, (np.array(x) - s / n) @ u[:, :keep] / np.sqrt(e[:keep])))
    return n, e, keep, dev, white


@pytest.mark.parametrize("dim", [3, 24])
def test_whitening(spark, dim):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=dim) * np.linspace(1, 3, dim)).tolist()) for i in range(300)]
    hot = rows[0][1]
    rows += [(i, hot) for i in range(300, 450)] + [(7, hot), (None, rows[1][1])]  # copies, a repeated and a null id
    bad = [(900, None), (901, []), (902, [float("nan")] * dim), (903, [None] * dim), (904, [1.0]),
           (905, [float("inf")] * dim)]
    df = spread(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn(
        "component", F.lit("x")).withColumn("id", F.lit(0)).withColumn("x", F.lit(0)))
    got = whitening.whiten(df, k=16).collect()
    n, e, keep, dev, white = brute_whitening(rows, 16)
    assert len(got) == len(rows) * keep and {r["n"] for r in got} == {n}
    assert {r["identity_error"] for r in got}.pop() < 1e-9
    for r in got:
        assert r["deviation"] in dev[r["vec_id"]]
        assert abs(r["explained"] - e[r["component"] - 1] / e.sum()) < 1e-12
    for c in range(1, keep + 1):
        mine = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["whitened"]) for r in got if r["component"] == c)
        them = np.array([w[c - 1] for _, w in sorted(white, key=lambda x: (x[0] is None, x[0] or 0))])
        vals = np.array([m[2] for m in mine])
        pick = [k for k, m in enumerate(mine) if m[1] != 7]  # the repeated id has two rows in either order
        assert min(np.abs(vals - t * them)[pick].max() for t in (1, -1)) < 1e-8
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")).count() == 0


def test_whitening_large_deviation(spark):
    rows = [(0, [0.0, 1.0]), (1, [2.0 ** 24, 5.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=1).collect()
    assert {r["deviation"] for r in got} == {(2 ** 30) ** 2 + 256 ** 2}


@pytest.mark.parametrize("make", [
    lambda r: np.eye(40) * 7, lambda r: np.diag(np.r_[np.ones(10) * 5, np.ones(20) * 3, np.arange(10.)]),
    lambda r: np.cov(r.normal(size=(5, 40)).T, bias=True), lambda r: np.ones((8, 8)), lambda r: np.zeros((4, 4)),
    lambda r: np.cov((r.normal(size=(500, 100)) * np.r_[50, np.ones(99)]).T, bias=True), lambda r: np.eye(1)])
def test_feast_finds_every_eigenpair(make):
    v = make(np.random.default_rng(1))
    e, u = whitening.top_pairs(v, 16)
    w = np.linalg.eigvalsh(v)[::-1]
    keep = min(16, int((w > 1e-12 * np.abs(v).sum(1).max() * len(v)).sum()))
    assert len(e) == keep
    if keep:
        assert np.abs(e - w[:keep]).max() <= 1e-12 * w[0]
        assert np.abs(v @ u - u * e).max() <= 1e-11 * w[0] and np.abs(u.T @ u - np.eye(keep)).max() < 1e-12
        tri = whitening.tridiagonal(v)
        assert [whitening.count_above(tri, x) for x in (-1.0, w[0] + 1)] == [len(v), 0]


# ---------------------------------------------------------------- 12

def brute_alignment(texts):
    a, b = batchtokens.encoder(BYTES, plain=True), batchtokens.encoder(PIECES)
    sa, sb = a.spellings(), b.spellings()
    out, linked = [], []
    for t in texts:
        data = (" " + (t or "")).encode()
        x = a.tokenizer.encode(" " + (t or ""), add_special_tokens=False).ids
        y = b.model.encode(t or "")
        if not t or b"".join(sa[i] for i in x) != data or b"".join(sb[i] for i in y) != data:
            out.append((0, 0, 0, 0, ""))
            linked.append([])
            continue
        ea, eb = np.cumsum([0] + [len(sa[i]) for i in x]), np.cumsum([0] + [len(sb[i]) for i in y])
        links = [(x[i], y[j]) for i in range(len(x)) for j in range(len(y)) if max(ea[i], eb[j]) < min(ea[i + 1], eb[j + 1])]
        groups, lo = [], 0
        for c in sorted(set(ea[1:].tolist()) & set(eb[1:].tolist())):
            groups.append("|".join(",".join(str(s[i]) for i in range(len(s)) if lo <= e[i] < c) for s, e in ((x, ea), (y, eb))))
            lo = c
        out.append((len(x), len(y), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        linked.append(links)
    count, best = {}, {}
    for links in linked:
        for p in set(links):
            count[p] = count.get(p, 0) + 1
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    return [(*o, sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links))
            for o, links in zip(out, linked)]


def test_alignment(spark):
    texts = [None, "", " ", "a", "<|endoftext|> <s>", "unbelievably internationalised"] + odd_texts(120, 4)
    texts += ["the same words here"] * 40 + [" ".join(["antidisestablishment", "été", "12345"] * 40)]
    df = spread(docs_of(spark, texts).withColumn("n_a", F.lit("x")).withColumn("block", F.lit(0)).withColumn("best", F.lit(0)))
    want = brute_alignment(texts)
    for block in (16 << 20, 200):  # one block and many
        got = {r["doc_id"]: r for r in alignment.align_corpus(df, BYTES, PIECES, block_bytes=block).collect()}
        assert len(got) == len(texts)
        for k, w in enumerate(want):
            r = got[k]
            assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"], r["n_best"], r["count_sum"]) == w, texts[k]
    twice = alignment.align_corpus(df.union(df), BYTES, PIECES)
    assert twice.count() == 2 * len(texts)
    assert alignment.align_corpus(df.limit(0), BYTES, PIECES).count() == 0


def test_runs_and_links_of_random_ends():
    rng = random.Random(3)
    for _ in range(500):
        n = rng.randint(1, 60)
        a, b = (sorted({n} | {k for k in range(1, n) if rng.random() < p}) for p in rng.choices([.2, .5, .8, .95, 1], k=2))
        if rng.random() < .5:
            b = sorted(set(a) ^ {k for k in range(1, n) if rng.random() < .05} | {n})
        got = alignment.diagonal_runs(a, b, [str(k) for k in range(len(a))], [str(k) for k in range(len(b))])
        sa, sb = list(zip([0] + a, a)), list(zip([0] + b, b))
        assert list(zip(got.left, got.right)) == [
            (i, j) for i, (p, q) in enumerate(sa) for j, (r, s) in enumerate(sb) if max(p, r) < min(q, s)]
        ends, lo, want = sorted(set(a) & set(b)), 0, []
        for c in ends:
            want.append("|".join(",".join(str(i) for i, (x, _) in enumerate(s) if lo <= x < c) for s in (sa, sb)))
            lo = c
        assert got.groups == want


# ---------------------------------------------------------------- 13

def test_entropy_of_windows():
    rng = random.Random(2)
    for _ in range(50):
        d = bytes(rng.choice(b"aab c\xc3") for _ in range(rng.randint(24, 200)))
        want = [int(rarity.bin_of(rarity.STEP[np.bincount(np.frombuffer(d[i:i + rarity.WINDOW], np.uint8))].sum()))
                for i in range(len(d) - rarity.WINDOW + 1)]
        assert rarity.entropy_bins(np.frombuffer(d, np.uint8)).tolist() == want


def test_features_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(4000))
    rank = rarity.ranks(np.arange(rarity.BINS)[::-1])
    whole = rarity.features(text, rank).tolist()
    monkeypatch.setattr(rarity, "CHUNK", 1000)
    assert rarity.features(text, rank).tolist() == whole and len(whole) > 500


def brute_places(rank):
    points = np.zeros(len(rank), int)
    for s in range(len(rank) - rarity.NEAR + 1):
        points[s + int(np.argmin(rank[s:s + rarity.NEAR]))] += 1
    return [k for k in range(len(rank)) if points[k] >= rarity.POINTS and rank[k] < 255]


def test_rarity_digest(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [None, "", "x", "short", "a" * 5000, "日本語テキスト" * 30, prose(20_000)] + [prose(rng.randint(60, 400)) for _ in range(60)]
    texts += [texts[-1]] * 5
    df = spread(docs_of(spark, texts).withColumn("part", F.lit("x")).withColumn("near_next", F.lit(0)))
    rank = rarity.ranks(rarity.entropy_histogram(df))
    histogram = sum(np.bincount(rarity.entropy_bins(np.frombuffer((t or "").encode(), np.uint8)), minlength=rarity.BINS)
                    for t in texts)
    assert (rarity.entropy_histogram(df) == histogram).all()
    bins = rank[rarity.entropy_bins(np.frombuffer(texts[8].encode(), np.uint8))]
    assert rarity.feature_places(bins).tolist() == brute_places(bins)
    for parts in (None, 1, 100):
        got = {r["doc_id"]: r for r in rarity.compare_neighbours(df, parts=parts).collect()}
        assert sorted(got) == list(range(len(texts)))
        for k, t in enumerate(texts):
            mine, after = t or "", texts[k - 1] or ""  # falling ids; after the last comes the first
            new = mine[:len(mine) - len(mine) // 2] + after[:len(mine) // 2]
            r = got[k]
            assert r["n_chars"] == len(mine) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
            a, b, c = (rarity.filters(x, rank) for x in (mine, new, after))
            assert (r["fingerprint"], r["edited_fingerprint"]) == (rarity.spelled(a), rarity.spelled(b))
            assert (r["near_edited"], r["near_next"]) == (rarity.likeness(a, b), rarity.likeness(a, c))
            if 300 < len(mine) and 300 < len(after) and mine != after and k not in (4, 5):
                assert r["near_edited"] > 0.25 > r["near_next"]
    assert got[len(texts) - 1]["near_next"] == 1.0
    rows = [(None, "b"), (None, None), (3, "c" * 100), (3, "c" * 100), (1, "d")]
    odd = rarity.compare_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(odd) == 5 and {r["n_chars"] for r in odd if r["doc_id"] == 3} == {100}
    alone = rarity.compare_neighbours(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and alone["near_next"] == 1.0
    assert rarity.compare_neighbours(df.limit(0)).count() == 0


def test_parts_of_the_last_batch_are_not_encoded_again(monkeypatch):
    BT = batchtokens
    first = pa.array(["one two, three", "four  five\nsix two", None, " a b ", "ünder one"])
    then = pa.array(["two, three one new", "one two, three", "", "six five\nsix two", "x <|endoftext|> two"])
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        for lead in (False, True):
            enc = type(BT.encoder(public_tokenizers.path(name)))(public_tokenizers.path(name))
            lists = lambda e: [e.ids[a:b].tolist() for a, b in zip(e.start, e.stop)]
            want = lists(enc.encode(then, lead))
            enc.seen = None
            enc.encode(first, lead)
            done, joined = [], enc.joined
            monkeypatch.setattr(enc, "joined", lambda w, after: done.extend(w) or joined(w, after))
            assert lists(enc.encode(then, lead)) == want
            assert "new" in done and not {"two,", "three"} & set(done)
            monkeypatch.setattr(BT, "MOST_SEEN", 0)
            assert lists(enc.encode(first, lead)) and enc.seen is None and lists(enc.encode(then, lead)) == want
            monkeypatch.undo()
