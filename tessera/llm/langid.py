"""Language identification: averaged hashed subword embeddings, a linear softmax
trained by stochastic gradient descent, and calibrated rejection.

Texts are lower-cased, everything but letters becomes a space, and the hashed
byte n-grams (2 to 4, spaces at word edges included) of the whole text are
averaged in an embedding table, which a linear layer maps to languages.  For
prediction both are multiplied out to one weight per bucket and language.
"""
from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .common import fresh, release

# Bytes that stay: lower-case letters and all of multi-byte characters.
KEEP = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SPACES = re.compile(rb" +")
LATIN = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return LATIN.search(text) is not None or any(map(str.isalpha, text))


def ngrams(text: str, bits: int) -> np.ndarray:
    """Buckets of the hashed 2-, 3- and 4-grams of the bytes of a text."""
    data = SPACES.sub(b" ", b" " + text.lower().encode("utf-8", "replace").translate(KEEP) + b" ")
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    out = []
    gram = b
    for n in range(1, 4):
        if len(b) <= n:
            break
        gram = gram[:-1] | b[n:] << np.uint32(8 * n)
        h = (gram ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    """Logits are the mean of the rows of ``weights`` times ``lin``: (buckets, languages)
    with the layers multiplied out, or (buckets, dim) where languages are more than
    that.  Scores under ``reject`` are rejected."""

    langs: list[str]
    weights: np.ndarray
    lin: np.ndarray
    bias: np.ndarray
    heat: float
    reject: float
    bits: int

    def logits(self, text: str) -> np.ndarray:
        g = ngrams(text, self.bits)
        total = np.zeros(self.weights.shape[1])
        for at in range(0, len(g), 1 << 16):  # long texts in slices
            total += self.weights[g[at:at + (1 << 16)]].sum(0, dtype=np.float64)
        return total / max(1, len(g)) @ self.lin + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not has_letter(text):
            return "und", 0.0
        z = self.logits(text) / self.heat
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def fit(texts: list[str], labels: list[str], bits: int = 15, dim: int = 16, epochs: int = 4, rate: float = 0.5,
        clean_lost: float = 0.002, seed: int = 3) -> Model:
    """Train on four of five texts, whole and in short windows; on the fifth, set
    the softmax temperature by whole texts and windows of a few words, and the
    score under which ``clean_lost`` of the whole texts fall (0.5 at most)."""
    langs = sorted(set(labels))
    if not langs:
        return Model([], np.zeros((1 << bits, 0), np.float32), np.zeros((0, 0)), np.zeros(0), 1.0, 0.5, bits)
    rng = np.random.default_rng(seed)
    size, n = 1 << bits, len(langs)
    emb = rng.normal(0, 1 / dim, (size, dim)).astype(np.float32)
    lin, bias = np.zeros((dim, n), np.float32), np.zeros(n, np.float32)

    def window(text: str, most: int = 40) -> str:
        words = text.split()
        k = int(rng.integers(1, most))
        at = int(rng.integers(0, max(1, len(words) - k)))
        return " ".join(words[at:at + k])

    def example(text: str, label: str):
        g, c = np.unique(ngrams(text, bits), return_counts=True)
        return g, (c / max(1, c.sum())).astype(np.float32), langs.index(label)

    hold, seen = [], Counter()  # each fifth text of a language is held back
    for y in labels:
        seen[y] += 1
        hold.append(seen[y] % 5 == 0)
    shown = [example(t, y) for t, y, h in zip(texts, labels, hold) if not h]
    shown += [example(window(t), y) for t, y, h in zip(texts, labels, hold) if not h]
    # each language has the same part in the loss
    per = np.bincount([y for *_, y in shown], minlength=n)
    share = len(shown) / (n * np.maximum(per, 1))
    steps, step = epochs * len(shown), 0
    for _ in range(epochs):
        for i in rng.permutation(len(shown)):
            g, w, y = shown[i]
            if not len(g):
                continue
            lr = rate * (1 - step / steps) * min(4.0, share[y])
            step += 1
            hidden = w @ emb[g]
            z = hidden @ lin + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = lin @ p
            lin -= lr * np.outer(hidden, p)
            bias -= 0.1 * lr * p
            emb[g] -= (lr * len(g) * 0.05) * w[:, None] * back
    layers = ((emb @ lin).astype(np.float32), np.eye(n)) if n <= dim else (emb, lin.astype(np.float64))
    model = Model(langs, *layers, bias.astype(np.float64), 1.0, 0.5, bits)
    held = [(t, langs.index(y)) for t, y, h in zip(texts, labels, hold) if h and has_letter(t)]
    if held:
        whole = np.array([model.logits(t) for t, _ in held])
        short = [(model.logits(w), y) for t, y in held for w in (window(t, 8), window(t, 8)) if has_letter(w)]
        z = np.concatenate([whole, *[a[None] for a, _ in short]])
        y = np.array([y for _, y in held] + [y for _, y in short])

        def scores(z, heat):
            e = np.exp((z - z.max(1, keepdims=True)) / heat)
            return e / e.sum(1, keepdims=True)

        loss = lambda heat: -np.log(scores(z, heat)[np.arange(len(y)), y] + 1e-9).mean()
        model.heat = float(min(np.geomspace(0.05, 5, 60), key=loss))
        model.reject = float(min(0.5, np.quantile(scores(whole, model.heat).max(1), clean_lost)))
    return model


def is_held_out(id_col: str) -> Column:
    """Column: crc32 of the id as text leaves 2 when divided by 4 (null ids: no)."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = 1200, most_rows: int = 12_000, most_chars: int = 24_000_000,
          most_langs: int = 10_000) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out.

    Documents are drawn by a hash of the id, about ``per_lang`` of each language, or
    fewer where ``most_rows`` are shared by many languages, but of every language one
    at least: none is left out.  Of texts longer than ``most_chars`` over the number of
    rows expected, a window at a hashed place is taken, so long documents are learned
    like others.  At most ``2 * most_rows`` + ``most_langs`` rows and about 2 *
    ``most_chars`` characters (under 200 MB in UTF-8) reach the driver.

    Null labels and texts are not sampled; null ids count as not held out.  Repeated
    rows come once.  An empty table, or one without labels, gives a model that says
    ``und``.  More than ``most_langs`` labels are an error.  Other columns are not read.
    """
    draw = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = docs.where(F.col(lang_col).isNotNull() & ~is_held_out(id_col) & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).withColumn("draw", draw)
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).limit(most_langs + 1).collect()
    if not counts:
        return fit([], [])
    if len(counts) > most_langs:
        raise ValueError(f"more than {most_langs} labels")
    per = min(per_lang, most_rows / len(counts))
    chars = int(most_chars / sum(max(1, min(per, r["n"])) for r in counts))
    bounds = docs.sparkSession.createDataFrame(
        [(r["lang"], max(per / r["n"], r["least"])) for r in counts], "lang string, bound double")
    at = F.pmod(F.xxhash64("id", F.lit(4)), F.greatest(F.char_length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    sample = rows.join(F.broadcast(bounds), "lang").where("draw <= bound").select(  # most_langs short rows
        "lang", (F.col("draw") / F.col("bound")).alias("order"), F.substring("text", at, F.lit(chars)).alias("text")).distinct()
    got = sample.orderBy("order", "lang", "text").limit(2 * most_rows + most_langs).select("text", "lang").toPandas()
    return fit(got["text"].tolist(), got["lang"].tolist())


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected.

    The whole text counts.  Null texts and texts without a letter are ``und``
    with score 0, and rejected, as is any score under the calibrated bound.
    Columns of ``docs`` with one of the three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes a bucket and language

    @arrow_udf("struct<lang:string,score:double>")
    def of(col: pa.Array) -> pa.Array:
        m = shared.value
        found = [m.predict(t.as_py()) for t in col]
        release()
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()),
                                           pa.array([f[1] for f in found], pa.float64())], ["lang", "score"])

    p = fresh(docs, "p")[0]
    out = docs.withColumn(p, of(F.col(text_col)))
    return out.select(*[c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")],
                      F.col(f"{p}.lang").alias("lang_pred"), F.col(f"{p}.score").alias("score"),
                      ((F.col(f"{p}.lang") == "und") | (F.col(f"{p}.score") < model.reject)).alias("rejected"))
