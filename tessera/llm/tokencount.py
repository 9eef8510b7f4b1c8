"""Token counts of whole texts by Arrow functions that return lengths only."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .common import fresh
from .tokens import ByteLevel, Pieces

_loaded: dict[str, ByteLevel | Pieces] = {}


def vocabulary(path: str) -> ByteLevel | Pieces:
    """The tokenizer of a file, loaded once a worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path) if path.endswith(".model") else ByteLevel(path)
    return _loaded[path]


def token_count(text, path: str, batch_bytes: int = 4 << 20):
    """Column: number of tokens of whole texts (null: 0) as the library gives
    them for the file at ``path`` (``.json``: tokenizers, ``.model``:
    sentencepiece), without added special tokens.

    An Arrow batch is worked off in slices of about ``batch_bytes`` bytes; a
    longer text is a slice of its own.  Texts are cut at safe boundaries, and
    only parts not met before go to the library, in batches balanced by bytes.
    """
    @arrow_udf("long")
    def count(col: pa.Array) -> pa.Array:
        tok = vocabulary(path)
        out: list[int] = []
        batch, size = [], 0

        def done():
            out.extend(tok.counts(batch) if isinstance(tok, Pieces) else map(tok.count, batch))

        for t in col:
            t = t.as_py() or ""
            batch.append(t)
            size += len(t)
            if size >= batch_bytes:
                done()
                batch, size = [], 0
        done()
        return pa.array(out, pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    Null and empty texts have none of either.  Rows are neither merged nor
    ordered: repeated rows each keep theirs, an empty table stays empty.  Columns
    of ``docs`` that bear one of the three names are replaced.
    """
    n = fresh(docs, "n")[0]
    out = docs.withColumn(n, token_count(F.col(text_col), path))
    return out.select(
        *[c for c in docs.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")],
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(n).alias("n_tokens"), (F.col(n) > limit).alias("over_limit"))
