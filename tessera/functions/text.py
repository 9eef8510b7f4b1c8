"""String cleaning and tokenizing as native column expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# The English stop-word set used by the tokenizer (the classic
# short list of articles, conjunctions, prepositions and auxiliaries).
STOPWORDS = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Remove ASCII punctuation, trim spaces, lower-case."""
    return F.lower(F.trim(F.regexp_replace(_c(c), r"\p{Punct}", "")))


def split_words(c) -> Column:
    """Split a cleaned line on single spaces, dropping empty strings."""
    return F.array_remove(F.split(_c(c), " "), "")


def simple_tokenize(c) -> Column:
    """Lower-case, split on runs of non-word characters, drop empties (duplicates kept)."""
    return F.array_remove(F.split(F.lower(_c(c)), r"\W+"), "")


def stopword_array() -> Column:
    return F.array(*[F.lit(w) for w in STOPWORDS])


def remove_stopwords(tokens) -> Column:
    """Drop stop words from a token array, keeping duplicates and order
    (``array_except`` would de-duplicate)."""
    stops = stopword_array()
    return F.filter(_c(tokens), lambda t: ~F.array_contains(stops, t))


def tokenize(c) -> Column:
    """``simple_tokenize`` without stop words, in one filter over a hash set."""
    words = F.split(F.regexp_replace(F.lower(_c(c)), r"\W+", " "), " ")
    return F.filter(words, lambda t: ~t.isin("", *STOPWORDS))


def pluralize(c) -> Column:
    return F.concat(_c(c), F.lit("s"))


def lines(c) -> Column:
    """Split a multi-line text into its lines (what ``read.text`` would produce)."""
    return F.split(_c(c), r"\r?\n|\r")
