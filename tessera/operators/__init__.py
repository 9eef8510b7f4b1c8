"""Operators: DataFrame -> DataFrame functions, one module per analysis family."""
from . import relational, weblog, wordcount, linkage, ratings, regression, linear, ctr, pca

__all__ = ["relational", "weblog", "wordcount", "linkage", "ratings", "regression", "linear",
           "ctr", "pca"]
