"""Word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T


def word_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, n) over all documents."""
    return docs.select(F.explode_outer(T.tokenize(text_col)).alias("token")).where("token is not null").groupBy("token").agg(F.count("*").alias("n"))


def top_words(docs: DataFrame, k: int = 200, text_col: str = "text") -> DataFrame:
    """The k most frequent tokens; ties by token."""
    return word_frequencies(docs, text_col).orderBy(F.desc("n"), "token").limit(k)
