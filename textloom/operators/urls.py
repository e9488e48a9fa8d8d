"""Duplicate URLs within and across corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T


def with_url(docs: DataFrame, id_col: str, url_col: str, strict: bool = False, ignore: DataFrame | None = None, corpus_col: str | None = None) -> DataFrame:
    """(id, nurl) of documents with a valid URL; strict raises on an invalid one. ignore: (corpus) names to leave out."""
    if ignore is not None:
        docs = docs.join(ignore.select(F.col("corpus").alias(corpus_col)), corpus_col, "left_anti")
    return docs.select(F.col(id_col).alias("id"), T.normalize_url(url_col, strict).alias("nurl")).where("nurl is not null and id is not null")


def url_groups(urls: DataFrame) -> DataFrame:
    """(nurl, ids sorted, n) of URLs that several rows have; equal ids count each."""
    return urls.groupBy("nurl").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.count("*").alias("n")).where("n > 1")


def url_duplicate_ids(urls: DataFrame) -> DataFrame:
    """(id, others): the other ids of each member's group, sorted; rows of equal id don't name each other."""
    rows = url_groups(urls).select(F.explode("ids").alias("id"), "ids")
    return rows.select("id", F.filter("ids", lambda x: x != F.col("id")).alias("others"))


def url_report(docs: DataFrame, urls: DataFrame) -> DataFrame:
    """One row: total_docs before validation, total_unique_urls, duplicate_groups, total_duplicate_documents, method."""
    groups = urls.groupBy("nurl").agg(F.count("*").alias("n"))
    sums = groups.agg(F.count("*").alias("total_unique_urls"), F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("total_duplicate_documents"))
    return docs.agg(F.count("*").alias("total_docs")).crossJoin(sums).withColumn("method", F.lit("url"))  # one row each


def conflicting_urls(docs: DataFrame, corpus_col: str, url_col: str, text_col: str = "text") -> DataFrame:
    """(corpus, n): raw URLs of a corpus that stand with more than one distinct text; corpora without any are left out."""
    url, text = F.col(url_col), F.col(text_col)
    rows = docs.where((url != "") & (text != "") & ~F.lower(url).isin(*T.NO_URL)).groupBy(corpus_col, url_col).agg(F.countDistinct(text).alias("texts")).where("texts > 1")
    return rows.groupBy(F.col(corpus_col).alias("corpus")).agg(F.count("*").alias("n"))


def corpora_to_ignore(docs: DataFrame, corpus_col: str, url_col: str, text_col: str = "text") -> DataFrame:
    """Names of corpora with conflicting URLs."""
    return conflicting_urls(docs, corpus_col, url_col, text_col).select("corpus")
