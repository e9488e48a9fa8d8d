"""The stages of the training-data pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import decontaminate, line_dedup, mixing, ngram_join, toxicity
from textloom.llm._common import BROADCAST_IDS, free_name, load, materialise


def toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the model, fitted on all labelled documents' folds but the held-out one, rejects go.
    Null texts are scored as empty ones, which no model rejects; rows without an id are scored but never learned from."""
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id"), *toxicity.FOLD))
    return toxicity.drop_toxic(docs, model)


def lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: recurring lines go, and with them documents that held nothing else; n_chars, if there is such a column,
    is counted anew where lines went. Null and empty texts stay as they are; equal rows are treated alike."""
    n = free_name(docs, "n_dropped")
    out = line_dedup.drop_recurring_lines(docs, dropped_col=n)
    out = out.where((F.col(n) == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(n) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each component of linked documents the one of smallest doc_id stays. Rows without an id stay, as do
    all rows that share the id that stays; documents without words are linked with nothing and stay."""
    found = materialise(ngram_join.ngram_jaccard_join(docs), "near")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(side, "doc_id", "left_anti").select(*docs.columns)


def leaks(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a passage of the benchmark go. Null and empty texts stay; equal rows share a fate."""
    return decontaminate.drop_leaks(docs, load(spark, sf_dir, "benchmark"))


def mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: sources are mixed to the square root of their sizes and shuffled; copy numbers a row's copies from 1
    (_copy where documents have a column of that name). Null sources are one source, nulls elsewhere stay."""
    out = mixing.mix_sources(docs, copy_col="copy", order_col="shuffle_key")
    return out.drop(out.columns[-1])


STAGES = [("toxicity", toxic), ("line_dedup", lines), ("near_duplicates", near), ("decontamination", leaks), ("mixing", mix)]
