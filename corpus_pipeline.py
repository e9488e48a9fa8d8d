"""The training-data pipeline: toxicity, line dedup, near duplicates, decontamination, mixing to target weights.

STAGES lists (name, function); each function takes (spark, docs, sf_dir). run() writes each stage's rows as Parquet in
the shared folder and rereads them as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from textloom.llm._common import discard, load, materialise
from textloom.llm.pipeline_stages import STAGES

#: The toxicity model and the banded alignment can't be expressed in SQL; tests/llm holds the stages' operators, not run() as a whole, against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(docs)  # what the stage before wrote; the input tables stay
        docs = out
    return docs
