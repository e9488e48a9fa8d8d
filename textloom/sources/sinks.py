"""Writers. Each writes a new folder; none overwrites what it reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = 1_000_000


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", max_rows: int = 0) -> None:
    """One JSON object a line, UTF-8; max_rows starts a new file after so many rows."""
    out = df.write.mode(mode)
    (out.option("maxRecordsPerFile", max_rows) if max_rows else out).json(path)


def write_corpora(docs: DataFrame, path: str, corpus_col: str = "corpus", fmt: str = "json", mode: str = "errorifexists") -> None:
    """Annotated documents by corpus: partitions are matched by equality, and helper columns are left out."""
    docs.drop(*(c for c in docs.columns if c.startswith("__"))).write.mode(mode).partitionBy(corpus_col).format(fmt).save(path)


def write_snapshot(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """A Parquet snapshot, read back."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_buckets(buckets: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The LSH index as a table partitioned by band."""
    buckets.write.mode(mode).partitionBy("band").parquet(path)


def write_pairs(details: DataFrame, path: str, batch: int = BATCH, mode: str = "errorifexists") -> None:
    """Duplicate pairs with their texts, at most batch rows a file."""
    write_jsonl(details, path, mode, batch)


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A report of few rows as one file."""
    report.coalesce(1).write.mode(mode).json(path)


def concat_lines(spark: SparkSession, source: str, path: str, mode: str = "overwrite") -> None:
    """All lines of all files of a folder, trimmed, without blank ones; mode="append" adds to an earlier result."""
    lines = spark.read.text(source).select(F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("value")).where("value <> ''")
    lines.write.mode(mode).text(path)
