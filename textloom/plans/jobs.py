"""Whole runs over folders, for spark-submit: python -m textloom.plans.jobs NAME DATA_DIR OUTPUT_DIR [--option value ...]

Each run reads DATA_DIR and writes new folders below OUTPUT_DIR; nothing is overwritten in place.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import dedup, metrics, urls, wordfreq
from textloom.sources import jsonl, sinks
from textloom.sources.shared import snapshot

STAMP = "%Y-%m-%d %H:%M:%S"


def timed(report: DataFrame, start: datetime) -> DataFrame:
    end = datetime.now()
    return report.withColumns({"start_time": F.lit(start.strftime(STAMP)), "end_time": F.lit(end.strftime(STAMP)), "duration_minutes": F.lit(round((end - start).total_seconds() / 60, 2))})


def corpora(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = jsonl.with_text(jsonl.read_corpora(spark, data_dir))
    return jsonl.assign_ids(docs)


def run_minhash(spark: SparkSession, data_dir: str, out: str, shingle_size: int = 5, similarity_threshold: float = 0.8, num_perm: int = 128, details: bool = False) -> None:
    """Near duplicates: signatures, LSH index, verified pairs, id map, flags and report; with details the
    corpora as read, each text's shingles and the pairs' texts too."""
    start = datetime.now()
    docs = snapshot(jsonl.init_flags(corpora(spark, data_dir)), "corpora")
    sets = snapshot(dedup.shingle_sets(docs, "id", size=shingle_size), "shingles")
    buckets = snapshot(dedup.minhash_index(sets, similarity_threshold, num_perm), "buckets")
    candidates = snapshot(dedup.lsh_candidates(buckets), "candidates")
    pairs = snapshot(dedup.verify(candidates, sets, similarity_threshold), "pairs")
    sinks.write_buckets(buckets, f"{out}/lsh")
    wide = dedup.expand(pairs, sets)
    sinks.write_jsonl(dedup.duplicate_map(wide), f"{out}/duplicates")
    if details:
        sinks.write_corpora(docs, f"{out}/snapshot")
        shingles = T.shingles(T.tokenize(T.canonicalize("text")), shingle_size)
        sinks.write_jsonl(docs.where("text <> ''").select("id", "text", shingles.alias("shingles")), f"{out}/shingles")
        sinks.write_pairs(dedup.duplicate_details(wide, docs, "id"), f"{out}/duplicate_details")
    sinks.write_corpora(dedup.annotate(docs, "id", dedup.near_duplicate_flags(docs, "id", pairs, sets)), f"{out}/corpora")
    sinks.write_report(timed(dedup.dedup_report(sets, candidates, pairs, similarity_threshold, num_perm, shingle_size), start), f"{out}/report")


def run_heuristics(spark: SparkSession, data_dir: str, out: str) -> None:
    """Quality metrics: enriched corpora and one report row for each corpus."""
    docs = corpora(spark, data_dir)
    found = snapshot(metrics.document_metrics(docs, ["id", "corpus"]), "metrics")
    enriched = docs.drop(*metrics.SENTENCE_METRICS).join(found.drop("n_sentences", "corpus"), "id", "left")
    sinks.write_corpora(enriched, f"{out}/processed")
    texts = jsonl.non_empty(docs).select("id")
    sinks.write_report(metrics.corpus_report(found.join(texts, "id", "left_semi"), "corpus"), f"{out}/doc_report")


def run_url_dedup(spark: SparkSession, data_dir: str, out: str, strict: bool = False) -> None:
    """Duplicate URLs: groups, other ids of each member, report."""
    start = datetime.now()
    docs = snapshot(corpora(spark, data_dir).select("id", "url"), "urls")
    found = urls.with_url(docs, "id", "url", strict)
    sinks.write_jsonl(urls.url_duplicate_ids(found), f"{out}/duplicate_ids")
    sinks.write_jsonl(urls.url_groups(found), f"{out}/duplicate_urls")
    sinks.write_report(timed(urls.url_report(docs, found), start), f"{out}/report")


def run_url_check(spark: SparkSession, data_dir: str, out: str) -> None:
    """Names of corpora in which a URL stands with several texts."""
    sinks.write_report(urls.corpora_to_ignore(jsonl.read_corpora(spark, data_dir), "corpus", "url"), f"{out}/url_dedup_ignore_corpora")


def run_word_frequency(spark: SparkSession, data_dir: str, out: str, k: int = 200) -> None:
    """The k most frequent tokens of all corpora."""
    sinks.write_report(wordfreq.top_words(jsonl.with_text(jsonl.read_corpora(spark, data_dir)), k), f"{out}/word_frequency")


RUNS = {"minhash": run_minhash, "heuristics": run_heuristics, "url_dedup": run_url_dedup, "url_check": run_url_check, "word_frequency": run_word_frequency}


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("name", choices=RUNS)
    p.add_argument("data_dir")
    p.add_argument("output_dir")
    p.add_argument("--shingle-size", type=int)
    p.add_argument("--similarity-threshold", type=float)
    p.add_argument("--num-perm", type=int)
    p.add_argument("--details", action="store_const", const=True)
    p.add_argument("--strict", action="store_const", const=True)
    p.add_argument("--k", type=int)
    a = vars(p.parse_args(args))
    name, data_dir, out = (a.pop(x) for x in ("name", "data_dir", "output_dir"))
    spark = SparkSession.builder.appName(f"textloom-{name}").getOrCreate()
    RUNS[name](spark, data_dir, out, **{k: v for k, v in a.items() if v is not None})


if __name__ == "__main__":
    main()
