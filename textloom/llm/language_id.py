"""Operator 8: language identification by rank-order profiles of character n-grams.

Letters are lower-cased, every other run of characters is one blank, and 1- to 3-grams are counted over the whole text.
A profile lists the most frequent n-grams by rank. A text's profile is compared with each language's by the out-of-place
distance: the sum of rank differences, and the greatest penalty for an n-gram that the language's profile lacks.

Profiles are fitted on about TRAIN_ROWS rows of each language, drawn by a hash; prediction reads every whole text, in
windows of WINDOW characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm._common import bounded_batches, load
from textloom.llm.toxicity import held_out

TRAIN_ROWS = 3_000
PROFILE = 400  # n-grams of a language's profile
TOP = 300  # n-grams of a text's profile
WINDOW = 1 << 18
NONE = "und"
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTER[0]


def _codes(a: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of a, in which blanks are 0; runs of blanks count as one."""
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != 0) | (a[:-1] != 0)
    a = a[keep].astype(np.uint64)
    bits = np.uint64(21)
    one = a[a != 0]
    two = (a[:-1] << bits) | a[1:]
    mid = a[1:-1] != 0
    three = ((a[:-2] << bits | a[1:-1]) << bits | a[2:])[mid]
    return np.concatenate([one, two, three])


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the text's n-grams. Windows are cut at blanks, so that no n-gram is cut."""
    table, codes, counts = letters(), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = 0
    while at < len(text):
        end = min(at + WINDOW, len(text))
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        cp = np.frombuffer(text[at:end].lower().encode("utf-32-le", "replace"), np.uint32)
        a = np.zeros(len(cp) + 2, np.uint32)
        a[1:-1] = np.where(table[cp], cp, 0)
        c, n = np.unique(_codes(a), return_counts=True)
        if len(codes):
            merged, back = np.unique(np.concatenate([codes, c]), return_inverse=True)
            n = np.bincount(back, np.concatenate([counts, n])).astype(np.int64)
            c = merged
        codes, counts, at = c, n, end
    keep = codes != 0
    return codes[keep], counts[keep]


def ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes in order; ties by code."""
    return codes[np.lexsort((codes, -counts))[:top]]


class Profiles:
    """Rank-order profiles by language, in the order of their names."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.langs = sorted(profiles)
        self.sorted, self.rank = [], []
        for name in self.langs:
            order = np.argsort(profiles[name], kind="stable")
            self.sorted.append(profiles[name][order])
            self.rank.append(order)

    def distances(self, own: np.ndarray) -> np.ndarray:
        place = np.arange(len(own))
        out = np.zeros(len(self.langs), np.int64)
        for k, (codes, rank) in enumerate(zip(self.sorted, self.rank, strict=True)):
            i = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            hit = codes[i] == own
            out[k] = np.where(hit, np.abs(rank[i] - place), PROFILE).sum()
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, confidence): the least distance, ties to the first name; confidence is the lead over the next."""
        codes, counts = gram_counts(text or "")
        if not len(codes) or not self.langs:
            return NONE, 0.0
        d = self.distances(ranked(codes, counts, TOP))
        k = int(d.argmin())
        rest = np.delete(d, k)
        best = float(d[k])
        nearest = float(rest.min()) if len(rest) else float(PROFILE * min(TOP, len(codes)))
        return self.langs[k], min(1.0, max(0.0, 1.0 - best / nearest)) if nearest else 0.0


def fit(docs: DataFrame, use: Column, per_lang: int = TRAIN_ROWS) -> Profiles:
    """Profiles of every non-null lang among rows of docs with use true; about per_lang rows each, drawn by hash."""
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & use)
    share = rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(per_lang)) / F.count("*")).alias("share"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) < F.col("share") * F.lit(float(1 << 30))
    rows = rows.join(F.broadcast(share), "lang").where(drawn).select("lang", "text")  # one row for each language is broadcast

    def count(batches):
        for batch in batches:
            by: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                by.setdefault(lang, []).append(text.as_py())
            for lang, texts in by.items():
                codes, counts = gram_counts("\n".join(texts))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts, pa.int64())], ["lang", "code", "n"])

    counts = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("r") <= PROFILE)
    found: dict[str, list] = {}
    for r in best.orderBy("lang", "r").collect():  # at most PROFILE rows a language
        found.setdefault(r.lang, []).append(r.code)
    return Profiles({k: np.array(v, np.int64).astype(np.uint64) for k, v in found.items()})


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred string, score double 0..1) of each row. A null text, one without letters, and any text if nothing was
    learned give `und` with score 0; null and repeated ids are kept; an empty table gives no rows; other columns are ignored."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        for batch in batches:
            found = [held.value.predict(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [id_col, "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` long, lang_pred string, score double")


FOLD = (4, 2)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    out = identify(docs, fit(docs, ~held_out(F.col("doc_id"), *FOLD)))
    return out.select("doc_id", held_out(F.col("doc_id"), *FOLD).alias("held_out"), "lang_pred", "score")
