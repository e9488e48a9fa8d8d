"""Language identification: pluggable models and the voter over three of them.

A model is a function from a text column to a column struct<labels: array<string>, confidences: array<double>>. External
models are loaded once in each Python worker from a file that the cluster ships; where a file or its library is
missing, predictions are null. NaiveBayes is a model trained here, as a stand-in.
"""

from __future__ import annotations

import importlib.util
import os
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textloom.functions import langid as L
from textloom.sources.shared import python_batches

Model = Callable[[Column], Column]
RAW = "struct<labels:array<string>,confidences:array<double>>"


def fasttext_model(path: str, k: int = 3) -> Model:
    """A model file of the fastText library; line breaks are replaced, as it rejects them."""
    loaded: dict = {}

    @F.pandas_udf("labels array<string>, confidences array<double>")
    def predict(texts):
        import pandas as pd

        if "m" not in loaded:
            loaded["m"] = None
            if importlib.util.find_spec("fasttext") and os.path.exists(path):
                import fasttext

                loaded["m"] = fasttext.load_model(path)
        m = loaded["m"]
        rows = [(None, None) if m is None or t is None else tuple(map(list, m.predict(t.replace("\n", " "), k=k))) for t in texts]
        return pd.DataFrame(rows, columns=["labels", "confidences"])

    return lambda text: predict(text)


def absent_model() -> Model:
    """A model that isn't there: null predictions."""
    return lambda text: F.lit(None).cast(RAW)


#: Distinct beginnings that a task counts before it passes them on.
HELD = 200_000


def beginning_counts(docs: DataFrame, n: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, f, c): how often tokens begin with f, their first n letters, in texts of each language. A task passes its sums
    on, so that what is shuffled grows with the vocabulary."""
    python_batches(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    kind = to_arrow_type(rows.schema["lang"].dataType)

    def run(batches):
        from textloom.functions import kernels

        sums: Counter = Counter()

        def taken() -> pa.RecordBatch:
            own = [*zip(*sums, strict=True)] or [(), ()]
            out = pa.RecordBatch.from_arrays([pa.array(own[0], kind), pa.array(own[1], pa.string()), pa.array(sums.values(), pa.int64())], ["lang", "f", "c"])
            sums.clear()
            return out

        for b in batches:
            langs = b.column("lang").dictionary_encode()
            names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            for i, j, found, at, edge in kernels.heads(b.column("text").to_pylist(), n):
                d = len(found)
                counts = np.bincount(np.repeat(lang[i:j].astype(np.int64), np.diff(edge)) * d + at, minlength=1)
                for k in np.flatnonzero(counts).tolist():
                    sums[names[k // d], found[k % d]] += int(counts[k])
                if len(sums) > HELD:
                    yield taken()
        yield taken()

    return rows.mapInArrow(run, f"lang {rows.schema['lang'].dataType.simpleString()}, f string, c long").groupBy("lang", "f").agg(F.sum("c").alias("c"))


class NaiveBayes:
    """Naive Bayes over word beginnings: features are the first n letters of tokens, which functions.kernels cuts.

    The table holds the log-likelihoods of at most `features` features a language and is sent with the function."""

    def __init__(self, table: dict[str, dict[str, float]], prior: dict[str, float], n: int):
        self.table, self.prior, self.n = table, prior, n

    @classmethod
    def train(cls, docs: DataFrame, lang_col: str = "lang", text_col: str = "text", n: int = 3, features: int = 300) -> NaiveBayes:
        return cls.train_all(docs, (n,), lang_col, text_col, features)[0]

    @classmethod
    def train_all(cls, docs: DataFrame, sizes: tuple[int, ...], lang_col: str = "lang", text_col: str = "text", features: int = 300) -> list[NaiveBayes]:
        """A model for each n of sizes, by one pass over the texts: shorter beginnings are counted from the longest."""
        import math

        from pyspark.sql.window import Window

        longest = beginning_counts(docs, max(sizes), lang_col, text_col)
        each = longest.select("lang", "f", "c", F.explode(F.array(*map(F.lit, sorted(set(sizes))))).alias("n"))
        counts = each.groupBy("n", "lang", F.substring("f", F.lit(1), F.col("n")).alias("f")).agg(F.sum("c").alias("c"))
        w = Window.partitionBy("n", "lang").orderBy(F.desc("c"), "f")
        found = counts.withColumn("r", F.row_number().over(w)).where(F.col("r") <= features).collect()

        def model(n: int) -> NaiveBayes:
            rows = [r for r in found if r.n == n]
            langs = sorted({r.lang for r in rows})
            total = {x: sum(r.c for r in rows if r.lang == x) for x in langs}
            names = sorted({r.f for r in rows})
            have = {(r.lang, r.f): r.c for r in rows}
            table = {x: {f: math.log((have.get((x, f), 0) + 0.5) / (total[x] + 0.5 * len(names))) for f in names} for x in langs}
            return cls(table, {x: 0.0 for x in langs}, n)

        return [model(n) for n in sizes]

    def __call__(self, text: Column) -> Column:
        return together([self])[0](text)


def together(models: list[NaiveBayes]) -> list[Model]:
    """The same models with one function that reads a text once for all of them."""
    longest, known = max(m.n for m in models), []
    for m in models:
        langs = sorted(m.table)
        names = list(m.table[langs[0]]) if langs else []
        scores = np.array([[m.table[x][f] for x in langs] for f in names], float).reshape(len(names), len(langs))
        known.append((m.n, langs, {f: k for k, f in enumerate(names)}, scores, np.array([m.prior[x] for x in langs])))

    @F.pandas_udf(f"struct<{','.join(f'm{k}:{RAW}' for k in range(len(models)))}>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        from textloom.functions import kernels

        rows: list[list] = [[] for _ in known]
        for i, j, found, at, edge in kernels.heads([t or "" for t in texts], longest):
            some, owner = np.diff(edge) > 0, np.repeat(np.arange(j - i), np.diff(edge))
            for (n, langs, place, scores, prior), out in zip(known, rows, strict=True):
                row = np.array([place.get(f[:n], -1) for f in found], np.int64)[at]
                hit = row >= 0
                own, first = np.unique(owner[hit], return_index=True)
                s = np.tile(prior, (j - i, 1))
                if len(own):
                    s[own] += np.add.reduceat(scores[row[hit]], first)
                if not langs:
                    out += [None] * (j - i)
                    continue
                e = np.exp(s - s.max(1, keepdims=True))
                e /= e.sum(1, keepdims=True)
                labels = [f"__label__{x}_Latn" for x in langs]
                out += [{"labels": labels, "confidences": c} if ok else None for ok, c in zip(some.tolist(), e.tolist(), strict=True)]
        return pd.DataFrame({f"m{k}": pd.Series(out, dtype=object) for k, out in enumerate(rows)})

    def model(k: int) -> Model:
        def of(text: Column) -> Column:
            python_batches(SparkSession.active())
            return predict(text)[f"m{k}"]

        return of

    return [model(k) for k in range(len(models))]


@dataclass
class LanguageIdentifier:
    """Three models and the macro-code map (a map column); a model that is None gives null predictions."""

    glotlid: Model | None = None
    fasttext: Model | None = None
    openlid: Model | None = None
    macro: Column | None = None

    def processed(self, raw: Column) -> Column:
        """A raw prediction column as (code, conf) by falling confidence."""
        macro = self.macro if self.macro is not None else F.lit(None).cast("map<string,string>")
        return F.when(raw.isNotNull(), L.process_predictions(raw["labels"], raw["confidences"], macro))

    def identify(self, docs: DataFrame, k: int = 3, raw_output: bool = False, text_col: str = "text") -> DataFrame:
        """docs with `prediction`: the vote (see functions.langid.vote), or with raw_output the three lists cut to k."""
        if k <= 0:
            raise ValueError("k must be positive")
        names = ("glotlid", "fasttext", "openlid")
        rows = docs.withColumns({f"__raw_{n}": (getattr(self, n) or absent_model())(F.col(text_col)) for n in names})
        rows = rows.withColumns({f"__{n}": self.processed(F.col(f"__raw_{n}")) for n in names}).drop(*(f"__raw_{n}" for n in names))
        lists = [F.col(f"__{n}") for n in names]
        if raw_output:
            out = F.struct(*(F.slice(c, 1, k).alias(n) for c, n in zip(lists, names, strict=True)))
        else:
            out = L.vote(*lists, k=k)
        return rows.withColumn("prediction", out).drop(*(f"__{n}" for n in names))
