"""Operator 2: toxic passages by maximum-scoring segments over token log-odds.

A token's score is the log-odds of its feature (the word, or else its longest telling beginning of PREFIXES letters)
between toxic and other labelled texts, smoothed by a Dirichlet prior of PRIOR texts that is shaped by the feature's own
overall rate. Scores have both signs: of M features those count whose log-likelihood ratio G2 is 2 ln M + 2 or more (less
than one by chance), whichever class they speak for; any other token has the slightly negative score REST. Scores are
shifted, if need be, so that a token of clean texts is expected to score REST at most.

The linear-time scan of Ruzzo and Tompa finds all maximal scoring segments. Their scores are calibrated as extreme values
by Karlin and Altschul: lambda solves E exp(lambda s) = 1 over the tokens of clean texts, and K is such that clean texts of
n tokens have K n exp(-x) segments of lambda S >= x. Segments of lambda S >= LEAST are aggregated: the r best of them have
T = sum(lambda S - ln(1 + K n)) and the significance exp(-T) T^(r-1) / (r! (r-1)!). A text's evidence is the greatest
-ln of it over r, and 0 without such a segment; a logistic curve turns it into a probability.

Fitting uses at most TRAIN_ROWS labelled rows of each class, those of least hash, and of near copies among them one
row; everything else reads all rows. A learning row is scored for calibration by odds that leave its own counts out, so no other rows are needed for it.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import bounded_batches, discard, load, materialise, mix64, strings
from textloom.llm.shingles import shingle_sets

TRAIN_ROWS = 8_000
PREFIXES = (6, 5, 4)
PRIOR = 30.0
REST = -0.05
LEAST = 2.0  # lambda S of a segment that counts
SIGNIFICANT = 2.0  # lambda S - ln(1 + K n) of a passage
WORD = re.compile(r"[^\W\d_]+")
CACHE = 150_000
SKETCHES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def held_out(id_col: Column, fold: int, remainder: int) -> Column:
    """crc32 of the id as text falls on the held-out remainder."""
    return F.crc32(id_col.cast("long").cast("string").cast("binary")) % fold == remainder


def features(token: str) -> list[str]:
    return [token, *(f"{token[:k]}*" for k in PREFIXES if len(token) > k)]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score), left to right, in linear time."""
    found: list[tuple[int, int, float, float]] = []  # start, end, total before start, total at end
    total = 0.0
    for i, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        start, left, right = i, before, total
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= left:
                k -= 1
            if k < 0 or found[k][3] >= right:
                break
            start, left = found[k][0], found[k][2]
            del found[k:]
        found.append((start, i + 1, left, right))
    return [(a, b, r - left) for a, b, left, r in found]


class Model:
    """Scores of telling features, lambda and K, and the logistic curve over the evidence."""

    def __init__(self, scores: dict[str, float], shift: float = 0.0, lam: float = 1.0, k: float = 1.0, slope: float = 1.0, offset: float = -20.0):
        self.scores, self.rest, self.lam, self.k, self.slope, self.offset = {f: x - shift for f, x in scores.items()}, REST - shift, lam, k, slope, offset
        self._cache: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_cache": {}}

    def token(self, t: str) -> float:
        s = self._cache.get(t)
        if s is None:
            s = next((self.scores[f] for f in features(t) if f in self.scores), self.rest)
            if len(self._cache) >= CACHE:
                self._cache.clear()
            self._cache[t] = s
        return s

    def segments(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """(maximal segments as token ranges with lambda times their scores, number of tokens); runs of tokens that tell
        nothing are one gap."""
        tokens = WORD.findall((text or "").lower())
        get, seen, token, rest = self._cache.get, [], self.token, self.rest
        for i, t in enumerate(tokens):
            s = get(t)
            if s is None:
                s = token(t)
            if s != rest:
                seen.append((i, s))
        scores, place, last = [], [], -1
        for i, s in seen:
            if i - last > 1 and last >= 0:
                scores.append(rest * (i - last - 1))
                place.append(last + 1)
            scores.append(s)
            place.append(i)
            last = i
        return [(place[a], place[b - 1] + 1, self.lam * s) for a, b, s in maximal_segments(scores)], len(tokens)

    def aggregated(self, values: list[float], n: int) -> float:
        """The evidence of a text of n tokens whose segments have these lambda S; 0 is the least."""
        level = math.log(1 + self.k * n)
        best = total = 0.0
        for r, x in enumerate(sorted((v - level for v in values if v >= LEAST and v > level), reverse=True), 1):
            total += x
            best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r) if total >= r else 0.0)
        return best

    def evidence(self, text: str | None) -> tuple[float, int]:
        """(evidence of the text, number of its toxic passages)."""
        found, n = self.segments(text)
        level = math.log(1 + self.k * n)
        return self.aggregated([s for *_, s in found], n), sum(s - level >= SIGNIFICANT for *_, s in found)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * evidence + self.offset))))

    def passages(self, text: str | None) -> list[tuple[int, int, float]]:
        """Significant toxic passages as (start, end exclusive, lambda S - ln(1 + K n)) in code points of the text."""
        found, n = self.segments(text)
        level = math.log(1 + self.k * n)
        spans = [m.span() for m in WORD.finditer(text or "")]
        if len(spans) != n:  # lower-casing changed the number of letters
            spans = [m.span() for m in WORD.finditer((text or "").lower())]
        return [(spans[a][0], spans[b - 1][1], s - level) for a, b, s in found if s - level >= SIGNIFICANT]


def log_odds(pos: int, neg: int, n1: int, n0: int, least: float) -> float | None:
    """The smoothed log-odds of a feature in pos of n1 toxic and neg of n0 other texts; None if its G2 is under least."""
    c, n = pos + neg, n1 + n0
    if c < 1:
        return None
    g2 = 2 * sum(x * math.log(x * n / (c * m)) for x, m in ((pos, n1), (neg, n0)) if x)
    p1, p0 = (pos + PRIOR * c / n) / (n1 + PRIOR), (neg + PRIOR * c / n) / (n0 + PRIOR)
    return math.log(p1 / (1 - min(p1, 0.999))) - math.log(p0 / (1 - min(p0, 0.999))) if g2 >= least else None


def karlin_lambda(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of sum(p exp(lambda s)) = 1, of at most 1; 1 where no score is positive."""
    if not (scores > 0).any():
        return 1.0
    lo, hi = 1e-3, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (counts * np.exp(np.minimum(mid * scores, 700))).sum() <= counts.sum() else (lo, mid)
    return lo


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0.01) and offset by Newton's method with a light ridge; targets are smoothed as for small samples."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 0.5, math.log((pos + 1) / (neg + 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - t) * x).sum() + 1e-3 * a, (p - t).sum() + 1e-3 * b])
        v = p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-3]])
        d = np.linalg.solve(h, g)
        d *= min(1.0, 2.0 / max(1e-9, float(np.abs(d).max())))
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-7:
            break
    return max(0.01, float(a)), float(b)


def training_rows(docs: DataFrame, labels: DataFrame, use: Column, per_class: int = TRAIN_ROWS) -> DataFrame:
    """Distinct (text, y) of at most per_class labelled rows of each class with use true, by least hash of the id."""
    labels = labels.where(F.col("toxic").isin(0, 1) & use).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    picked = None
    for y in (0, 1):
        part = labels.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.union(part)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id").select("text", "y").dropDuplicates()


def unlike(rows: DataFrame) -> DataFrame:
    """One of each group of near copies among a bounded number of rows (text, y): of rows of a class that share the least
    hash of their word 3-grams, by one of three orders, one stays. Copies aren't independent evidence for a word."""

    def sketch(batches):
        for batch in batches:
            raw, offsets = strings(batch.column(0))
            sets = [s if len(s) else np.zeros(1, np.uint64) for s in shingle_sets(raw, offsets, 3)]
            least = [pa.array([int(mix64(s ^ np.uint64(k)).min().astype(np.int64)) for s in sets], pa.int64()) for k in SKETCHES]
            yield pa.RecordBatch.from_arrays([*batch.columns, *least], ["text", "y", "m0", "m1", "m2"])

    rows = rows.mapInArrow(sketch, "text string, y int, m0 long, m1 long, m2 long")
    for m in ("m0", "m1", "m2"):
        rows = rows.groupBy("y", m).agg(F.min(F.struct(*sorted({"m0", "m1", "m2"} - {m}), "text")).alias("x")).select("y", m, "x.*")
    return materialise(rows.select("text", "y"), "learning")


def fit(docs: DataFrame, labels: DataFrame, use: Column) -> Model:
    """A model from the labelled rows of docs with use true. Without rows of both classes, nothing is called toxic."""
    bounded_batches(docs.sparkSession)
    rows = unlike(training_rows(docs, labels, use))

    def count(batches):
        c: Counter = Counter()
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen = {f for t in set(WORD.findall((text.as_py() or "").lower())) for f in features(t)}
                c.update((f, y) for f in seen)
                c["", y] += 1
                if len(c) > CACHE:
                    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c]), pa.array([k[1] for k in c], pa.int32()), pa.array(list(c.values()), pa.int64())], ["f", "y", "n"])
                    c.clear()
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.string()), pa.array([k[1] for k in c], pa.int32()), pa.array(list(c.values()), pa.int64())], ["f", "y", "n"])

    counts = rows.mapInArrow(count, "f string, y int, n long").groupBy("f").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("neg"))
    total = counts.where("f = ''").first()
    n1, n0 = (total.pos, total.neg) if total else (0, 0)
    if not n1 or not n0:
        discard(rows)
        return Model({})
    counts = materialise(counts.where("f <> '' and pos + neg >= 3"), "features")
    least = 2 * math.log(max(2, counts.count())) + 2
    c = F.col("pos") + F.col("neg")
    g2 = sum(F.when(F.col(x) > 0, 2 * F.col(x) * F.log(F.col(x) * (n1 + n0) / (c * n))).otherwise(0.0) for x, n in (("pos", n1), ("neg", n0)))
    telling = counts.where(g2 >= least).collect()  # of a bounded sample of rows
    discard(counts)

    def odds(less1: int, less0: int) -> dict[str, float]:
        found = ((r.f, log_odds(max(0, r.pos - less1), max(0, r.neg - less0), n1 - less1, n0 - less0, least)) for r in telling)
        return {f: x for f, x in found if x is not None}

    without = {0: odds(0, 1), 1: odds(1, 0)}  # for texts of either class, whose own counts are left out
    raw = docs.sparkSession.sparkContext.broadcast(Model(without[0]))

    def histogram(batches):
        c: Counter = Counter()
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if not y:
                    c.update(map(raw.value.token, WORD.findall((text.as_py() or "").lower())))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.float64()), pa.array(list(c.values()), pa.int64())], ["s", "n"])

    seen = rows.mapInArrow(histogram, "s double, n long").groupBy("s").agg(F.sum("n").alias("n")).collect()  # as many as telling features
    s, n = (np.array([r[k] for r in seen], float) for k in ("s", "n"))
    shift = max(0.0, float((s * n).sum() / n.sum()) - REST) if len(s) else 0.0
    lam = karlin_lambda(s - shift, n) if len(s) else 1.0
    both = docs.sparkSession.sparkContext.broadcast({y: Model(x, shift, lam) for y, x in without.items()})

    def segments(batches):
        for batch in batches:
            ys = batch.column(1).to_pylist()
            found = [both.value[y].segments(t.as_py()) for t, y in zip(batch.column(0), ys, strict=True)]
            values = pa.array([[v for *_, v in f if v >= LEAST] for f, _ in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, pa.array([n for _, n in found], pa.int64()), pa.array(ys, pa.int32())], ["v", "n", "y"])

    found = rows.mapInArrow(segments, "v array<double>, n long, y int").collect()  # at most 2 TRAIN_ROWS, more only if labelled ids repeat
    discard(rows)
    clean = [r for r in found if not r.y]
    k = (sum(len(r.v) for r in clean) + 0.5) * math.exp(LEAST) / max(1, sum(r.n for r in clean))
    model = Model(odds(0, 0), shift, lam, k)
    model.slope, model.offset = logistic(np.array([model.aggregated(r.v, r.n) for r in found]), np.array([r.y for r in found]))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score double, predicted int, n_passages int) of each row. Null texts are scored as empty texts; rows with a
    null or repeated id are kept; an empty table gives no rows; other columns are ignored."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            found = [m.evidence(t.as_py()) for t in batch.column(1)]
            p = [m.probability(x) for x, _ in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array([int(x >= 0.5) for x in p], pa.int32()), pa.array([k for _, k in found], pa.int32())], [id_col, "score", "predicted", "n_passages"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` long, score double, predicted int, n_passages int")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs without the rows that the model calls toxic; all columns stay as they are."""
    bounded_batches(docs.sparkSession)
    held, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        m = held.value
        for batch in batches:
            yield batch.filter(pa.array([m.probability(m.evidence(t.as_py())[0]) < 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


FOLD = (5, 0)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = fit(docs, labels, ~held_out(F.col("doc_id"), *FOLD))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id"), *FOLD).alias("held_out"), "score", "predicted", "n_passages")
