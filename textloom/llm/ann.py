"""Operator 10: nearest neighbours by stable projections and a kd-tree, with a chi-square stopping test.

Largest inner product becomes least distance by one more coordinate: candidates x are extended by sqrt(M^2 - |x|^2),
queries by 0, with M the greatest norm. Extended vectors are projected by a Gaussian matrix of DIMS columns, which is
2-stable: the squared distance of the projections over the squared true distance is chi-square with DIMS degrees of
freedom. The upper levels of one kd-tree over the projections deal candidates into cells; a cell's vectors lie in shards
of about SHARD, each with its own lower levels. A query takes leaves in the order of their distance in the projection and
verifies their vectors by the true inner product, until a point as near as its present K-th one would, with probability
SURE, already have come up. First it searches its nearest cell only; its K-th score there then tells, by the same test,
which other cells it has to visit, so that a query is sent to those alone.

The upper splits are fitted on SAMPLE vectors of least hash; every vector is indexed, and the cells' boxes and counts,
which the test uses, are computed over all of them. A cell of very many vectors, such as copies of one, gets more shards.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm._common import bounded_batches, load, materialise

K = 20
DIMS = 8
SURE = 0.97
SHARD = 8192
LEAF = 128
QUERY_BLOCK = 4096
SAMPLE = 20_000
CELLS = 1024  # at most; beyond, cells get more shards
SEED = 5


def chi_square_quantile(p: float, dims: int) -> float:
    """x with P(chi-square of dims degrees <= x) = p, by bisection over the series of the incomplete gamma function."""

    def cdf(x: float) -> float:
        a, z = dims / 2, x / 2
        term = total = 1 / a
        for n in range(1, 2000):
            term *= z / (a + n)
            total += term
            if term < total * 1e-15:
                break
        return total * math.exp(-z + a * math.log(z) - math.lgamma(a)) if z > 0 else 0.0

    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def projection(size: int, dims: int = DIMS) -> np.ndarray:
    """The Gaussian matrix of extended vectors: the same in every worker."""
    return np.random.default_rng(SEED).standard_normal((size + 1, dims))


def projected(vectors: np.ndarray, norm: float, dims: int = DIMS) -> np.ndarray:
    """Projections of candidates, extended to length norm."""
    m = projection(vectors.shape[1], dims)
    rest = np.sqrt(np.maximum(0.0, norm * norm - np.einsum("ij,ij->i", vectors, vectors)))
    return vectors @ m[:-1] + rest[:, None] * m[-1]


def box_distance(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance from each point to each box."""
    out = np.zeros((len(at), len(low)))
    for j in range(at.shape[1]):
        out += np.maximum(0.0, np.maximum(low[:, j] - at[:, j : j + 1], at[:, j : j + 1] - high[:, j])) ** 2
    return out


class Cells:
    """The upper levels of the kd-tree: median splits of a sample, as (axis, value, left, right); leaves are numbers."""

    def __init__(self, points: np.ndarray, cells: int):
        self.n, self.root = 0, None
        self.root = self._split(points, cells)

    def _split(self, points: np.ndarray, cells: int):
        if cells <= 1 or len(points) < 2 or np.ptp(points, axis=0).max() == 0:
            self.n += 1
            return self.n - 1
        axis = int(np.ptp(points, axis=0).argmax())
        value = float(np.median(points[:, axis]))
        left = points[:, axis] <= value
        if left.all():
            left = points[:, axis] < value
            value = float(points[left, axis].max())
        return axis, value, self._split(points[left], cells - cells // 2), self._split(points[~left], cells // 2)

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if isinstance(node, int):
                out[rows] = node
            else:
                left = points[rows, node[0]] <= node[1]
                todo += [(node[2], rows[left]), (node[3], rows[~left])]
        return out


class ShardTree:
    """A kd-tree over the projections of a shard's vectors; leaves of about LEAF points with their boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, unit: int = 0, dims: int = DIMS):
        order = np.argsort(ids, kind="stable")
        ids, self.whole = ids[order], vectors[order]
        vectors = scaled(self.whole, unit)[0]
        self.matrix = projection(vectors.shape[1], dims)
        self.norm2 = norm * norm
        points = projected(vectors, norm, dims)
        leaves: list[np.ndarray] = []
        todo = [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                leaves.append(np.sort(rows))
                continue
            own = points[rows]
            axis = int(np.ptp(own, axis=0).argmax())
            split = np.argsort(own[:, axis], kind="stable")
            todo += [rows[split[len(rows) // 2 :]], rows[split[: len(rows) // 2]]]
        self.ids, self.vectors, self.leaves = ids, vectors, leaves
        self.low = np.array([points[r].min(axis=0) for r in leaves])
        self.high = np.array([points[r].max(axis=0) for r in leaves])

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, sure: float, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(rows of the shard, scores) of shape (queries, k), best first, ties to the smaller id; missing ones have row -1.
        floor: each query's K-th score so far. Matrix products only tell which candidates may be among the best, with a
        margin for their rounding; these are ordered by sums from the first component to the last, so copies tie."""
        n = len(ids)
        at = queries @ self.matrix[:-1]
        near = box_distance(at, self.low, self.high)
        order = np.argsort(near, axis=1, kind="stable")
        best = np.full((n, k), -np.inf)
        who = np.full((n, k), -1, np.int64)
        length2 = np.einsum("ij,ij->i", queries, queries)
        margin = 1e-13 * queries.shape[1] * np.sqrt(length2 * self.norm2)
        stop = chi_square_quantile(sure, at.shape[1])
        live = np.arange(n)
        for step in range(len(self.leaves)):
            leaf = order[live, step]
            # true squared distance of the K-th so far; a nearer point would project within stop times that, if SURE holds
            known = best[live, -1] if floor is None else np.maximum(best[live, -1], floor[live])
            kth = length2[live] + self.norm2 - 2 * known
            go = near[live, leaf] <= stop * np.maximum(kth, 0.0)
            live, leaf = live[go], leaf[go]
            if not len(live):
                break
            for x in np.unique(leaf):
                q, cand = live[leaf == x], self.leaves[x]
                score = queries[q] @ self.vectors[cand].T
                score[ids[q][:, None] == self.ids[cand][None, :]] = -np.inf
                may = score >= (best[q, -1] - margin[q])[:, None]
                may &= ~np.isneginf(score)
                better = may.any(axis=1)
                q, may = q[better], may[better]
                score = np.full(may.shape, -np.inf)
                a, b = np.nonzero(may)
                for s in range(0, len(a), 1 << 16):
                    i, j = a[s : s + (1 << 16)], b[s : s + (1 << 16)]
                    score[i, j] = np.cumsum(queries[q[i]] * self.vectors[cand[j]], axis=1)[:, -1]
                all_s = np.concatenate([best[q], score], axis=1)
                all_i = np.concatenate([who[q], np.broadcast_to(cand, score.shape)], axis=1)
                pick = np.lexsort((all_i, -all_s), axis=1)[:, :k]
                best[q] = np.take_along_axis(all_s, pick, axis=1)
                who[q] = np.where(np.isneginf(best[q]), -1, np.take_along_axis(all_i, pick, axis=1))
        return who, best

    def exact(self, queries: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Inner products of queries and their found rows, summed from the first component to the last."""
        return np.stack([np.cumsum(queries * self.whole[w], axis=1)[:, -1] for w in np.maximum(who, 0).T], axis=1)


def vectors_of(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>, most) of the vectors that take part: not null, not zero, all components finite; most is the
    greatest absolute component."""
    v = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(fine & F.exists("v", lambda x: x != 0))
    return rows.withColumn("most", F.array_max(F.transform("v", F.abs)))


def nearest(base: DataFrame, queries: DataFrame, k: int = K, sure: float = SURE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank int, vec_id, score double): the k candidates of largest inner product found for each query, nearest
    first, ties to the smaller id. A query's own id is no candidate. Vectors null, zero or with null or non-finite
    components take no part; of rows with equal ids each counts; vectors of each length are searched among themselves, as
    only these have an inner product; empty tables give no rows; other columns are ignored. Squares are taken of vectors
    scaled by a power of two, so that no finite vector is too short or too long."""
    spark = base.sparkSession
    bounded_batches(spark)
    base = materialise(vectors_of(base, id_col, vec_col), "vectors")
    queries = vectors_of(queries, id_col, vec_col)
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for r in base.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max("most").alias("most")).orderBy("d").collect():  # a row for each length
        some = (x.where(F.size("v") == r.d).select("id", "v") for x in (base, queries))
        out = out.union(_nearest(*some, r.d, r.n, r.most, k, sure))
    return out


def scaled(v: np.ndarray, exponent: int | None = None) -> tuple[np.ndarray, np.ndarray | int]:
    """(v over 2 ** exponent, exponent); by default each row has its own, by which its greatest component is under 1."""
    if exponent is None:
        e = np.frexp(np.abs(v).max(axis=1, initial=0.0))[1]
        return np.ldexp(v, -e[:, None]), e
    return np.ldexp(v, -exponent), exponent


def _nearest(base: DataFrame, queries: DataFrame, dims: int, n: int, most: float, k: int, sure: float) -> DataFrame:
    """nearest() of rows (id, v) whose vectors all have dims components, in base of most at most. The index holds vectors
    over one power of two, and each query is searched for over its own, which leaves its order of nearness as it is."""
    part, unit = math.frexp(most)
    longest = base.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.lit(most)) * (x / F.lit(most))))).first()[0]
    norm = math.sqrt(longest) * part
    sample = np.array([r.v for r in base.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(max(1000, min(SAMPLE, 2_000_000 // dims))).select("v").collect()])
    cells = Cells(projected(scaled(sample, unit)[0], norm), min(CELLS, max(1, round(n / SHARD)), max(1, len(sample) // 16)))

    def assign(batches):
        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(-1, dims)
            p = projected(scaled(v, unit)[0], norm)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells.of(p)), *(pa.array(p[:, j]) for j in range(DIMS))], ["id", "v", "cell", *(f"p{j}" for j in range(DIMS))])

    axes = [f"p{j}" for j in range(DIMS)]
    base = materialise(base.mapInArrow(assign, "id long, v array<double>, cell int, " + ", ".join(f"{a} double" for a in axes)), "cells")
    boxes = base.groupBy("cell").agg(F.count("*").alias("n"), *(f(a).alias(f"{f.__name__}_{a}") for f in (F.min, F.max) for a in axes)).orderBy("cell").collect()  # at most CELLS rows
    number = np.array([r.cell for r in boxes])
    low, high = (np.array([[r[f"{f}_{a}"] for a in axes] for r in boxes]) for f in ("min", "max"))
    parts = [0] * cells.n
    for r in boxes:
        parts[r.cell] = -(-r.n // (2 * SHARD)) if r.n > 2 * SHARD else 1
    stop, m = chi_square_quantile(sure, DIMS), projection(dims)

    def visits(first: bool):
        def run(batches):
            for batch in batches:
                q, e = scaled(batch.column(1).flatten().to_numpy().reshape(-1, dims))
                near = box_distance(q @ m[:-1], low, high)
                own = near.argmin(axis=1)
                if first:
                    take = [own[i : i + 1] for i in range(len(q))]
                else:
                    kth = np.einsum("ij,ij->i", q, q) + norm * norm - 2 * np.ldexp(batch.column(2).to_numpy(zero_copy_only=False), -e - unit)
                    go = near <= stop * np.maximum(kth, 0.0)[:, None]
                    go[np.arange(len(q)), own] = False
                    take = [np.nonzero(g)[0] for g in go]
                i = np.repeat(np.arange(len(q)), [len(t) for t in take])
                c = number[np.concatenate([*take, own[:0]])].astype(np.int32)
                i, c = np.repeat(i, [parts[x] for x in c]), np.concatenate([np.stack([np.full(parts[x], x), np.arange(parts[x])]) for x in c] or [np.zeros((2, 0), np.int64)], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(c[0].astype(np.int32)), pa.array(c[1].astype(np.int32)), pa.array(np.ones(len(i), np.int32)), *(batch.column(j).take(pa.array(i, pa.int64())) for j in range(3))], ["cell", "part", "kind", "id", "v", "floor"])

        return run

    part = F.pmod(F.xxhash64("id", F.lit(SEED)), F.element_at(F.array(*map(F.lit, parts)), F.col("cell") + 1)).cast("int")
    held = base.select("cell", part.alias("part"), F.lit(0).alias("kind"), "id", "v", F.lit(None).cast("double").alias("floor"))

    def run(batches):
        def matrix(rows):
            return (np.concatenate([r[k] for r in rows]) for k in range(3))

        def grown(rows):
            ids, v, _ = matrix(rows)
            return ShardTree(ids, v, norm, unit)

        def answer(tree, rows):
            ids, q, floor = matrix(rows)
            own, e = scaled(q)
            who, _ = tree.search(ids, own, k, sure, np.ldexp(floor, -e - unit))
            keep, score = who >= 0, tree.exact(q, who)
            return pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(ids[:, None], who.shape)[keep]), pa.array(tree.ids[who[keep]]), pa.array(score[keep])], ["query_id", "vec_id", "score"])

        last, tree, own, asked = None, None, [], []
        for batch in batches:
            cell, number, kind, ids = (batch.column(c).to_numpy() for c in range(4))
            v = batch.column(4).flatten().to_numpy().reshape(-1, dims)
            floor = np.nan_to_num(batch.column(5).to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf, neginf=-np.inf)
            cut = np.nonzero((np.diff(cell) != 0) | (np.diff(number) != 0) | (np.diff(kind) != 0))[0] + 1
            for a, b in zip([0, *cut], [*cut, len(ids)], strict=True):
                if a == b:
                    continue
                if (cell[a], number[a]) != last:
                    if asked and own:
                        yield answer(tree or grown(own), asked)
                    last, tree, own, asked = (cell[a], number[a]), None, [], []
                rows = (ids[a:b], v[a:b], floor[a:b])
                if kind[a] == 0:
                    own.append(rows)
                elif own:
                    tree = tree or grown(own)
                    asked.append(rows)
                    if sum(len(x[0]) for x in asked) >= QUERY_BLOCK:
                        yield answer(tree, asked)
                        asked = []
        if asked and own:
            yield answer(tree, asked)

    def found(asked: DataFrame, first: bool) -> DataFrame:
        sent = asked.mapInArrow(visits(first), "cell int, part int, kind int, id long, v array<double>, floor double")
        rows = held.union(sent).repartition(max(1, min(sum(parts), 100_000)), "cell", "part").sortWithinPartitions("cell", "part", "kind")
        return rows.mapInArrow(run, "query_id long, vec_id long, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows come from each shard
    near = found(queries.withColumn("floor", F.lit(None).cast("double")), True)
    near = materialise(near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "nearest")
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    asked = queries.join(floors, "id", "left").select("id", "v", F.when(F.abs("floor").between(1e-290, 1e290), F.col("floor")).otherwise(F.lit(float("-inf"))).alias("floor"))
    out = near.select("query_id", "vec_id", "score").union(found(asked, False))
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"))


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
