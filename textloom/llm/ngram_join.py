"""Operator 6: similarity join of documents on word 5-grams by R-trees over group-count vectors.

Shingles are hashed into groups, about one or two shingles to a group; a document's group counts are a point, and the
overlap of two sets is at most the sum of the coordinate minima of their points. One R-tree over all points can't be
spread over machines, as the boxes of high-dimensional points overlap; so its root is replaced by routing entries: a
document is entered under the fingerprints of its groups (the hash of all shingles that fall into one coarse group), and
only documents with an equal fingerprint meet. Below each routing entry lies a packed R-tree over the count vectors.
Every pair that is ever looked at comes out of these trees; what their bound leaves is verified on the full sets.

Routing entries of sets of under 80 shingles follow the prefix rule (two sets with Jaccard >= t share one of their
n - ceil(t n) + 1 smallest hashes), which is exact. Larger ones use ROUTES of about n/4 to n/2 coarse groups; two linked
sets differ in at most 2/9 n shingles, so that a group is equal with probability of at least 0.41 and none of 56 is with
a probability of about 1e-13: that is the chance of losing a link of two large sets.

Equal sets are one node. First, below some of the routing entries with many nodes, each node is paired with a leader, and
what these pairs link is contracted to one component. Then the nodes outside the largest component below an entry are
looked up among those of other components. A node with at most FEW candidates gives out all of them; one with more stays
open. Open nodes that are tied by candidates go below one entry of their own and are looked up again, each giving out two
candidates, the one of least hash and the one of greatest bound, and are contracted, round by round. Groups of thousands
of near copies are so linked without being expanded into pairs. When links no longer come, or no more candidates are left
than there are routing entries, all of these are given out: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import bounded_batches, discard, load, materialise, mix64, pieces, semi_by_id, strings
from textloom.llm.components import components
from textloom.llm.shingles import shingle_sets

NUM, DEN = 4, 5  # Jaccard >= NUM / DEN
SIZE = 5
ROUTES = 56
LEAST_GROUPS, MOST_GROUPS = 64, 1 << 14
BLOCK = 2048
LEAF = 32
FEW = 4  # candidates of a node below one routing entry that are all given out
ROUNDS = 8
LEAD, LEAD_KEYS, COMMON = 8, 4, 64  # leaders are looked for below one in LEAD_KEYS keys of more than LEAD nodes
_ODD = np.uint64(0xD6E8FEB86659FD93)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, the same in any order."""
    a = np.add.reduce(mix64(s), dtype=np.uint64) if len(s) else np.uint64(0)
    b = np.add.reduce(mix64(s ^ _ODD), dtype=np.uint64) if len(s) else np.uint64(0)
    return a.astype(np.int64).item(), b.astype(np.int64).item()


def group_counts(s: np.ndarray) -> bytes:
    """The point of a set: counts by the leading bits of hashes, in four bits each. A count over 15 is stored as 15; what
    is missing follows from the set's size and is added to bounds."""
    bits = LEAST_GROUPS.bit_length() - 1
    while 2 << bits <= min(len(s), MOST_GROUPS):
        bits += 1
    c = np.minimum(np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 15).astype(np.uint8)
    return (c[::2] | c[1::2] << 4).tobytes()


def points_of(vectors: list[bytes]) -> np.ndarray:
    """The points of some sets as rows; finer points are folded to the coarsest one's groups."""
    length = np.array([len(v) for v in vectors])
    out = np.zeros((len(vectors), 2 * int(length.min())), np.int16)
    for n in np.unique(length):
        rows = np.nonzero(length == n)[0]
        packed = np.frombuffer(b"".join(vectors[k] for k in rows), np.uint8).reshape(len(rows), n)
        c = np.stack([packed & 15, packed >> 4], axis=2).reshape(len(rows), out.shape[1], -1)
        out[rows] = c.sum(axis=2, dtype=np.int16)
    return out


def routing_keys(s: np.ndarray) -> np.ndarray:
    """The routing entries of a set; empty if no other set can be similar."""
    n, out = len(s), []
    if n < NUM:
        return np.zeros(0, np.int64)
    if n < 80:
        out.append(mix64(s[: n + (-NUM * n // DEN) + 1] ^ _ODD))
    if n >= 64:
        base = 64
        while base * 2 <= n:
            base *= 2
        for b in [base] + [base // 2] * (base > 64 and 4 * n <= 5 * base):
            m = max(ROUTES, b // 2)
            g = (mix64(s + np.uint64(b)) % np.uint64(m)).astype(np.int64)
            keep = np.nonzero(g < ROUTES)[0]
            if len(keep):
                keep = keep[np.argsort(g[keep], kind="stable")]
                g = g[keep]
                first = np.nonzero(np.diff(g, prepend=-1))[0]
                sums = np.add.reduceat(mix64(s[keep] * _ODD), first)
                out.append(mix64(sums + (g[first] + b * ROUTES).astype(np.uint64) * _ODD))
    return np.concatenate(out).astype(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """DEN * |intersection| >= NUM * |union|."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both)


class CountTree:
    """A packed R-tree over count vectors: leaves of LEAF points, each node with its coordinate maxima and its ranges of
    sizes and of what the counts lack to the sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = self._pack(points, sizes, np.arange(len(sizes)), 0)
        self.order, self.points, self.sizes = order, points[order], sizes[order]
        self.lacks = self.sizes - self.points.sum(axis=1)
        self.levels = [self._above(self.points, self.sizes, self.sizes, self.lacks)]
        while len(self.levels[-1][1]) > 1:
            self.levels.append(self._above(*self.levels[-1]))

    @staticmethod
    def _above(top, lo, hi, lack):
        first = np.arange(0, len(lo), LEAF)
        return np.maximum.reduceat(top, first, axis=0), np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first), np.maximum.reduceat(lack, first)

    def _pack(self, points, sizes, rows, depth):
        """Sort-tile: by size first, then by the coordinate that varies most."""
        if len(rows) <= LEAF:
            return rows
        if depth == 0:
            by = sizes[rows]
        else:
            own = points[rows].astype(np.float32)
            by = own[:, int(own.var(axis=0).argmax())]
        rows = rows[np.argsort(by, kind="stable")]
        half = max(LEAF, (len(rows) // 2 + LEAF - 1) // LEAF * LEAF)
        return np.concatenate([self._pack(points, sizes, rows[:half], depth + 1), self._pack(points, sizes, rows[half:], depth + 1)])

    @staticmethod
    def _bound(q, n, lack, top, lo, hi, lacks):
        """(can a point below be similar to q of size n, greatest overlap): maxima top, sizes lo..hi."""
        low = np.maximum(lo, -(-NUM * n // DEN))
        bound = np.minimum(np.minimum(q, top).sum(axis=-1) + lack + lacks, np.minimum(hi, n))
        return (low <= hi) & (NUM * lo <= DEN * n) & ((NUM + DEN) * bound >= NUM * (n + low)), bound

    def near(self, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose bound on the overlap with q meets the threshold, and these bounds as parts of the sizes' sum."""
        lack = n - int(q.sum())
        nodes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, lo, hi, lacks = self.levels[depth]
            nodes = nodes[self._bound(q, n, lack, top[nodes], lo[nodes], hi[nodes], lacks[nodes])[0]]
            below = len(self.levels[depth - 1][1]) if depth else len(self.order)
            nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
            nodes = nodes[nodes < below]
        ok, bound = self._bound(q, n, lack, self.points[nodes], self.sizes[nodes], self.sizes[nodes], self.lacks[nodes])
        return self.order[nodes[ok]], bound[ok] / (n + self.sizes[nodes[ok]])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = strings(batch.column(1))
        for i, j in pieces(offsets, 4 << 20):
            ns, d1, d2, vec, keys = [], [], [], [], []
            for s in shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SIZE):
                ns.append(len(s))
                a, b = fingerprint(s)
                d1.append(a)
                d2.append(b)
                vec.append(group_counts(s))
                keys.append(routing_keys(s))
            off = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate(keys), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(ns, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(vec, pa.binary()), lists], ["id", "n", "d1", "d2", "vec", "keys"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, id) sorted by both -> those whose key several ids have, each once."""
    key, ids, met = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for batch in batches:
        # the last row of the batch before stays until its successor is known
        key, ids = np.concatenate([key, batch.column(0).to_numpy()]), np.concatenate([ids, batch.column(1).to_numpy()])
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
        key, ids = key[new], ids[new]
        if len(key) > 1:
            same = key[1:] == key[:-1]
            shared = same | np.concatenate([[met], same[:-1]])
            met = bool(same[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1][shared]) for x in (key, ids)], ["key", "id"])
            key, ids = key[-1:], ids[-1:]
    if met:
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids)], ["key", "id"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = strings(batch.column(1))
        for i, j in pieces(offsets, 4 << 20):
            out = [s.tobytes() for s in shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SIZE)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(out, pa.binary())], ["id", "s"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))


ALL, FIRST, BEST, OPEN = range(4)
_FOUND = "x long, y long, how int, by double, n int"


def _blocks(batches: Iterator[pa.RecordBatch], n_at: int) -> Iterator[list]:
    """The rows of each run of equal leading n_at columns, without these."""
    last, rows = None, []
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for at, *row in zip(zip(*cols[:n_at], strict=True), *cols[n_at:], strict=True):
            if at != last:
                if len(rows) > 1:
                    yield rows
                last, rows = at, []
            rows.append(row)
    if len(rows) > 1:
        yield rows


def _found(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32())
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["x", "y", "how", "by", "n"])


def _order(ids: np.ndarray, turn: int) -> np.ndarray:
    return (mix64(ids.astype(np.uint64) + np.uint64(turn << 56)) >> np.uint64(12)).astype(np.float64)


def _leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, block, common, id, n, vec) sorted by (key, block): each node with the first leader of its block that it
    may be similar to. Nodes that have a leader are none themselves; common nodes, which stand in all blocks, come first."""
    for rows in _blocks(batches, 2):
        common, ids, n = (np.array([r[c] for r in rows], np.int64) for c in range(3))
        points, order, out = points_of([r[3] for r in rows]), _order(ids, 0), []
        tree, led = CountTree(points, n), np.zeros(len(rows), bool)
        for x in np.lexsort((order, -common)).tolist():
            if not led[x]:
                near = tree.near(points[x], int(n[x]))[0]
                near = near[~led[near] & (ids[near] != ids[x])]
                led[near] = True
                out += [(int(ids[y]), int(ids[x]), FIRST, float(order[x]), 0) for y in near]
        yield _found(out)


def _candidates(turn: int, few: int | None):
    """Over rows (key, ci, cj, own, id, comp, n, vec) sorted by (key, ci, cj): (x, y, how, by, n), candidates y of another
    component for node x. Nodes outside the largest component of the block are looked up, so that every pair is met from
    one side at least. how is ALL where x has at most few candidates (None: always). Otherwise it is FIRST, with a hash of y
    and turn in by and the number of candidates in n, and BEST, with the bound in by; x and all its candidates then are
    OPEN, with one node in y for all open nodes that are tied by such candidates."""

    def block(rows):
        own, ids, comp, n = (np.array([r[c] for r in rows], np.int64) for c in range(4))
        names, which, sizes = np.unique(comp, return_inverse=True, return_counts=True)
        if len(names) == 1:
            return
        points, cross, order = points_of([r[4] for r in rows]), own.min() != own.max(), _order(ids, turn)
        tree, found = CountTree(points, n), {}
        for x in np.nonzero(which != sizes.argmax())[0].tolist():
            y, bound = tree.near(points[x], int(n[x]))
            ok = (comp[y] != comp[x]) & ((own[y] != own[x]) if cross else True)
            found[x] = y[ok], bound[ok]
        tied = np.arange(len(rows))
        for x, (y, bound) in found.items():
            if few is None or len(y) <= few:
                for z in y.tolist():
                    if z not in found or z > x or (few is not None and len(found[z][0]) > few):
                        yield int(ids[x]), int(ids[z]), ALL, 0.0, 1
            else:
                if turn > 1:
                    z = y[order[y].argmin()]
                    yield int(ids[x]), int(ids[z]), FIRST, float(order[z]), len(y)
                    k = np.lexsort((ids[y], -bound))[0]
                    yield int(ids[x]), int(ids[y[k]]), BEST, float(bound[k]), 0
                group = np.unique(tied[np.append(y, x)])
                tied[np.isin(tied, group)] = group[0]
        for group in np.unique(tied[np.bincount(tied, minlength=len(tied))[tied] > 1]).tolist():
            members = np.nonzero(tied == group)[0]
            for z in members.tolist():
                yield int(ids[z]), int(ids[members[0]]), OPEN, 0.0, 0

    def run(batches):
        for rows in _blocks(batches, 3):
            yield _found(list(block(rows)))

    return run


def _lead(rows: DataFrame) -> DataFrame:
    """Pairs of nodes and their leaders, of rows (key, id, n, vec). A key of more than BLOCK nodes is dealt into blocks, and
    COMMON of its nodes, about, stand in each of them."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") > LEAD)
    rows = rows.join(sizes, "key").withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int"))
    rows = rows.withColumn("common", F.pmod(F.xxhash64("id", F.lit("common")), F.ceil(F.col("k") / COMMON)) == 0)
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", F.explode(F.when(F.col("common"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))))
    rows = rows.select("key", "block", F.col("common").cast("int").alias("common"), "id", "n", "vec").repartition("key", "block").sortWithinPartitions("key", "block")
    found = rows.mapInArrow(_leaders, _FOUND).groupBy("x").agg(F.min(F.struct("by", "y")).alias("first"))
    return found.select(F.least("x", "first.y").alias("u"), F.greatest("x", "first.y").alias("v")).distinct()


def _look_up(rows: DataFrame, turn: int, few: int | None) -> DataFrame:
    """_candidates() of rows (key, id, comp, n, vec). Of a key with more than BLOCK nodes, those outside its largest
    component are dealt into blocks that meet each other and those of the largest component, which don't meet each other."""
    parts = rows.groupBy("key", "comp").agg(F.count("*").alias("k"))
    keys = parts.groupBy("key").agg(F.sum("k").alias("k"), F.max(F.struct("k", "comp")).alias("most"), F.count("*").alias("c")).where("c > 1")
    whole = F.col("k") <= BLOCK
    few_blocks, many = F.ceil((F.col("k") - F.col("most.k")) / BLOCK).cast("int"), F.ceil(F.col("most.k") / BLOCK).cast("int")
    keys = keys.select("key", F.when(whole, 0).otherwise(few_blocks).alias("a"), F.when(whole, 0).otherwise(many).alias("m"), F.col("most.comp").alias("main"))
    rows = rows.join(keys, "key").withColumn("inside", F.col("comp") == F.col("main"))
    h = F.xxhash64("id")
    own = F.when(F.col("a") == 0, 0).when(F.col("inside"), F.col("a") + F.pmod(h, F.col("m"))).otherwise(F.pmod(h, F.col("a"))).cast("int")
    others = F.when(F.col("a") == 0, F.array(F.lit(0))).when(F.col("inside"), F.sequence(F.lit(0), F.col("a") - 1)).otherwise(F.sequence(F.lit(0), F.col("a") + F.col("m") - 1))
    rows = rows.withColumn("own", own).withColumn("c", F.explode(others))
    rows = rows.select("key", F.least("own", "c").alias("ci"), F.greatest("own", "c").alias("cj"), "own", "id", "comp", "n", "vec")
    rows = rows.repartition("key", "ci", "cj").sortWithinPartitions("key", "ci", "cj")
    return materialise(rows.mapInArrow(_candidates(turn, few), _FOUND), "candidates")


def _pairs(found: DataFrame) -> DataFrame:
    """Pairs (u, v) to verify: all candidates of nodes with few, and of each other node the first and the best one."""
    some = found.where(F.col("how") == ALL).select("x", "y")
    more = found.where(F.col("how").isin(FIRST, BEST)).groupBy("x").agg(
        F.min(F.when(F.col("how") == FIRST, F.struct("by", "y"))).alias("first"), F.max(F.when(F.col("how") == BEST, F.struct("by", (-F.col("y")).alias("y")))).alias("best")
    )
    both = some.union(more.select("x", "first.y")).union(more.select("x", -F.col("best.y")))
    return both.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def _verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Of a table of pairs (u, v) of document ids, those whose whole shingle sets are similar."""
    ids = materialise(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct(), "ids")
    sets = semi_by_id(docs, ids, "id").mapInArrow(_sets, "id long, s binary")
    both = pairs.join(sets.withColumnsRenamed({"id": "u", "s": "su"}), "u").join(sets.withColumnsRenamed({"id": "v", "s": "sv"}), "v")
    links = materialise(both.select("u", "v", "su", "sv").mapInArrow(_verified, "u long, v long"), "links")
    discard(ids)
    return links


def _link(nodes: DataFrame, docs: DataFrame, log: list | None = None) -> DataFrame:
    """(id, component) of every node (id, n, vec, keys) that links to another one."""
    routed = nodes.select(F.explode("keys").alias("key"), "id").repartition("key").sortWithinPartitions("key", "id")
    rows = materialise(routed.mapInArrow(_shared, "key long, id long"), "routes")
    points = materialise(nodes.select("id", "n", "vec").join(rows.select("id").distinct(), "id").distinct(), "points")
    n_routes, few = rows.count(), FEW
    links = comp = checked = None
    for turn in range(ROUNDS):
        if turn == 0:  # any of the keys will do to find a leader
            found, pairs = None, _lead(rows.where(F.pmod("key", F.lit(LEAD_KEYS)) == 0).join(points, "id"))
        else:
            own = rows.join(points, "id").join(comp, "id", "left").withColumn("comp", F.coalesce("component", "id"))
            found = _look_up(own.select("key", "id", "comp", "n", "vec"), turn, few)
            pairs = _pairs(found).join(checked, ["u", "v"], "left_anti")
        pairs = materialise(pairs, "pairs")
        new = _verify(pairs, docs)
        n_new, n_open, n_left = new.count(), 0, 0
        links, checked = (new, pairs) if turn == 0 else (links.union(new), checked.union(pairs))
        if found is not None:
            ties = materialise(found.where(F.col("how") == OPEN).select(F.col("x").alias("u"), F.col("y").alias("v")).distinct(), "ties")
            n_open, n_left = ties.count(), found.agg(F.sum("n")).first()[0] or 0
        if log is not None:
            log.append({"candidates": pairs.count(), "links": n_new, "open": n_open, "left": n_left, "given": found.count() if found is not None else 0})
        if turn == 0 or n_new:
            discard(*[comp] * (turn > 0))
            comp = materialise(components(links), "components")
        if found is not None:
            discard(found, rows)
            if not n_open:
                break
            # from now on a node stands once, below the least node that it is tied to
            rows = materialise(components(ties).select(F.col("component").alias("key"), "id"), "routes")
            # all candidates are given out once they are no more than the routing entries, or when links no longer come
            few = None if turn == ROUNDS - 2 or turn > 1 and (not n_new or n_left <= n_routes) else FEW
            discard(ties)
    discard(rows, points)
    return comp


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (id, n_shingles long, component_id long).

    component_id is the smallest id that links reach, itself included. Null texts are empty texts: n_shingles 0 and
    their own component. Repeated ids are rows of their own that share one node. A row without an id can't be named by a
    link: it is returned with its n_shingles and a null component. An empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sig = materialise(docs.mapInArrow(_signatures, "id long, n long, d1 long, d2 long, vec binary, keys array<long>"), "signatures")
    named = sig.where("id is not null")
    classes = materialise(named.where("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("id")), "classes")
    nodes = semi_by_id(named.where(f"n >= {NUM}"), classes.select("id"), "id")
    merged = _link(nodes, docs.where("id is not null"))
    of_class = classes.join(merged, "id", "left").select("d1", "d2", F.coalesce("component", "id").alias("component"))
    out = sig.select("id", "n", "d1", "d2").join(of_class, ["d1", "d2"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def op6_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(load(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh
  FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM s
  UNION
  SELECT p.u, r.c FROM r JOIN p ON p.v = r.doc_id)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.c AS component_id
FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""
