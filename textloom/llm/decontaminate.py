"""Operator 3: benchmark decontamination by the q-gram lemma on diagonal bands.

Texts are compared as UTF-8 bytes with A-Z folded and runs of white space as one space. An item leaks into a document
if some window of w = min(length of the item, WINDOW) bytes of the item is within e = 8 % of w edits of a passage of
the document. Two such strings share at least T = w - q + 1 - q e q-grams on at most e + 1 neighbouring diagonals, so
hits are counted in bands of 2 (e + 1) diagonals that overlap by half, and a band is kept only if T hits lie within a
window. What is kept is verified by a banded alignment of every such window. The filter loses nothing.

Repetitive texts share a gram in very many places. So a window of an item that stands in it before is not indexed, texts
with more than HITS shared grams are searched in halves that overlap by two windows, and an item that a text holds without
edits is not searched for in the rest of that text. None of this changes a result; memory stays within some hundred MB.

The index of q-grams is sent to executors for at most INDEX_BYTES of benchmark text at a time; a larger benchmark is
dealt into blocks of that size, and each block passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import bounded_batches, load, pieces, strings

Q = 10
WINDOW = 100
EDITS = 0.08
INDEX_BYTES = 4 << 20
PIECE = 2 << 20
HITS = 1 << 20
STRIDE = 8
_B = np.uint64(0x9E3779B97F4A7C15)
_B2, _B4 = (np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in (2, 4))
_WS = np.zeros(256, bool)
_WS[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


def normal(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ws = _WS[raw]
    before = np.ones(len(raw), bool)
    before[1:] = ws[:-1]
    before[offsets[:-1][offsets[:-1] < len(raw)]] = True
    keep = ~(ws & before)
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    return _FOLD[raw[keep]], at[offsets]


def grams(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q bytes from each position on."""
    if len(b) < Q:
        return np.zeros(0, np.uint64)
    h1 = b.astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * _B + h1[1:]
    h4 = h2[:-2] * _B2 + h2[2:]
    h8 = h4[:-4] * _B4 + h4[4:]
    h = h8[:-2] * _B2 + h2[8:]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def limits(length: int) -> tuple[int, int]:
    """(w, e) of an item of so many bytes; e is lowered where the lemma would ask for no shared q-gram."""
    w = min(length, WINDOW)
    return w, max(0, min(int(w * EDITS), (w - Q) // Q))


def samples(starts: list[int]) -> list[int]:
    """Some of the sorted starts, so that each start lies within STRIDE of one before or at it."""
    out: list[int] = []
    for s in starts:
        if not out or s > out[-1] + STRIDE:
            out.append(s)
    return out


def first_windows(h: np.ndarray, w: int) -> np.ndarray:
    """Starts of an item's windows of w bytes that don't stand in the item before; h are all its grams."""
    k = w - Q + 1  # grams of a window
    power = np.cumprod(np.full(len(h), _B))
    back = np.cumprod(np.full(len(h) - k + 1, np.uint64(pow(int(_B), -1, 1 << 64))))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((h ^ (h >> np.uint64(31))) * power)])
    return np.sort(np.unique((sums[k:] - sums[:-k]) * back, return_index=True)[1])


class Index:
    """The q-grams of benchmark items. Items of fewer than Q bytes are no evidence of a leak and have none."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.text, self.starts = [], [], []  # starts: of the item's windows
        hashes, owner, at = [], [], []
        for item_id, text in items:
            b = np.frombuffer((text or "").encode(), np.uint8)
            b, _ = normal(b, np.array([0, len(b)]))
            b = b[: len(b) - 1] if len(b) and b[-1] == 32 else b
            if len(b) >= Q:
                h = grams(b)
                w = limits(len(b))[0]
                self.starts.append(first_windows(h, w))
                edge = np.zeros(len(h) + 1, np.int64)
                edge[self.starts[-1]] += 1
                edge[self.starts[-1] + w - Q + 1] -= 1
                new = np.nonzero(np.cumsum(edge[:-1]))[0]
                hashes.append(h[new])
                owner.append(np.full(len(new), len(self.ids)))
                at.append(new)
                self.ids.append(item_id)
                self.text.append(b)
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.owner = (np.concatenate(owner) if owner else np.zeros(0, np.int64))[order]
        self.at = (np.concatenate(at) if at else np.zeros(0, np.int64))[order]
        self.gram, self.first = np.unique(h[order], return_index=True)
        self.last = np.append(self.first[1:], len(h))
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.gram >> np.uint64(42)).astype(np.int64)] = True
        self.size = np.array([len(t) for t in self.text], np.int64)
        self.place = np.cumsum(self.size) - self.size
        self.all = np.concatenate(self.text) if self.text else np.zeros(0, np.uint8)
        w, e = np.array([limits(len(t)) for t in self.text] or [(1, 0)]).T
        self.w, self.e, self.need = w, e, np.maximum(1, w - Q + 1 - Q * e)

    def shared(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in b, gram) of each place whose gram the index has."""
        h = grams(b)
        i = np.nonzero(self.maybe[(h >> np.uint64(42)).astype(np.int64)])[0]
        k = np.searchsorted(self.gram, h[i])
        ok = k < len(self.gram)
        i, k = i[ok], k[ok]
        ok = self.gram[k] == h[i]
        return i[ok], k[ok]

    def hits(self, i: np.ndarray, k: np.ndarray, settled: set[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, item, place in the item) of each pair of equal grams, of shared(); items in settled are left out."""
        n = self.last[k] - self.first[k]
        row = np.repeat(np.arange(len(k)), n)
        entry = self.first[k][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        if settled:
            ok = ~np.isin(self.owner[entry], list(settled))
            row, entry = row[ok], entry[ok]
        return i[row], self.owner[entry], self.at[entry]

    def align(self, item: np.ndarray, start: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray, low: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Row by row, the least edits that turn the item's window at start into a passage of b[lo:hi] on the diagonals
        of the band from low; limit + 1 for rows found to need more. All rows' windows are equally long."""
        w, width = int(self.w[item[0]]), 2 * (int(self.e[item].max()) + 1)
        k = np.arange(width, dtype=np.int32)
        out = limit + 1
        alive = np.arange(len(item))
        cost = np.zeros((len(item), width), np.int32)
        text, doc = self.place[item] + start, lo + start + low
        for r in range(w):
            place = doc[:, None] + (r + k)
            inside = (place >= lo[:, None]) & (place < hi[:, None])
            same = inside & (b[np.where(inside, place, 0)] == self.all[text + r][:, None])
            step = cost + np.where(same, 0, np.where(inside, 1, w + 1)).astype(np.int32)
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(step - k, axis=1) + k
            if r % 8 == 7:
                keep = cost.min(axis=1) <= limit
                if not keep.all():
                    alive, cost, text, doc, lo, hi, limit = (x[keep] for x in (alive, cost, text, doc, lo, hi, limit))
                    if not len(alive):
                        break
        if len(alive):
            out[alive] = np.minimum(cost.min(axis=1), limit + 1)
        return out

    def search(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, start of the window in the item) of each leak; the window with fewest edits, then the first."""
        b, off = normal(raw, offsets)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        if len(self.ids) and len(b) >= Q:
            self._search(b, off, 0, best)
        return [(d, t, *v) for (d, t), v in sorted(best.items())]

    def _search(self, b: np.ndarray, off: np.ndarray, doc0: int, best: dict) -> None:
        """search() of normalised texts, numbered from doc0, into best."""
        i, k = self.shared(b)
        n_docs = len(off) - 1
        if len(i) and int((self.last[k] - self.first[k]).sum()) > HITS:
            if n_docs > 1:
                mid = n_docs // 2
                self._search(b[: off[mid]], off[: mid + 1], doc0, best)
                self._search(b[off[mid] :], off[mid:] - off[mid], doc0 + mid, best)
                return
            if len(b) > 8 * WINDOW:
                mid = len(b) // 2
                for part in (b[: mid + WINDOW], b[mid - WINDOW :]):
                    self._search(part, np.array([0, len(part)]), doc0, best)
                return
        settled = {t for (d, t), v in best.items() if d == doc0 and not v[0]} if n_docs == 1 else set()
        i, item, j = self.hits(i, k, settled)
        doc = np.searchsorted(off, i, "right") - 1
        ok = i + Q <= off[doc + 1]
        i, item, j, doc = i[ok], item[ok], j[ok], doc[ok]
        pair = doc * len(self.ids) + item
        _, back, count = np.unique(pair, return_inverse=True, return_counts=True)
        ok = count[back] >= self.need[item]
        i, item, j, doc = i[ok], item[ok], j[ok], doc[ok]
        if not len(i):
            return
        step = self.e[item] + 1
        band = (i - off[doc] - j) // step
        doc, item, band, j = (np.concatenate(x) for x in ((doc, doc), (item, item), (band, band - 1), (j, j)))
        order = np.lexsort((j, band, item, doc))
        doc, item, band, j = doc[order], item[order], band[order], j[order]
        new = np.ones(len(j), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        edges = np.append(np.nonzero(new)[0], len(j))
        todo = []  # (text, item, band, starts of windows with hits enough)
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            t, d = int(item[a]), int(doc[a])
            need, w = int(self.need[t]), int(self.w[t])
            if z - a >= need:
                starts = self.starts[t]
                inside = np.searchsorted(j[a:z], starts + w - Q, "right") - np.searchsorted(j[a:z], starts, "left")
                if (inside >= need).any():
                    todo.append((d, t, int(band[a]), starts[inside >= need], starts[inside >= w - Q + 1]))

        def aligned(rows, slack):
            """rows: (text, item, band, start); yields each with its edits, up to the item's budget and slack."""
            for w in sorted({int(self.w[r[1]]) for r in rows}):
                own = [r for r in rows if self.w[r[1]] == w]
                d, t, band, start = np.array(own, np.int64).T
                low = band * (self.e[t] + 1)
                for x in range(0, len(own), 4096):
                    c = slice(x, x + 4096)
                    edits = self.align(t[c], start[c], b, off[d[c]], off[d[c] + 1], low[c], self.e[t[c]] + slack)
                    yield from zip(own[c], edits.tolist(), strict=True)

        # a window without edits has all its q-grams: the first such window settles its pair
        for (d, t, _, start), edits in aligned([(d, t, k, int(full[0])) for d, t, k, _, full in todo if len(full)], 0):
            if edits == 0:
                best[d + doc0, t] = min(best.get((d + doc0, t), (0, start)), (0, start))
        # windows that are s apart differ by s edits at most: samples STRIDE bytes from the next at most tell which others can be in the budget
        todo = [x for x in todo if best.get((x[0] + doc0, x[1]), (1,))[0]]
        near: dict[tuple, set] = {}
        for (d, t, k, start), edits in aligned([(d, t, k, int(s)) for d, t, k, starts, _ in todo for s in samples(starts.tolist())], STRIDE):
            if edits <= self.e[t] + STRIDE:
                near.setdefault((d, t, k), set()).update(range(start - STRIDE, start + STRIDE + 1))
        rest = [(d, t, k, int(s)) for d, t, k, starts, _ in todo if (d, t, k) in near for s in starts if int(s) in near[d, t, k]]
        for (d, t, _, start), edits in aligned(rest, 0):
            if edits <= self.e[t]:
                best[d + doc0, t] = min(best.get((d + doc0, t), (edits, start)), (edits, start))

    def leaks(self, texts) -> list[tuple[int, int, int, int]]:
        """search() over an Arrow column, in pieces; a text beyond PIECE bytes is cut with an overlap of two windows."""
        raw, offsets = strings(texts)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for i, j in pieces(offsets, PIECE):
            lo, hi = int(offsets[i]), int(offsets[j])
            parts = [(lo, hi, offsets[i : j + 1] - lo)]
            if hi - lo > 2 * PIECE:
                text = normal(raw[lo:hi], np.array([0, hi - lo]))[0]
                parts = [(s, min(s + PIECE + 2 * WINDOW, len(text)), None) for s in range(0, len(text), PIECE)]
            for s, z, own in parts:
                for d, t, *v in self.search(text[s:z], np.array([0, z - s])) if own is None else self.search(raw[s:z], own):
                    found[d + i, t] = min(found.get((d + i, t), (WINDOW, 0)), tuple(v))
        return [(d, t, *v) for (d, t), v in sorted(found.items())]


def index_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """Indexes that together hold all items, each of about INDEX_BYTES of text: the size is computed before any is collected."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // INDEX_BYTES)
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        yield Index([(r.i, r.t) for r in part.collect()])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document row and item that leaks into it: (id, item_id, edits int, item_start int).

    Null texts and texts of fewer than Q bytes have no leaks; an empty benchmark gives no rows; rows with equal ids are
    searched each by itself; a null id is returned as null. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    schema = f"`{id_col}` long, item_id long, edits int, item_start int"
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for index in index_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, held=held):
            for batch in batches:
                found = held.value.leaks(batch.column(1))
                ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                rest = [pa.array([held.value.ids[f[1]] for f in found], pa.int64()), *(pa.array([f[k] for f in found], pa.int32()) for k in (2, 3))]
                yield pa.RecordBatch.from_arrays([ids, *rest], [id_col, "item_id", "edits", "item_start"])

        part = docs.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the rows that any item leaks into; all columns stay as they are. Null and empty texts stay."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    for index in index_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, held=held):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[f[0] for f in held.value.leaks(batch.column(at))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
