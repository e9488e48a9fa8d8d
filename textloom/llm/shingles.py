"""Word shingles of whole texts as sorted arrays of 64-bit hashes, computed on UTF-8 bytes with numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z folded to a-z. A text's set holds its
distinct shingles of `size` words; a text with fewer words has its whole word sequence as the one shingle; a text
without words has an empty set. Work is cut into windows of at most WINDOW bytes, so memory follows the longest
word and not the longest text.
"""

from __future__ import annotations

import numpy as np

from textloom.llm._common import mix64

WINDOW = 1 << 20
_SEP = np.zeros(256, bool)
_SEP[[0x20, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_BYTE = mix64(_FOLD.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        size = max(n, WINDOW + 1)
        _POW[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x, np.uint64)])) for x in (_BASE, _BASE_INV)]
    return _POW[0], _POW[1]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of each word, in order."""
    hashes, owners, pos, total = [], [], 0, len(raw)
    while pos < total:
        end = min(pos + WINDOW, total)
        if end < total:
            cut = np.nonzero(_SEP[raw[pos:end]])[0]
            edge = offsets[max(0, np.searchsorted(offsets, end, "right") - 1)]
            last = max(pos + int(cut[-1]) + 1 if len(cut) else pos, int(edge))
            while last <= pos:  # one word longer than the window
                more = np.nonzero(_SEP[raw[end : end + WINDOW]])[0]
                edge = int(offsets[np.searchsorted(offsets, end, "left")])
                stop = min(end + int(more[0]) + 1 if len(more) else min(end + WINDOW, total), edge)
                last, end = (stop if len(more) or stop in (edge, total) else pos), stop
            end = last
        b = raw[pos:end]
        sep = _SEP[b]
        edge = np.zeros(len(b) + 1, bool)
        inside = offsets[np.searchsorted(offsets, pos, "left") : np.searchsorted(offsets, end, "right")]
        edge[inside - pos] = True
        edge[0] = edge[-1] = True
        before = edge[:-1].copy()
        before[1:] |= sep[:-1]
        after = edge[1:].copy()
        after[:-1] |= sep[1:]
        s = np.nonzero(~sep & before)[0]
        e = np.nonzero(~sep & after)[0] + 1
        p, inv = _powers(len(b) + 1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * p[: len(b)], out=sums[1:])
        hashes.append(mix64((sums[e] - sums[s]) * inv[s] + (e - s).astype(np.uint64) * _BASE))
        owners.append(np.searchsorted(offsets, pos + s, "right") - 1)
        pos = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int = 5):
    """Yields the sorted distinct shingle hashes of each text."""
    words, owner = word_hashes(raw, offsets)
    n = len(offsets) - 1
    ends = np.searchsorted(owner, np.arange(n), "right")
    starts = np.searchsorted(owner, np.arange(n), "left")
    grams = np.zeros(0, np.uint64)
    if len(words) >= size:
        grams = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            grams = grams * _BASE + words[k : len(words) - size + 1 + k]
        grams = mix64(grams + np.uint64(size))
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if b - a >= size:
            yield np.unique(grams[a : b - size + 1])
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * _BASE + w
            yield mix64(np.array([h]) + np.uint64(0x100))
        else:
            yield grams[:0]
