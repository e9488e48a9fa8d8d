"""Batch kernels over code points: the tokens of functions.text and the hashes of their shingles, by numpy.

The profiles are those of functions.text.canonicalize() and tokenize(), which stay the specification; a batch of texts is
one array of code points here. Chunks of letters are found by table; what holds digits, marks, apostrophes, mentions
or URLs goes through the tokeniser's own pattern. Work is cut into pieces of WINDOW code points.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from textloom.functions.text import QUOTES_FROM, folding_map

#: Code points worked on at once; a longer single text is a piece of its own.
WINDOW = 1 << 19
LETTER, MARK, NUMBER, UNDERSCORE, JOINER, BLANK, AT = 1, 2, 4, 8, 16, 32, 64
CHUNK = LETTER | MARK | NUMBER | UNDERSCORE | JOINER
#: Set members worked on at once by signatures().
SIGNED = 1 << 14
#: Words of more code points are hashed by blake2b.
LONG_WORD = 200
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POW = np.cumprod(np.concatenate([[np.uint64(1)], np.full(LONG_WORD, _BASE, np.uint64)]))


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class bits, dropped by canonical text, separators) of every code point."""
    major = {"L": LETTER, "M": MARK, "N": NUMBER}
    kind, drop, space = np.zeros(0x110000, np.uint8), np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    for cp in (*range(0x34000), *range(0xE0000, 0xE1000)):  # the other planes are unassigned or private
        c = unicodedata.category(chr(cp))
        kind[cp] = major.get(c[0], 0)
        drop[cp] = c == "Mn" or c[0] == "P"
        space[cp] = c[0] == "Z"
    drop[[ord(c) for c in QUOTES_FROM]] = True
    for chars, bit in (("_", UNDERSCORE), ("'-", JOINER), (" \t\n\x0b\f\r", BLANK), ("@#", AT)):
        kind[[ord(c) for c in chars]] = bit
    return kind, drop, space


@cache
def _word_pattern() -> re.Pattern:
    """text.WORD_RE with its properties written out."""
    kind = tables()[0]

    def members(bit: int) -> str:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (kind & bit != 0).astype(np.int8), [0]])))
        return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2))

    lt, mk, nb = members(LETTER), members(MARK), members(NUMBER)
    return re.compile(
        rf"https?://[^ \t\n\x0b\f\r]+|[{lt}{nb}_.+\-]+@[{lt}{nb}_\-]+\.[{lt}{nb}_.\-]+|[@#][{lt}{nb}_]+"
        rf"|[{lt}](?:[{lt}{mk}'\-_])+[{lt}]|[{lt}{mk}{nb}_]+"
    )


_UNITS: dict[str, list[tuple[int, int]]] = {}


def _letters_only(s: str) -> list[tuple[int, int]]:
    """Spans of the tokens in a piece of text without white space, by the pattern."""
    found = _UNITS.get(s)
    if found is None:
        kind = tables()[0]
        spans = [m.span() for m in _word_pattern().finditer(s)]
        found = [(a, b) for a, b in spans if all(kind[ord(c)] == LETTER for c in s[a:b])]
        if len(s) < 64 and len(_UNITS) < 100_000:
            _UNITS[s] = found
    return found


def code_points(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le"), np.uint32)


def characters(cp: np.ndarray) -> str:
    return cp.astype("<u4", copy=False).tobytes().decode("utf-32-le")


def spans(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the tokens of text.tokenize(preserve_case=True) in code points, in order."""
    kind = tables()[0][cp]
    inside = np.zeros(len(cp) + 2, np.int8)
    inside[1:-1] = (kind & CHUNK) != 0
    edges = np.flatnonzero(np.diff(inside))
    s, e = edges[::2], edges[1::2]
    letters = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(kind & LETTER, out=letters[1:])
    n = letters[e] - letters[s]
    pure, mixed = n == e - s, (n > 0) & (n < e - s)
    odd = np.flatnonzero(kind & AT)
    colon = np.flatnonzero(cp[:-2] == 58) if len(cp) > 2 else odd[:0]
    odd = np.concatenate([odd, colon[(cp[colon + 1] == 47) & (cp[colon + 2] == 47)]])
    slow: list[tuple[int, int]] = []
    if len(odd):  # a unit with one of these may hold other characters than a chunk's, but no white space
        blank = np.concatenate([[-1], np.flatnonzero(kind & BLANK), [len(cp)]])
        k = np.unique(np.searchsorted(blank, odd))
        first, last = blank[k - 1] + 1, blank[k]
        at = np.searchsorted(first, s, "right") - 1
        own = (at >= 0) & (s < last[np.maximum(at, 0)])
        pure, mixed = pure & ~own, mixed & ~own
        slow += zip(first.tolist(), last.tolist(), strict=True)
    slow += zip(s[mixed].tolist(), e[mixed].tolist(), strict=True)
    if not slow:
        return s[pure], e[pure]
    more = np.array([(a + x, a + y) for a, b in slow for x, y in _letters_only(characters(cp[a:b]))], np.int64).reshape(-1, 2)
    s, e = np.concatenate([s[pure], more[:, 0]]), np.concatenate([e[pure], more[:, 1]])
    order = np.argsort(s, kind="stable")
    return s[order], e[order]


def pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """(first, last) ranges of texts that together hold at most WINDOW code points, one text at least."""
    i = 0
    while i < len(texts):
        j, size = i + 1, len(texts[i])
        while j < len(texts) and size + len(texts[j]) <= WINDOW:
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def joined(texts: list[str]) -> tuple[str, np.ndarray]:
    """(texts with a line feed after each, where each begins and all end)."""
    return "".join(f"{t}\n" for t in texts), np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])


def lowered(s: str, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points in lower case, begins): lower case may be longer."""
    low = s.lower()
    if len(low) != len(s):
        low, begins = joined([s[a : b - 1].lower() for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)])
    return code_points(low), begins


def canonical(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of text.canonicalize() of each text but for the width of its spaces, begins)."""
    s, begins = joined(texts)
    cp = code_points(s)
    _, drop, space = tables()
    keep = ~drop[cp]
    at = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    cp = cp[keep]
    return lowered(characters(np.where(space[cp], np.uint32(32), cp)), at[begins])


def heads(texts: list[str], n: int) -> Iterator[tuple[int, int, list[str], np.ndarray, np.ndarray]]:
    """Ranges (i, j) of texts with the distinct first n letters of their tokens by text.tokenize(), the place of each token's
    among them, and where the tokens of each text begin and all end."""
    for i, j in pieces(texts):
        cp, begins = lowered(*joined(texts[i:j]))
        s, e = spans(cp)
        size = np.minimum(e - s, n)
        at, most = np.zeros(len(s), np.int64), 1
        for k in range(n):
            if most > 1 << 42:  # no room for another code point
                found = pa.array(at).dictionary_encode()
                at, most = found.indices.to_numpy().astype(np.int64), len(found.dictionary)
            at = (at << 21) | np.where(k < size, cp[np.minimum(s + k, len(cp) - 1)], 0)
            most <<= 21
        found = pa.array(at).dictionary_encode()
        at = found.indices.to_numpy()
        one = np.zeros(len(found.dictionary), np.int64)
        one[at] = np.arange(len(at))
        low = characters(cp)
        yield i, j, [low[a:b] for a, b in zip(s[one].tolist(), (s + size)[one].tolist(), strict=True)], at, np.searchsorted(s, begins)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _packed(cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of the tokens alone, begin of each, place of each code point in its token)."""
    n = e - s
    begin = np.concatenate([[0], np.cumsum(n)])[:-1]
    place = np.arange(int(n.sum())) - np.repeat(begin, n)
    return cp[place + np.repeat(s, n)], begin, place


def word_hashes(cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each token."""
    if not len(s):
        return np.zeros(0, np.uint64)
    chars, begin, place = _packed(cp, s, e)
    out = _mix(np.add.reduceat((chars.astype(np.uint64) + np.uint64(1)) * _POW[np.minimum(place, LONG_WORD)], begin) + (e - s).astype(np.uint64))
    for k in np.flatnonzero(e - s > LONG_WORD).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(cp[s[k] : e[k]].tobytes(), digest_size=8).digest(), "little")
    return out


_SHIFT = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_SINE = [int(abs(np.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]
_INIT = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _md5_blocks(words: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The first two words of the md5 of padded messages: words is (16 * blocks, n) of uint32."""
    n = words.shape[1]
    state = [np.full(n, x, np.uint32) for x in _INIT]
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for m in range(blocks):
        a, b, c, d = (x.copy() for x in state)
        for i in range(64):
            if i < 16:
                np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
                g = i
            elif i < 32:
                np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
                g = (5 * i + 1) % 16
            elif i < 48:
                np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
                g = (3 * i + 5) % 16
            else:
                np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
                g = (7 * i) % 16
            f += a
            f += np.uint32(_SINE[i])
            f += words[16 * m + g]
            np.right_shift(f, np.uint32(32 - _SHIFT[i]), out=t)
            np.left_shift(f, np.uint32(_SHIFT[i]), out=f)
            f |= t
            f += b
            a, b, c, d, f = d, f, b, c, a  # a's array is free now
        for x, y in zip(state, (a, b, c, d), strict=True):
            x += y
    return state[0], state[1]


def md5_60(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The first 60 bits of the md5 of each raw[s:e], as dedup.portable_hash() has them."""
    out = np.zeros(len(s), np.int64)
    size = e - s
    blocks = (size + 72) // 64
    for k in (1, 2):
        rows = np.flatnonzero(blocks == k)
        if not len(rows):
            continue
        width = 64 * k
        view = np.lib.stride_tricks.sliding_window_view(np.concatenate([raw, np.zeros(width, np.uint8)]), width)
        place = np.arange(width)
        for i in range(0, len(rows), 8192):
            r = rows[i : i + 8192]
            m = view[s[r]] * (place < size[r, None])
            m[np.arange(len(r)), size[r]] = 0x80
            w = np.ascontiguousarray(m.view("<u4").T)
            w[16 * k - 2] = size[r] * 8
            a, b = _md5_blocks(w, k)
            out[r] = ((a.byteswap().astype(np.uint64) << np.uint64(28)) | (b.byteswap() >> np.uint32(4))).astype(np.int64)
    for r in np.flatnonzero(blocks > 2).tolist():
        out[r] = int(hashlib.md5(raw[s[r] : e[r]].tobytes()).hexdigest()[:15], 16)
    return out


def _portable(cp: np.ndarray, s: np.ndarray, e: np.ndarray):
    """A function from token ranges (first, last) to md5_60() of the tokens joined by spaces."""
    n = e - s
    spaced = np.full(int(n.sum()) + len(n), 32, np.uint32)
    chars, begin, place = _packed(cp, s, e)
    begin = begin + np.arange(len(n))
    spaced[place + np.repeat(begin, n)] = chars
    wide = np.ones(len(spaced), np.int64)
    for limit in (0x80, 0x800, 0x10000):
        wide += spaced >= limit
    at = np.concatenate([[0], np.cumsum(wide)])
    raw = np.frombuffer(characters(spaced).encode(), np.uint8)
    return lambda first, last: md5_60(raw, at[begin[first]], at[begin[last - 1] + n[last - 1]])


EMPTY_MD5 = int(hashlib.md5(b"").hexdigest()[:15], 16)


def shingle_sets(texts: list[str], size: int = 5, portable: bool = False) -> Iterator[np.ndarray | None]:
    """Of each text the sorted distinct hashes of its shingles; None of a text without tokens."""
    for i, j in pieces(texts):
        cp, begins = canonical(texts[i:j])
        s, e = spans(cp)
        edge = np.searchsorted(s, begins)
        lo, hi = edge[:-1], edge[1:]
        count = hi - lo
        first = np.arange(max(0, len(s) - size + 1))
        if portable:
            of = _portable(cp, s, e)
            whole = np.flatnonzero((count > 0) & (count < size))
            # only runs within one text
            ends = np.repeat(hi, count)
            first = first[first + size <= ends[: len(first)]]
            grams, short = of(first, first + size), dict(zip(whole.tolist(), of(lo[whole], hi[whole]).tolist(), strict=True))
            at = np.searchsorted(first, lo)
        else:
            words = word_hashes(cp, s, e)
            grams = np.zeros(len(first), np.uint64)
            for k in range(size):
                grams = grams * _BASE + words[k : len(first) + k]
            grams, short, at = _mix(grams + np.uint64(size)).view(np.int64), None, lo
        for k, (a, b, n) in enumerate(zip(at.tolist(), lo.tolist(), count.tolist(), strict=True)):
            if n >= size:
                yield np.unique(grams[a : a + n - size + 1])
            elif n == 0:
                yield None
            elif portable:
                yield np.array([short[k]])
            else:
                h = np.array([n], np.uint64)
                for w in words[b : b + n]:
                    h = h * _BASE + w
                yield _mix(h + np.uint64(0x100)).view(np.int64)


def signatures(values: np.ndarray, begins: np.ndarray, coefficients: list[tuple[int, int]], prime: int) -> np.ndarray:
    """(sets, permutations): the least (a x + b) mod prime of each set values[begins[i]:begins[i + 1]]; zeros for an empty
    set. prime is below 2^31 and values are below it.

    The fraction ((a x + b) mod prime) / prime is what is left of x * ceil(2^64 a / prime) + ceil(2^64 b / prime) by wrapping,
    in units of 2^-64; both roundings add less than 2^32 of them, and two remainders differ by 2^33 or more. So fractions
    are ordered as remainders are, and only the least one is made a remainder."""
    n = len(begins) - 1
    out = np.zeros((len(coefficients), n), np.uint64)
    some = np.flatnonzero(begins[1:] > begins[:-1])
    at, i = begins[:-1][some], 0
    factors = [tuple(np.uint64(-((-c << 64) // prime)) for c in ab) for ab in coefficients]
    v = np.empty(2 * SIGNED, np.uint64)
    while i < len(some):
        j = max(i + 1, int(np.searchsorted(at, at[i] + SIGNED, "right")) - 1)
        end = int(begins[1:][some[j - 1]])
        low = np.full((len(coefficients), j - i), ~np.uint64(0))
        for start in range(int(at[i]), end, 2 * SIGNED):  # more than one block only where one set is longer
            x = values[start : min(start + 2 * SIGNED, end)]
            own, u = np.maximum(at[i:j] - start, 0), v[: len(x)]
            for k, (a, b) in enumerate(factors):
                np.multiply(x, a, out=u)
                u += b
                np.minimum(low[k], np.minimum.reduceat(u, own), out=low[k])
        half, p = np.uint64(32), np.uint64(prime)
        out[:, some[i:j]] = ((low >> half) * p + ((low & np.uint64(0xFFFFFFFF)) * p >> half)) >> half
        i = j
    return out.T.astype(np.int64)


PUNCTUATION, WHITE, UPPER, DIGIT, ALNUM, VISIBLE = 1, 2, 4, 8, 16, 32
#: No code points: dropped; of a lower case that is longer or depends on what stands around it.
DROPPED, SPECIAL = 0xFFFFFFFE, 0xFFFFFFFF
#: Characters that a pattern's $ leaves behind it and \s doesn't take.
LINE_ENDS = (0x85, 0x2028, 0x2029)
#: Cells of the table of sentences by characters; more are counted by sorting.
SEEN = 1 << 25


@cache
def sentence_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class bits of every code point, its form by text.fold_diacritics(), dropped by text.lookup_form(), its lower case or
    SPECIAL, its form by text.lookup_form() or DROPPED or SPECIAL)."""
    bits, fold, drop = np.full(0x110000, VISIBLE, np.uint8), np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
    lower = fold.copy()
    for cp in (*range(0x34000), *range(0xE0000, 0xE1000)):
        c, low = unicodedata.category(chr(cp)), chr(cp).lower()
        own = PUNCTUATION * (c[0] == "P") | UPPER * (c == "Lu") | DIGIT * (c == "Nd") | ALNUM * (c[0] in "LN") | VISIBLE * (c[0] != "Z")
        bits[cp], drop[cp], lower[cp] = own, c == "Mn", ord(low) if len(low) == 1 else SPECIAL
    lower[ord("Σ")] = SPECIAL
    bits[[*range(9, 14), *range(0x1C, 0x20), 0x85]] &= ~np.uint8(VISIBLE)
    bits[[ord(c) for c in " \t\n\x0b\f\r"]] |= WHITE
    source, target = folding_map()
    fold[[ord(c) for c in source]] = [ord(c) for c in target]
    drop[[ord(c) for c in "ʼ’'"]] = True
    return bits, fold, drop, lower, np.where(drop[fold], np.uint32(DROPPED), lower[fold])


def lower_points(cp: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """lowered() of the code points of texts with a line feed after each."""
    low = sentence_tables()[3][cp]
    return lowered(characters(cp), begins) if len(low) and low.max() == SPECIAL else (low, begins)


@cache
def _starts(phrases: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, list[str]]]:
    """(6-bit code of every code point, 1 and more for three codes that begin a phrase, which fourth codes may follow these,
    phrases by their first three characters)."""
    code, begin, by = np.zeros(0x110000, np.uint32), np.zeros(1 << 18, np.int16), {}
    for k, c in enumerate(sorted({c for p in phrases for c in p[:4]})):
        code[ord(c)] = 1 + k % 63
    fourth = np.zeros((1 + len(phrases), 64), bool)
    for p in phrases:
        if len(p) >= 3:
            a, b, c = (int(code[ord(x)]) for x in p[:3])
            at = a | b << 6 | c << 12
            begin[at] = begin[at] or begin.max() + 1
            fourth[begin[at], code[ord(p[3])] if len(p) > 3 else slice(None)] = True
            by.setdefault(p[:3], []).append(p)
    return code, begin, fourth, by


def occurrences(cp: np.ndarray, phrases: tuple[str, ...]) -> Iterator[tuple[int, str]]:
    """(place, phrase) wherever a phrase stands in cp, overlapping ones too."""
    code, begin, fourth, by = _starts(phrases)
    text, c = characters(cp), np.append(code[cp], np.uint32(0))
    if len(cp) > 2:
        three = begin[c[:-3] | c[1:-2] << np.uint32(6) | c[2:-1] << np.uint32(12)]
        where = np.flatnonzero(three)
        for at in where[fourth[three[where], c[where + 3]]].tolist():
            for p in by.get(text[at : at + 3], ()):
                if text.startswith(p, at):
                    yield at, p
    for p in phrases:
        at = text.find(p) if 0 < len(p) < 3 else -1
        while at >= 0:
            yield at, p
            at = text.find(p, at + 1)


def phrase_counts(cp: np.ndarray, begins: np.ndarray, phrases: tuple[str, ...]) -> np.ndarray:
    """text.substring_count(text.lookup_form()) of each of the texts that are joined() to cp; phrases are in that form."""
    _, fold, drop, _, form = sentence_tables()
    own = form[cp]
    top = own.max()
    if top >= DROPPED:
        keep = own != DROPPED
        out = np.flatnonzero(~keep)
        begins = begins - np.searchsorted(out, begins)
        own = own[keep]
    if top == SPECIAL:
        cp = fold[cp]
        own, begins = lowered(characters(cp[~drop[cp]]), begins)
    out = np.zeros(len(begins) - 1, np.int64)
    found = np.array([a for a, _ in occurrences(own, phrases)], np.int64)
    for k in np.unique(np.searchsorted(begins, found, "right") - 1).tolist():
        text = characters(own[begins[k] : begins[k + 1] - 1])
        out[k] = sum(text.count(p) for p in phrases)
    return out


def sentences(s: str, cp: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sentences by text.sentences() of all texts that are joined() to s: (their code points with a line feed after each,
    where each begins and all end, the place of each one's text)."""
    kind = sentence_tables()[0][cp]
    at = np.flatnonzero(kind & WHITE)
    at = at[1:] if len(at) and at[0] == 0 else at
    at = at[(kind[at - 1] & PUNCTUATION) != 0]
    at = at[~np.isin(at, begins[1:] - 1)]
    # the punctuation before white space has to hold a terminator after its last run of dots
    last = lambda where: np.concatenate([[-1], where])[np.searchsorted(where, at)]
    dot = cp == 46
    after = np.maximum(last(np.flatnonzero((kind & PUNCTUATION) == 0)), last(np.flatnonzero(dot[1:] & dot[:-1]) + 1))
    at = at[last(np.flatnonzero(dot | (cp == 33) | (cp == 63))) > after]
    marks = np.flatnonzero(cp == 0x1E) + 1  # a separator that the profile uses itself
    start = np.unique(np.concatenate([begins[:-1][np.diff(begins) > 1], at, marks]))
    owner = np.searchsorted(begins, start, "right") - 1
    text_end, follow = begins[owner + 1] - 1, np.append(start[1:], len(cp))
    end = np.minimum(follow, text_end)
    marked = (follow <= text_end) & (cp[end - 1] == 0x1E)
    end -= marked
    if "\x1d" in s:
        out = [s[a:b].replace("\x1d", "") for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        out, begins = joined([x[1:] if x.startswith(" ") else x for x in out])
        return code_points(out), begins, owner
    # what stands in no sentence: its first blank, such separators and the line feeds between texts
    keep, blank = np.ones(len(cp), bool), (end > start) & (cp[start] == 32)
    keep[start[blank]] = keep[end[marked]] = keep[begins[1:] - 1] = False
    at = np.concatenate([[0], np.cumsum(end - start - blank + 1)])
    out, inside = np.full(at[-1], 10, np.uint32), np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    out[inside] = cp[keep]
    return out, at, owner


#: Counts and ratios of a sentence that are summed over a text.
SUMS = ("n_sentences", "n_upper", "n_digits", "n_words", "n_chars", "n_alnum", "n_symbols", "n_word_chars", "n_stop", "lorem", "ellipsis", "bullet", "no_terminal", "curly", "legal", "javascript", "capital", "capital_words")
RATIOS = ("char_rep", "word_rep")
#: All that text_counts() has of a text.
COUNTS = (*SUMS, *RATIOS, "max_words", "min_words", "bad")


def _distinct(owner: np.ndarray, item: np.ndarray, owners: int, items: int) -> np.ndarray:
    """The number of different items of each owner."""
    key = owner.astype(np.int64) * items + item
    if owners * items <= SEEN:
        seen = np.zeros(owners * items, bool)
        seen[key] = True
        return np.count_nonzero(seen.reshape(owners, items), axis=1)
    return np.bincount(pa.array(key).unique().to_numpy() // items, minlength=owners)


def _share(distinct: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, 1 - distinct / np.maximum(n, 1), 0.0)


@cache
def _hashes(words: tuple[str, ...]) -> np.ndarray:
    s, begins = joined(list(words))
    return word_hashes(code_points(s), begins[:-1], begins[1:] - 1)


def sentence_counts(cp: np.ndarray, begins: np.ndarray, stopwords: tuple[str, ...], legal: tuple[str, ...], only: tuple[str, ...] = COUNTS) -> dict[str, np.ndarray]:
    """The counts of metrics.sentence_counts() for each of the sentences joined() to cp; those of only, and what comes with them."""
    n, first, end = len(begins) - 1, begins[:-1], begins[1:] - 1
    out = {"n_sentences": np.ones(n, np.int64), "n_chars": end - first}
    asked = lambda *names: any(c in only for c in names)
    kind = sentence_tables()[0][cp] if asked("n_upper", "n_digits", "n_alnum", "n_symbols", "char_rep", "ellipsis", "bullet", "no_terminal", "capital", "capital_words") else None

    def count(mask: np.ndarray) -> np.ndarray:
        at = np.zeros(len(cp) + 1, np.int32)
        np.cumsum(mask, out=at[1:], dtype=np.int32)
        return (at[begins[1:]] - at[first]).astype(np.int64)

    if asked("n_upper"):
        out["n_upper"] = count((kind & UPPER) != 0)
    if asked("n_digits"):
        out["n_digits"] = count((kind & DIGIT) != 0)
    if asked("n_alnum"):
        out["n_alnum"] = count((kind & ALNUM) != 0)
    if asked("n_symbols"):
        out["n_symbols"] = count((kind & (VISIBLE | ALNUM)) == VISIBLE)
    if asked("char_rep"):
        visible = (kind & VISIBLE) != 0
        present = np.zeros(int(cp.max()) + 1, bool)
        present[cp] = True
        name = np.cumsum(present) - 1
        owner = np.repeat(np.arange(n, dtype=np.int32), end - first + 1)
        out["char_rep"] = _share(_distinct(owner[visible], name[cp[visible]], n, int(name[-1]) + 1), count(visible))
    if asked("curly"):
        out["curly"] = count(cp == 123) > 0
    if asked("ellipsis", "bullet", "no_terminal"):
        solid = np.flatnonzero((kind & WHITE) == 0)
        ends = end - ((end > first) & np.isin(cp[end - 1], LINE_ENDS))
        a, b = np.searchsorted(solid, first), np.searchsorted(solid, ends) - 1
        filled = np.append(solid, len(cp))[a] < end
        head = cp[np.where(filled, np.append(solid, 0)[a], 0)]
        tail = np.append(solid, -1)[b]
        inside = tail >= first
        dots = [(tail - k >= first) & (cp[np.maximum(tail - k, 0)] == 46) for k in range(3)]
        terminal = inside & np.isin(cp[np.maximum(tail, 0)], [ord(c) for c in ".!?\"”’»"])
        out |= {"ellipsis": dots[0] & dots[1] & dots[2], "bullet": filled & np.isin(head, [ord(c) for c in "-•*–—"]), "no_terminal": filled & ~terminal}

    flags = {k: v for k, v in (("lorem", ("lorem ipsum",)), ("javascript", ("javascript",)), ("legal", legal)) if asked(k)}
    words = asked("n_words", "n_word_chars", "max_words", "min_words", "n_stop", "word_rep", "capital", "capital_words")
    if words or flags:
        low, lower = lower_points(cp, begins)
    if words:
        x, y = spans(low)
        edge = np.searchsorted(x, lower)
        size = np.concatenate([[0], np.cumsum(y - x)])
        out |= {"n_words": np.diff(edge), "n_word_chars": size[edge[1:]] - size[edge[:-1]]}
    if asked("n_stop", "word_rep"):
        found = pa.array(word_hashes(low, x, y)).dictionary_encode()
        word, names = found.indices.to_numpy(), found.dictionary.to_numpy()
        of = np.repeat(np.arange(n), out["n_words"])
        out["word_rep"] = _share(_distinct(of, word, n, max(1, len(names))), out["n_words"])
        out["n_stop"] = np.bincount(of[np.isin(names, _hashes(stopwords))[word]], minlength=n)
    if asked("capital", "capital_words"):
        if len(low) != len(cp) or "://" in characters(cp):  # elsewhere case changes no token
            x, _ = spans(cp)
        of = np.searchsorted(begins, x, "right") - 1
        out["capital"] = np.bincount(of[(kind[x] & UPPER) != 0], minlength=n) > 0
        out["capital_words"] = np.where(out["capital"], out["n_words"], 0)
    if flags:
        hits = [*occurrences(low, tuple(dict.fromkeys(p for v in flags.values() for p in v)))]
        where = np.searchsorted(lower, np.array([h[0] for h in hits], np.int64), "right") - 1
        for flag, phrases in flags.items():
            out[flag] = np.bincount(where[np.array([h[1] in phrases for h in hits], bool)], minlength=n) > 0
    return out


def text_counts(texts: list[str], stopwords: tuple[str, ...], legal: tuple[str, ...], bad: tuple[str, ...], only: tuple[str, ...] = COUNTS) -> dict[str, np.ndarray]:
    """Those of COUNTS that are in only, of each text; zeros where there is no sentence."""
    out = {c: np.zeros(len(texts), np.float64 if c in RATIOS else np.int64) for c in COUNTS if c in only}
    for i, j in pieces(texts):
        s, begins = joined(texts[i:j])
        cp = code_points(s)
        if "bad" in out:
            out["bad"][i:j] = phrase_counts(cp, begins, bad)
        if out.keys() == {"bad"}:
            continue
        cp, begins, owner = sentences(s, cp, begins)
        if not len(owner):
            continue
        counts = sentence_counts(cp, begins, stopwords, legal, only)
        own, first = np.unique(owner, return_index=True)
        for c in out:
            if c in SUMS or c in RATIOS:
                out[c][i + own] = np.add.reduceat(counts[c].astype(out[c].dtype), first)
        for c, f in (("max_words", np.maximum), ("min_words", np.minimum)):
            if c in out:
                out[c][i + own] = f.reduceat(counts["n_words"], first)
    return out
