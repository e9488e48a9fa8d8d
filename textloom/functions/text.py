"""Text kernels as Column functions: canonical form, tokens, shingles, sentences, character classes, URLs.

All are built-in expressions that run in the JVM; TEXT PROFILES below are the specification, and textloom.plans holds
the same profiles in DuckDB's dialect.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that canonical text replaces by plain quotes and dashes.
QUOTES_FROM, QUOTES_TO = "’‘ʼ＇`“”„‟–—‐−", "'''''\"\"\"\"----"
# Values of a URL field that mean there is none.
NO_URL = ("", "unknown", "nan", "none")
#: The tokeniser's profile: what is consumed as one unit; units of letters only are tokens.
WORD_RE = (
    r"https?://[^\s]+|[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+|[@#][\p{L}\p{N}_]+"
    r"|\p{L}(?:[\p{L}\p{M}'\-_])+\p{L}|[\p{L}\p{M}\p{N}_]+"
)
SPACE = r"[\s\x0b\x1c-\x1f\x85]+"
URL_RE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)(\?[^#]*)?"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f) -> Column:
    """f(value) with value computed once, however often f uses it and wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


@cache
def folding_map() -> tuple[str, str]:
    """(from, to): every code point whose canonical decomposition without marks is one other character."""
    pairs = []
    for cp in range(0x110000):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        d = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(d) == 1 and d != c:
            pairs.append((c, d))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


def fold_diacritics(text: Column | str) -> Column:
    """text without diacritics: decomposable letters become their base, free-standing marks go."""
    return F.regexp_replace(F.translate(_col(text), *folding_map()), r"\p{Mn}", "")


def lookup_form(text: Column | str) -> Column:
    """Folded, without apostrophes, lower-case: the form in which offensive phrases are looked up."""
    return F.lower(F.regexp_replace(fold_diacritics(text), "[ʼ’']", ""))


def canonicalize(text: Column | str, replace_separators: bool = True, remove_punctuation: bool = True, convert_case: bool = True, strip_diacritics: bool = False) -> Column:
    """Canonical text: marks dropped, quotes and dashes unified, separators to spaces, punctuation removed, lower case,
    white space collapsed. Precomposed letters stay, unless strip_diacritics asks for the full folding."""
    t = fold_diacritics(text) if strip_diacritics else F.regexp_replace(_col(text), r"\p{Mn}", "")
    t = F.regexp_replace(F.translate(t, QUOTES_FROM, QUOTES_TO), "…", "...")
    if replace_separators:
        t = F.regexp_replace(t, r"\p{Z}", " ")
    if remove_punctuation:
        t = F.regexp_replace(t, r"\p{P}", "")
    if convert_case:
        t = F.lower(t)
    return F.trim(F.regexp_replace(t, SPACE, " "))


def tokenize(text: Column | str, preserve_case: bool = False) -> Column:
    """Tokens of letters only; units that hold anything else are dropped whole."""
    t = _col(text) if preserve_case else F.lower(_col(text))
    return F.filter(F.regexp_extract_all(t, F.lit(WORD_RE), F.lit(0)), lambda x: x.rlike(r"^\p{L}+$"))


def shingles(tokens: Column, size: int = 5) -> Column:
    """Distinct runs of size tokens joined by spaces; fewer tokens give one shingle of all; none gives the empty string."""

    def of(tk: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(tk) - size), lambda i: F.array_join(F.slice(tk, i + 1, size), " "))
        return F.when(F.size(tk) < size, F.array(F.array_join(tk, " "))).otherwise(F.array_distinct(runs))

    return let(tokens, of)


def sentences(text: Column | str) -> Column:
    """Sentences by the dot-preserving profile: a terminator with closing punctuation ends one before white space, an
    ellipsis doesn't. An empty text has none."""
    t = _col(text)
    marked = F.regexp_replace(F.regexp_replace(t, r"(\.{2,})", "$1\x1d"), r"([.!?]+\p{P}*)(\s)", "$1\x1e$2")
    pieces = F.transform(F.split(marked, "\x1e", -1), lambda x: F.regexp_replace(F.regexp_replace(x, "\x1d", ""), "^ ", ""))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(pieces)


def uppercase_count(s: Column) -> Column:
    return F.regexp_count(s, F.lit(r"\p{Lu}"))


def digit_count(s: Column) -> Column:
    return F.regexp_count(s, F.lit(r"\p{Nd}"))


def alphanumeric_count(s: Column) -> Column:
    return F.regexp_count(s, F.lit(r"[\p{L}\p{N}]"))


def symbol_count(s: Column) -> Column:
    return F.regexp_count(s, F.lit(r"[^\p{L}\p{N}\p{Z}\t-\r\x1c-\x1f\x85]"))


def distinct_share(items: Column) -> Column:
    """1 - distinct / all, 0 for an empty array."""
    return F.when(F.size(items) > 0, 1 - F.size(F.array_distinct(items)) / F.size(items)).otherwise(F.lit(0.0))


def visible_characters(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit(r"[^\p{Z}\t-\r\x1c-\x1f\x85]"), F.lit(0))


def contained_in(tokens: Column, words: list[str]) -> Column:
    """Number of tokens that are in words."""
    known = F.array(*map(F.lit, dict.fromkeys(words)))
    return F.size(F.filter(tokens, lambda x: F.array_contains(known, x)))


def substring_count(text: Column, phrases: list[str]) -> Column:
    """Sum over phrases of their non-overlapping occurrences in text; a phrase given twice counts twice. Phrases are
    counted one by one only in texts that hold any."""
    # a phrase that holds another one is found by that one
    shortest = [p for p in dict.fromkeys(phrases) if not any(q != p and q in p for q in phrases)]

    def of(t: Column) -> Column:
        once = lambda p: F.floor((F.length(t) - F.length(F.replace(t, p, F.lit("")))) / F.length(p))
        counts = F.aggregate(F.array(*map(F.lit, phrases)), F.lit(0).cast("long"), lambda a, p: a + once(p))
        return F.when(~contains_any(t, shortest), F.lit(0).cast("long")).otherwise(counts)

    return let(text, of)


def contains_any(text: Column, phrases: list[str]) -> Column:
    out = F.lit(False)
    for p in dict.fromkeys(phrases):
        out = out | text.contains(p)
    return out


def extract_text(*fields: Column | str) -> Column:
    """The first field that is a string, even an empty one; else the empty string."""
    return F.coalesce(*map(_col, fields), F.lit(""))


def normalize_url(url: Column | str, strict: bool = False) -> Column:
    """Lower-case scheme and host, no trailing slashes, parameters or fragment; null for a missing or invalid URL, which
    strict raises as an error."""
    u = F.regexp_replace(_col(url), r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$", "")
    u = F.regexp_replace(u, "[\t\r\n]", "")
    w = F.when(u.startswith("www."), F.concat(F.lit("http://"), u)).otherwise(u)
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(w, URL_RE, 3), ";[^/]*$", ""), "/+$", "")
    query = F.regexp_extract(w, URL_RE, 4)
    out = F.concat(F.lower(F.regexp_extract(w, URL_RE, 1)), F.lit("://"), F.lower(F.regexp_extract(w, URL_RE, 2)), path, F.when(query == "?", "").otherwise(query))
    valid = ~F.lower(u).isin(*NO_URL) & w.rlike(URL_RE)
    bad = F.raise_error(F.concat(F.lit("invalid URL: "), F.coalesce(_col(url), F.lit("null")))) if strict else F.lit(None)
    return F.when(F.coalesce(valid, F.lit(False)), out).otherwise(bad)


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; 0 if both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))
