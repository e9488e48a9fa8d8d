"""Text kernels against hand-made cases and properties."""

import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import text as T


def value(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("v")).first().v


@pytest.mark.parametrize("text, want", [("Ñe’ẽ — “A”", "ñeẽ a"), ("g̃", "g"), ("a`b", "ab"), ("a…b", "ab"), ("a b", "a b"), ("  ", ""), ("$5+1", "$5+1"), (None, None)])
def test_canonicalize(spark, text, want):
    assert value(spark, text, T.canonicalize) == want


def test_canonicalize_switches(spark):
    assert value(spark, "Ñé, x", lambda c: T.canonicalize(c, strip_diacritics=True)) == "ne x"
    assert value(spark, "A-b", lambda c: T.canonicalize(c, remove_punctuation=False, convert_case=False)) == "A-b"


@pytest.mark.parametrize("text, want", [("va'ekue ab1 Ñande 😀", ["ñande"]), ("abc123", ["abc"]), ("", []), ("https://a.b/c me@x.yz @you #tag ok", ["ok"]), ("l'una buena-vista dos", ["dos"])])
def test_tokenize(spark, text, want):
    assert value(spark, text, T.tokenize) == want


@pytest.mark.parametrize("text, want", [("", [""]), ("a b c", ["a b c"]), ("a b c d e f", ["a b c d e", "b c d e f"]), ("x " * 10, ["x x x x x"])])
def test_shingles(spark, text, want):
    assert value(spark, text, lambda c: T.shingles(T.tokenize(c))) == want


@pytest.mark.parametrize("text, want", [
    ('Hola. "Mundo!" 3.5 x... y\nB. C....\nD', ["Hola.", '"Mundo!"', "3.5 x... y\nB.", "C....\nD"]),
    ("Uno.\nDos", ["Uno.", "\nDos"]), ("", []), ("  ", [" "]), ("A b...\nC d.", ["A b...\nC d."]),
])
def test_sentences(spark, text, want):
    assert value(spark, text, T.sentences) == want


@pytest.mark.parametrize("url, want", [
    ("http://A.com:80/b;p?q=1#f", "http://a.com:80/b?q=1"), ("HTTP://A.COM//x//", "http://a.com//x"), ("www.x.com/", "http://www.x.com"),
    ("http://a.com/p;a/b;c", "http://a.com/p;a/b"), ("http://a.com/?", "http://a.com"), ("WWW.x.com", None), ("http:///x", None), ("mailto:x@y", None),
    ("NaN", None), (" none ", None), (None, None), ("", None),
])
def test_normalize_url(spark, url, want):
    got = value(spark, url, T.normalize_url)
    assert got == want and (got is None or value(spark, got, T.normalize_url) == got)


def test_strict_url_raises(spark):
    with pytest.raises(Exception, match="invalid URL"):
        value(spark, "mailto:x@y", lambda c: T.normalize_url(c, strict=True))


def test_jaccard(spark):
    rows = [(["a"], ["a"], 1.0), (["a"], ["b"], 0.0), ([], [], 0.0), (list("abcd"), list("abcde"), 0.8)]
    for r in spark.createDataFrame(rows, "a array<string>, b array<string>, want double").withColumn("j", T.jaccard(F.col("a"), F.col("b"))).collect():
        assert r.j == r.want


def test_phrases(spark):
    assert value(spark, "tembo tembo forro", lambda c: T.substring_count(c, ["tembo", "tembo forro", "tembo"])) == 5
    phrases = ["a.b", "a.bc", "ab", "ñ (x", "c", "c"]
    for t in ("", "zz", "a.bca.bab", "axb", "ñ (x ñ x", "aab cc", None):
        assert value(spark, t, lambda c: T.substring_count(c, phrases)) == (None if t is None else sum(t.count(p) for p in phrases))
    assert value(spark, "Aña Rembo’i", lambda c: T.lookup_form(c)) == "ana remboi"
    assert value(spark, "x", lambda c: T.extract_text(F.lit(None).cast("string"), F.lit(""), c)) == ""


alphabet = st.text(st.sampled_from("aZñÑéẽg̃ .!?'’“”—… \n\t-1#@_"), max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(alphabet, min_size=20, max_size=40))
def test_canonical_form_equals_its_definition(spark, texts):
    def define(t):
        t = "".join(c for c in t if unicodedata.category(c) != "Mn").translate(str.maketrans(T.QUOTES_FROM, T.QUOTES_TO)).replace("…", "...")
        t = "".join(" " if unicodedata.category(c)[0] == "Z" else "" if unicodedata.category(c)[0] == "P" else c for c in t).lower()
        return re.sub(r"\s+", " ", t).strip()

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", T.canonicalize("t").alias("c"), T.canonicalize(T.canonicalize("t")).alias("cc")).collect():
        assert r.c == define(r.t) == r.cc
