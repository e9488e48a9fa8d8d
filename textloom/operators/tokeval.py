"""Tokenizer evaluation: fertility and continued words, on a long table of (tokenizer, document) rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def segment(text: Column, punctuation: bool = False) -> Column:
    """Words by letters, digits and marks; punctuation and symbols as single units if asked for."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}\p{N}_]+" + (r"|[^\p{L}\p{M}\p{N}_\s]" if punctuation else "")), F.lit(0))


def fertility(num_words: Column, num_tokens: Column) -> Column:
    """Tokens per word; null without words."""
    return F.try_divide(num_tokens, num_words)


def continued_words(tokens: Column, non_empty_continues: bool = False) -> Column:
    """Number of words that more than one token continues: a non-empty token without a leading space counts if the token
    before it didn't. non_empty_continues takes any non-empty token as a continuation."""
    def step(a, t):
        goes_on = (t != "") & a["new"] & (F.lit(True) if non_empty_continues else ~t.startswith(" "))
        return F.when(goes_on, F.struct((a["n"] + 1).alias("n"), F.lit(False).alias("new"))).otherwise(F.struct(a["n"].alias("n"), F.lit(True).alias("new")))

    return F.aggregate(tokens, F.struct(F.lit(0).alias("n"), F.lit(True).alias("new")), step, lambda a: a["n"])


def continued_words_aligned(tokens: Column, words: Column) -> Column:
    """Number of words that several tokens make up, by aligning tokens greedily to words by their length."""
    def word(a, w):
        left = F.slice(tokens, a["i"] + 1, F.size(tokens))
        taken = F.aggregate(left, F.struct(F.lit(0).alias("n"), F.lit(0).alias("len")), lambda b, t: F.when(b["len"] < F.length(w), F.struct((b["n"] + 1).alias("n"), (b["len"] + F.length(t)).alias("len"))).otherwise(b))["n"]
        return F.struct((a["i"] + taken).alias("i"), (a["k"] + F.when(taken > 1, 1).otherwise(0)).alias("k"))

    return F.aggregate(words, F.struct(F.lit(0).alias("i"), F.lit(0).alias("k")), word, lambda a: a["k"])


def greedy_tokenizer(vocabulary: list[str]) -> Callable[[Column], Column]:
    """A toy sub-word tokenizer of built-in functions: longest match first, else one character."""
    longest = sorted(dict.fromkeys(vocabulary), key=lambda v: (-len(v), v))
    special = ".*+?^$()[]{}|\\"
    escaped = ["".join("\\" + c if c in special else c for c in v) for v in longest]
    return lambda text: F.regexp_extract_all(text, F.lit("|".join([*escaped, r"[\s\S]"])), F.lit(0))


def library_tokenizer(path: str) -> Callable[[Column], Column]:
    """Decoded tokens by a tokenizer.json file, loaded once in each worker."""
    loaded: dict = {}

    @F.pandas_udf("array<string>")
    def encode(texts):
        if path not in loaded:
            from tokenizers import Tokenizer

            loaded[path] = Tokenizer.from_file(path)
        t = loaded[path]
        return texts.fillna("").map(lambda x: [t.decode([i], skip_special_tokens=False) for i in t.encode(x, add_special_tokens=False).ids])

    encode_plain = encode
    return lambda text: encode_plain(text)


def run_experiment(docs: DataFrame, tokenizers: dict[str, Callable[[Column], Column]], words: Column, id_col: str, text_col: str = "text", sample: float | None = None, seed: int = 7, aligned: frozenset[str] = frozenset()) -> DataFrame:
    """(tokenizer, id, num_words, num_tokens, num_continued) for each tokenizer and document; sample draws a share of rows."""
    rows = docs.sample(sample, seed) if sample is not None else docs
    out = None
    for name, encode in tokenizers.items():
        part = rows.select(F.lit(name).alias("tokenizer"), F.col(id_col).alias("id"), words.cast("long").alias("num_words"), encode(F.col(text_col)).alias("t"), segment(F.col(text_col), True).alias("w"))
        cont = continued_words_aligned(F.col("t"), F.col("w")) if name in aligned else continued_words(F.col("t"))
        part = part.select("tokenizer", "id", "num_words", F.size("t").cast("long").alias("num_tokens"), cont.cast("long").alias("num_continued"))
        out = part if out is None else out.union(part)
    return out


def fertility_summary(long: DataFrame, target: list[str] = []) -> DataFrame:  # noqa: B006
    """One row for each tokenizer: type, micro and macro fertility, totals, means, and rounded forms."""
    rows = long.groupBy("tokenizer").agg(
        F.sum("num_words").alias("total_words"), F.sum("num_tokens").alias("total_tokens"), F.avg("num_words").alias("avg_words"), F.avg("num_tokens").alias("avg_tokens"),
        F.avg(fertility(F.col("num_words"), F.col("num_tokens"))).alias("macro_fertility"), F.avg(F.try_divide("num_continued", "num_words")).alias("avg_prop_continued_words"),
    )
    kind = F.when(F.col("tokenizer").isin(*target), "gn").otherwise("general") if target else F.lit("general")
    score = F.try_divide("total_tokens", "total_words")
    return rows.select("tokenizer", kind.alias("type"), score.alias("fertility_score"), F.round(score, 4).alias("fertility_txt"), "macro_fertility", "total_words", "total_tokens", "avg_words", "avg_tokens", F.round("avg_tokens", 4).alias("avg_tokens_txt"), "avg_prop_continued_words", F.round("avg_prop_continued_words", 4).alias("avg_prop_continued_words_txt"))


def preview(tokens: Column, n: int) -> Column:
    """The first n tokens."""
    return F.slice(tokens, 1, n)
