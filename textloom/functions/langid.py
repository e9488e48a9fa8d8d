"""Language predictions as Column functions: macro codes, clean-up of raw labels, and the vote of three models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREDICTIONS = "array<struct<code:string,conf:double>>"
# How a vote came about.
ALL_AGREE, TWO_AGREE, ALL_DIFFER, UNDECIDED, SEVERAL = "agree_glotlib_fasttext_openlid", "agree_fasttext_openlid", "all_different", "inconclusive", "not_applicable_k_greater_than_1"


def macro_code(code: Column, macro: Column) -> Column:
    """The code's macro-language by a map column, or the code itself."""
    return F.coalesce(F.try_element_at(macro, code), code)


def process_predictions(labels: Column, confidences: Column, macro: Column, on_collision: str = "last") -> Column:
    """Raw labels such as __label__xxx_Script and confidences to (code, conf) by falling confidence; null if there are none.

    Codes become macro codes. Where several labels share one, on_collision keeps the last confidence at the first's place
    ("last"), their sum ("sum") or the greatest ("max").
    """
    rows = F.transform(F.arrays_zip(labels.alias("l"), confidences.alias("c")), lambda x: F.struct(
        macro_code(F.regexp_extract(F.regexp_replace(x["l"], "^__label__", ""), "^([^_]*)", 1), macro).alias("code"), x["c"].cast("double").alias("conf")))
    firsts = F.array_distinct(F.transform(rows, lambda x: x["code"]))
    same = lambda c: F.filter(rows, lambda x: x["code"] == c)
    if on_collision == "sum":
        conf = lambda c: F.aggregate(same(c), F.lit(0.0), lambda a, x: a + x["conf"])
    elif on_collision == "max":
        conf = lambda c: F.array_max(F.transform(same(c), lambda x: x["conf"]))
    else:
        conf = lambda c: F.element_at(same(c), -1)["conf"]
    merged = F.transform(firsts, lambda c, i: F.struct((-conf(c)).alias("k"), i.alias("i"), c.alias("code")))
    out = F.transform(F.array_sort(merged), lambda x: F.struct(x["code"].alias("code"), (-x["k"]).alias("conf")))
    return F.when(F.size(labels) > 0, out)


def vote(glotlid: Column, fasttext: Column, openlid: Column, k: int = 1, precise_labels: bool = False) -> Column:
    """struct(top, languages, raw, source, voting) of three models' processed predictions.

    k = 1: two models that agree win, the first one's in preference; all different gives the first model's; else the vote
    is undecided and raw holds the three. k > 1: the first model's k best. precise_labels names two of three as such.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    g, f, o = (F.get(x, F.lit(0))["code"] for x in (glotlid, fasttext, openlid))
    none = F.lit(None)

    def result(top, languages, source, voting, raw=None):
        return F.struct(
            (none if top is None else F.get(top, F.lit(0))).cast("struct<code:string,conf:double>").alias("top"),
            (none if languages is None else languages).cast(PREDICTIONS).alias("languages"),
            (none if raw is None else raw).cast(f"struct<glotlid:{PREDICTIONS},fasttext:{PREDICTIONS},openlid:{PREDICTIONS}>").alias("raw"),
            (none if source is None else F.lit(source)).cast("string").alias("source"),
            F.lit(voting).alias("voting"),
        )

    if k > 1:
        return result(None, F.slice(glotlid, 1, k), "glotlid", SEVERAL)
    agree = ((g == f) | (g == o)) & g.isNotNull()
    label = F.when(g == f, F.when(g == o, ALL_AGREE).otherwise("agree_glotlid_fasttext")).otherwise("agree_glotlid_openlid") if precise_labels else F.lit(ALL_AGREE)
    first = result(glotlid, None, "glotlid", ALL_AGREE).withField("voting", label)
    raw = F.struct(glotlid.alias("glotlid"), fasttext.alias("fasttext"), openlid.alias("openlid"))
    return (
        F.when(F.coalesce(g, f, o).isNull(), none)
        .when(F.coalesce(agree, F.lit(False)), first)
        .when(F.coalesce((g != f) & (g != o) & (f != o), F.lit(False)), result(glotlid, None, "glotlid", ALL_DIFFER))
        .when(F.coalesce(f == o, F.lit(False)), result(openlid, None, "openlid", TWO_AGREE))
        .otherwise(result(None, None, None, UNDECIDED, raw))
    )
