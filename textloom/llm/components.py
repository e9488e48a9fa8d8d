"""Connected components by alternating large-star and small-star steps, wholly as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import discard, materialise


def _state(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (u long, v long) -> (id, component): each id of an edge with the smallest id that edges reach.

    Self-loops, repeated edges and nulls are ignored. Each round is written to the shared folder, so no lineage grows;
    the number of rounds is logarithmic in practice. Minima are pre-aggregated and joins are plain equi-joins that
    adaptive execution may split, so a node with very many edges does not meet in one task.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialise(e, "edges")
    was = _state(e)
    for _ in range(max_rounds):
        if was[0] == 0:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x"))
        new = materialise(small.select("x.u", "x.v").where("u <> v").distinct(), "edges")
        now = _state(new)
        discard(e)
        e = new
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
