"""Operator 7 [native]: mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with n rows and target weight p is repeated at the mean rate p N / n, so that N rows are expected in all. Each
row's number of copies inverts the Poisson distribution of that mean at a uniform number taken from a hash of the row
and the seed; copies are exploded and ordered by a hash of row, copy and seed, which is a global shuffle. The draw
depends on nothing but the row, so any partitioning gives the same result and a lost task repeats it. The hash is uniform,
so the ranges of the global sort are known beforehand: rows are drawn once, where sampling the ranges would draw them twice.

A rate above STEP is the sum of draws at rates of at most STEP, each with its own hash, so exp(-rate) never underflows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import BROADCAST_IDS, free_name, load, materialise

SEED = 17
STEP = 64
TEMPERATURE = 0.5  # default target: weights in proportion to n ** TEMPERATURE


def rates(docs: DataFrame, source_col: str, weights: dict[str, float] | None, total: float | None) -> DataFrame:
    """(source, rate, steps, cdf) of each source: a small table, counted with partial sums."""
    n = docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        w = F.pow(F.col("n").cast("double"), F.lit(TEMPERATURE))
    else:
        w = F.lit(0.0)
        for name, x in weights.items():
            w = F.when(F.col("source") == name, F.lit(float(x))).otherwise(w)
    n = materialise(n.withColumn("w", w), "sources")
    sums = n.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    if not sums.w:
        return n.select("source", F.lit(0.0).alias("rate"), F.lit(0).alias("steps"), F.array().cast("array<double>").alias("cdf"))
    all_rows = float(sums.n if total is None else total)
    n = n.withColumn("rate", F.col("w") / F.lit(sums.w) * F.lit(all_rows) / F.col("n"))
    n = n.withColumn("steps", F.ceil(F.col("rate") / STEP).cast("int")).withColumn("r", F.col("rate") / F.greatest(F.col("steps"), F.lit(1)))
    # cdf[j] = P(X <= j), as far as a uniform number of 48 bits can tell
    start = F.struct(F.exp(-F.col("r")).alias("p"), F.exp(-F.col("r")).alias("c"), F.array(F.exp(-F.col("r"))).alias("cdf"))

    def step(a, j):
        p = a["p"] * F.col("r") / j
        return F.struct(p.alias("p"), (a["c"] + p).alias("c"), F.concat(a["cdf"], F.array(a["c"] + p)).alias("cdf"))

    last = (F.col("r") + 12 * F.sqrt("r") + 30).cast("int")
    return n.select("source", "rate", "steps", F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["cdf"]).alias("cdf"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", copy_col: str = "__copy", order_col: str = "__order") -> DataFrame:
    """Rows of docs repeated to the target weights, in a global random order, with two last columns: copy_col int (from 1)
    and order_col string, by which the result is sorted. Either gets underscores before its name where
    docs has such a column already.

    weights: target weight by source; sources that it doesn't name get none and their rows go. None: in proportion to the
    square root of the source's rows. total: expected rows, by default as many as there are. A null source counts as the
    source ''. A row is drawn by its id and its text, nulls as empty strings, so rows without an id or with a repeated one
    are drawn apart; rows equal in both are drawn alike. An empty table stays empty; other columns stay as they are.
    """
    copy_col, order_col = free_name(docs, copy_col), free_name(docs, order_col)
    table = rates(docs, source_col, weights, total)
    wide = table.count() * (STEP + 12 * 8 + 40) <= BROADCAST_IDS
    name = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")) if text_col in docs.columns else F.lit("")
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"#{seed}#"), F.md5(text.cast("binary")))
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), name.alias("source"), key.alias("key"))
    if wide:
        out = rows.join(F.broadcast(table), "source")
    else:  # sources without number: a hot one is spread over salts
        salts = 64
        table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        out = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).join(table, ["source", "salt"])

    def draw(i):
        u = F.conv(F.substring(F.md5(F.concat("key", i.cast("string")).cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
        return F.size(F.filter("cdf", lambda c: c <= u))

    copies = F.aggregate(F.when(F.col("steps") > 0, F.sequence(F.lit(1), F.col("steps"))).otherwise(F.array().cast("array<int>")), F.lit(0), lambda a, i: a + draw(i))
    out = out.withColumn("copies", copies).where("copies > 0").select("row", "key", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    order = F.substring(F.md5(F.concat("key", F.lit("copy"), F.col("copy").cast("string")).cast("binary")), 1, 16)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)) * n).cast("int")
    out = out.select("row", "copy", order.alias("order")).repartitionById(n, place).sortWithinPartitions("order")
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns), F.col("copy").alias(copy_col), F.col("order").alias(order_col))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs, copy_col="copy", order_col="shuffle_key")


ORACLE = f"""
WITH RECURSIVE n AS (SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY 1),
r AS (
  SELECT source, pow(CAST(n AS DOUBLE), {TEMPERATURE}) / (SELECT sum(pow(CAST(n AS DOUBLE), {TEMPERATURE})) FROM n) * (SELECT CAST(sum(n) AS DOUBLE) FROM n) / n AS rate FROM n),
s AS (SELECT source, CAST(ceil(rate / {STEP}) AS INTEGER) AS steps, rate / greatest(CAST(ceil(rate / {STEP}) AS INTEGER), 1) AS r FROM r),
c AS (
  SELECT source, r, 0 AS j, exp(-r) AS p, exp(-r) AS c FROM s
  UNION ALL
  SELECT source, r, j + 1, p * r / (j + 1), c + p * r / (j + 1) FROM c WHERE j + 1 <= floor(r + 12 * sqrt(r) + 30)),
t AS (SELECT s.source, steps, list(c.c ORDER BY c.j) AS cdf FROM s JOIN c ON s.source = c.source GROUP BY s.source, steps),
d AS (
  SELECT doc_id, o.source, text, coalesce(CAST(doc_id AS VARCHAR), '') || '#{SEED}#' || md5(coalesce(text, '')) AS k, list_sum(list_transform(range(1, steps + 1), lambda i:
    len(list_filter(cdf, lambda x: x <= CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '#{SEED}#' || md5(coalesce(text, '')) || CAST(i AS VARCHAR)), 1, 12) AS BIGINT) AS DOUBLE) / {1 << 48}.0)))) AS copies
  FROM documents o JOIN t ON coalesce(o.source, '') = t.source),
e AS (SELECT *, unnest(range(1, CAST(copies AS BIGINT) + 1)) AS copy FROM d)
SELECT doc_id, source, text, CAST(copy AS INTEGER) AS copy, substr(md5(k || 'copy' || CAST(copy AS VARCHAR)), 1, 16) AS shuffle_key FROM e
"""
