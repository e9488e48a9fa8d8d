"""Operator 4 [native]: line de-duplication by a log-template tree, in DataFrame functions only.

A line's tokens that hold a digit are variable fields and become <*>. The tree has a fixed depth: token count, the two
leading tokens, then the template. A line of LONG or more tokens is entered under its own template and under the four in
which one quarter of its later tokens is a wildcard, so lines that differ in fields without digits meet as well.

A template recurs if it stands in MIN_CONTEXTS documents that pairwise differ elsewhere. A line's context is the SKETCH
least hashes of the document's words of LETTERS or more letters that the line doesn't hold; two contexts are near if they
share half of the larger one. Copies and near copies of one document are near each other, so that they alone never make a
line recur (they belong to document de-duplication); as differing documents are counted and no share is taken, copies and
repeats don't protect a line either. Recurring lines are dropped wherever they stand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import BROADCAST_IDS, free_name, load, materialise

MIN_TOKENS = 3
LONG = 8
LETTERS = 6
MIN_CONTEXTS = 3
SKETCH = 16
DEALT = 1024  # parts that a template's contexts are dealt into
FIELD = r"(?<!\S)[^\s0-9]*+[0-9]\S*"


def _tokens(line):
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, "<*>")).otherwise(line)
    return F.split(F.trim(masked), r"\s+")


def _hashes(t):
    """Of a token array: its size n, and hashes of the leading tokens (lead), of each quarter of the others (h) and, for a
    short line, of all; each is computed once here, and templates are put together from them."""
    n = F.size(t)
    q = F.ceil((n - 2) / F.lit(4)).cast("int")
    h = F.when(n >= LONG, F.array(*(F.xxhash64(F.slice(t, 3 + i * q, q)) for i in range(4))))
    return F.struct(n.alias("n"), F.xxhash64(n, F.when(n < LONG, t).otherwise(F.slice(t, 1, 2))).alias("lead"), h.alias("h"), _least_words(t).alias("m"))


def _keys(x):
    """Template hashes from _hashes()."""
    h = [x["h"][i] for i in range(4)]
    wild = [F.xxhash64(x["lead"], F.lit(i), *(h[k] for k in range(4) if k != i)) for i in range(4)]
    none = F.array().cast("array<long>")
    return F.when(x["n"] < MIN_TOKENS, none).when(x["n"] < LONG, F.array(x["lead"])).otherwise(F.array(F.xxhash64(x["lead"], *h), *wild))


def _least_words(t):
    return F.slice(F.sort_array(F.array_distinct(F.transform(F.filter(t, lambda w: F.length(w) >= LETTERS), lambda w: F.hash(w)))), 1, SKETCH)


def _differing(contexts):
    """Up to MIN_CONTEXTS of an array of contexts, none near another; those of least order are taken first."""
    def step(found, x):
        near = F.exists(found, lambda y: 2 * F.size(F.array_intersect(x, y)) >= F.greatest(F.size(x), F.size(y)))
        return F.when((F.size(found) >= MIN_CONTEXTS) | near, found).otherwise(F.concat(found, F.array(x)))

    return F.aggregate(F.sort_array(contexts), F.array().cast("array<array<int>>"), step)


def recurring(uses: DataFrame) -> DataFrame:
    """The keys of recurring templates, of (key, words) rows. Equal contexts go first; the others are dealt by their hash
    and each part leaves MIN_CONTEXTS at most, so a hot template stays spread."""
    uses = uses.select("key", "words").distinct()
    parts = uses.groupBy("key", F.pmod(F.xxhash64("words"), F.lit(DEALT)).alias("part")).agg(F.collect_list("words").alias("words"))
    parts = parts.select("key", _differing(F.col("words")).alias("words")).groupBy("key").agg(F.collect_list("words").alias("words"))
    return parts.where(F.size(_differing(F.flatten("words"))) >= MIN_CONTEXTS).select("key")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dropped_col: str = "__dropped") -> DataFrame:
    """docs with text_col rid of recurring lines, and a last column dropped_col int, the number of lines dropped; the name
    gets underscores before it where docs has such a column.

    A null text stays null and an empty one empty, with 0 dropped; rows of equal id and text are treated alike, whatever
    their other columns, which stay as they are. A text whose every line recurs becomes empty. An empty table stays so.
    """
    dropped_col, rid, h = free_name(docs, dropped_col), free_name(docs, "rid"), free_name(docs, "h")
    drop_col = free_name(docs, "drop")
    named = docs.withColumns({rid: F.xxhash64(F.col(id_col), F.col(text_col)), h: F.hash(F.col(text_col), F.col(id_col))})
    rows = named.select(F.col(rid).alias("rid"), F.col(h).alias("h"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows = rows.select("rid", "h", F.split("text", "\n", -1).alias("lines"))
    per_doc = rows.select("rid", "h", F.transform("lines", _tokens).alias("ts"))
    per_doc = per_doc.select("rid", "h", F.transform("ts", _hashes).alias("ls"))
    # a line has SKETCH hashes at most, so those that remain without a line's own are among the 2 * SKETCH least
    least = F.slice(F.sort_array(F.array_distinct(F.flatten(F.transform("ls", lambda x: x["m"])))), 1, 2 * SKETCH)
    per_doc = per_doc.select("rid", "h", "ls", least.alias("least"))
    # not posexplode(): its inferred filter on the array's size would compute every hash twice; a text has a line at least
    lines = per_doc.select("rid", "h", F.posexplode_outer("ls").alias("pos", "l"), "least").where(F.col("l.n") >= MIN_TOKENS)
    lines = lines.select("rid", "h", "pos", _keys(F.col("l")).alias("keys"), F.slice(F.array_except("least", "l.m"), 1, SKETCH).alias("words"))
    lines = materialise(lines.withColumn("ctx", F.xxhash64("words")), "lines")

    some = lines.select(F.explode("keys").alias("key"), "ctx").distinct().groupBy("key").agg(F.count("*").alias("n"))
    some = materialise(some.where(F.col("n") >= MIN_CONTEXTS).select("key"), "candidates")
    side = F.broadcast(some) if some.count() <= BROADCAST_IDS else some
    uses = materialise(lines.select("rid", "h", "pos", "words", F.explode("keys").alias("key")).join(side, "key", "left_semi"), "uses")
    keys = materialise(recurring(uses), "templates")
    side = F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
    hit = uses.select("rid", "h", "pos", "key").join(side, "key", "left_semi")
    drop = materialise(hit.groupBy("rid", "h").agg(F.collect_set("pos").alias("drop")), "drops")
    drop = drop.withColumnsRenamed({"rid": rid, "h": h, "drop": drop_col})
    # one plan at every size: positions grow with the documents, so they are never broadcast; texts are dealt, not sorted
    out = named.join(drop.hint("shuffle_hash"), [rid, h], "left")
    text = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.array_contains(F.col(drop_col), i)), "\n")
    out = out.withColumns({text_col: F.when(F.col(drop_col).isNull(), F.col(text_col)).otherwise(text), dropped_col: F.coalesce(F.size(drop_col), F.lit(0))})
    return out.select(*docs.columns, dropped_col)


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs, dropped_col="n_dropped")


#: The SQL's rule is that of least words: one word is a context, and contexts have to be this share of uses. README tells where results differ.
MIN_SHARE = 0.3
ORACLE = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, pos, line, regexp_split_to_array(trim(regexp_replace(line, '[^\s0-9]*[0-9]\S*', '<*>', 'g')), '\s+') AS t FROM l),
m AS (
  SELECT *, len(t) AS n, CAST(ceil((len(t) - 2) / 4.0) AS BIGINT) AS q,
    list_min(list_transform(list_filter(t, lambda w: length(w) >= {LETTERS}), lambda w: md5(w))) AS m
  FROM t),
c AS (
  SELECT *, (SELECT min(o.m) FROM m o WHERE o.doc_id = m.doc_id AND o.pos <> m.pos) AS ctx FROM m),
k AS (
  SELECT doc_id, pos, coalesce(ctx, '') AS ctx, unnest(CASE
    WHEN n < {MIN_TOKENS} THEN []
    WHEN n < {LONG} THEN ['s' || array_to_string(t, ' ')]
    ELSE ['o' || array_to_string(t, ' '),
      '0' || array_to_string(list_concat(t[1:2], ['*'], t[3+q:n]), ' ') || ' ' || n,
      '1' || array_to_string(list_concat(t[1:2+q], ['*'], t[3+2*q:n]), ' ') || ' ' || n,
      '2' || array_to_string(list_concat(t[1:2+2*q], ['*'], t[3+3*q:n]), ' ') || ' ' || n,
      '3' || array_to_string(list_concat(t[1:2+3*q], ['*'], t[3+4*q:n]), ' ') || ' ' || n] END) AS key
  FROM c),
r AS (
  SELECT key FROM k GROUP BY key
  HAVING count(DISTINCT ctx) >= {MIN_CONTEXTS} AND count(DISTINCT ctx) >= {MIN_SHARE} * count(*)),
d AS (SELECT DISTINCT doc_id, pos FROM k WHERE key IN (SELECT key FROM r))
SELECT o.doc_id, CASE WHEN o.text IS NULL THEN NULL ELSE coalesce(x.text, '') END AS text, CAST(coalesce(x.n, 0) AS INTEGER) AS n_dropped
FROM documents o LEFT JOIN (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE d.pos IS NULL) AS text, count(d.pos) AS n
  FROM l LEFT JOIN d ON l.doc_id = d.doc_id AND l.pos = d.pos GROUP BY l.doc_id) x ON o.doc_id = x.doc_id
"""
