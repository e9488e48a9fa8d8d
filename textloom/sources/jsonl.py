"""Readers: JSON-lines corpora, single files, dimension tables and word lists. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import text as T
from textloom.sources.shared import snapshot

RAW = "text string, sentence string, content string, url string, id string, num_words_split long, num_chars long, duplicate struct<minhash: struct<has_duplicate: boolean>>"


def read_corpora(spark: SparkSession, path: str, schema: str = RAW, on_blank: str = "skip", exact_types: bool = False) -> DataFrame:
    """All *.jsonl files of a folder (not below it) as one table, with `corpus`, the file's stem, and `record`, the whole line.

    Unknown keys are kept in record. Malformed JSON raises. Blank lines are skipped, or raise with on_blank="error". With
    exact_types a text, sentence or content that isn't a JSON string counts as missing instead of being turned into one.
    """
    lines = spark.read.format("text").option("pathGlobFilter", "*.jsonl").load(path)
    lines = lines.select("value", F.regexp_replace(F.col("_metadata.file_name"), r"\.jsonl$", "").alias("corpus"), F.col("_metadata.file_block_start").alias("__block"))
    blank = F.trim(F.regexp_replace("value", r"\s", "")) == ""
    if on_blank == "error":
        lines = lines.where(F.when(blank, F.raise_error(F.concat(F.lit("blank line in "), "corpus")).cast("boolean")).otherwise(True))
    else:
        lines = lines.where(~blank)
    lines = lines.withColumn("__seq", F.monotonically_increasing_id())
    rows = lines.withColumn("r", F.from_json("value", schema, {"mode": "FAILFAST"})).select("corpus", "__block", "__seq", F.col("value").alias("record"), "r.*")
    if exact_types:
        v = F.parse_json("record")
        for name in ("text", "sentence", "content"):
            kept = F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant")) == "STRING"
            rows = rows.withColumn(name, F.when(kept, F.try_variant_get(v, f"$.{name}", "string")))
    return rows


def assign_ids(docs: DataFrame, corpus_col: str = "corpus", order: tuple[str, ...] = ("__block", "__seq"), id_col: str = "id") -> DataFrame:
    """id = corpus_index, the 0-based place of the line in its corpus. Overwrites an existing id.

    Places come from counts by (corpus, partition), which are few, and a running number within each partition, so no
    corpus is gathered in one task. Without the reader's columns, pass the columns that order a corpus: rows are then
    range-partitioned and sorted by them, and the sorted table is kept in the shared folder."""
    if tuple(order) != ("__block", "__seq"):
        ranged = docs.repartitionByRange(F.col(corpus_col).asc(), *(F.col(c).asc() for c in order)).sortWithinPartitions(corpus_col, *order)
        rows = snapshot(ranged.withColumn("__seq", F.monotonically_increasing_id()), "ranged").withColumn("__part", F.shiftright(F.col("__seq"), 33))
        counts = rows.groupBy(corpus_col, "__part").agg(F.count("*").alias("n"), F.min("__seq").alias("first"))
        before = Window.partitionBy(corpus_col).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumnRenamed(corpus_col, "__corpus").drop("n")
        place = F.col("__seq") - F.col("first") + F.col("offset")
        out = rows.join(counts.withColumnRenamed("__part", "__p"), F.col(corpus_col).eqNullSafe(F.col("__corpus")) & (F.col("__part") == F.col("__p")))
        return out.withColumn(id_col, F.concat_ws("_", corpus_col, place)).select(*docs.columns, *([] if id_col in docs.columns else [id_col]))
    part = F.shiftright(F.col("__seq"), 33)
    # a partition may hold blocks of several files: number the lines of (corpus, block, partition), then add offsets
    keys = [corpus_col, "__block", "__part"]
    rows = docs.withColumn("__part", part)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("__seq").alias("first"))
    before = Window.partitionBy(corpus_col).orderBy("__block", "first").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).select(*keys, "offset")
    own = Window.partitionBy(*keys).orderBy("__seq")
    rows = rows.withColumn("__n", F.row_number().over(own) - 1).join(counts, keys)
    return rows.withColumn(id_col, F.concat_ws("_", corpus_col, F.col("__n") + F.col("offset"))).drop("__part", "__n", "offset")


def with_text(docs: DataFrame, text_col: str = "text", fields: tuple[str, ...] = ("text", "sentence", "content")) -> DataFrame:
    """text_col by the first of fields that is a string."""
    return docs.withColumn(text_col, T.extract_text(*(f for f in fields if f in docs.columns)))


def non_empty(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows with text; white space counts as text."""
    return docs.where(F.col(text_col) != "")


def init_flags(docs: DataFrame) -> DataFrame:
    """duplicate.minhash.has_duplicate = false, added to an existing struct or as a new one."""
    flag = F.struct(F.lit(False).alias("has_duplicate"))
    if "duplicate" not in docs.columns:
        return docs.withColumn("duplicate", F.struct(flag.alias("minhash")))
    old = F.coalesce("duplicate", F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema["duplicate"].dataType.fields)))
    return docs.withColumn("duplicate", old.withField("minhash", flag))


def corpus_sums(docs: DataFrame) -> DataFrame:
    """Words and characters over all records, by the upstream size fields."""
    return docs.agg(F.sum("num_words_split").alias("num_words"), F.sum("num_chars").alias("num_chars"), F.count("*").alias("records"))


def read_macro_codes(spark: SparkSession, path: str) -> DataFrame:
    """(M_Id, I_Id, I_Status) of a CSV with header; the code `nan` stays a string."""
    return spark.read.csv(path, header=True, schema="M_Id string, I_Id string, I_Status string", nullValue="", nanValue="")


def macro_map(codes: DataFrame):
    """A map column literal of individual to macro codes: a dimension of some hundred rows, refused beyond 100,000."""
    rows = codes.limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("too many codes for a literal map; join the table instead")
    pairs = [F.lit(x) for r in rows if r.I_Id is not None for x in (r.I_Id, r.M_Id)]
    return F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")


def read_experiment(spark: SparkSession, path: str) -> DataFrame:
    """(text, num_words_punct_spacy, ...) of a CSV whose texts hold line breaks and doubled quotes."""
    names = spark.read.csv(path, header=True, multiLine=True, escape='"').columns
    kinds = {"num_words_punct_spacy": "int"}
    return spark.read.csv(path, header=True, multiLine=True, escape='"', schema=", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in names))


MOST_WORDS = 100_000


def read_words(spark: SparkSession, path: str, dedup: bool = False) -> list[str]:
    """Entries of a word list: trimmed, lower-case, without empty lines and # comments; in file order, duplicates kept. A
    list of more than MOST_WORDS entries is an error, as it goes to the driver."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("i"), F.lower(F.trim("value")).alias("w")).where("w <> '' and w not like '#%'").orderBy("i").limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"{path} has more than {MOST_WORDS} entries")
    words = [r.w for r in rows]
    return list(dict.fromkeys(words)) if dedup else words
