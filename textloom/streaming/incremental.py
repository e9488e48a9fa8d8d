"""Incremental forms of the batch operators over Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import dedup


def stream_documents(spark: SparkSession, path: str, schema: str, fmt: str = "json", max_files: int = 100) -> DataFrame:
    """Documents of files as they land in a folder."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(path)


def drop_repeated_urls(stream: DataFrame, url_col: str, time_col: str, delay: str = "1 day") -> DataFrame:
    """Rows with a valid URL that didn't come within the delay before; state is dropped behind the watermark."""
    return stream.withColumn("nurl", T.normalize_url(url_col)).where("nurl is not null").withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["nurl"])


def word_counts(stream: DataFrame, time_col: str, window: str = "1 hour", delay: str = "10 minutes", text_col: str = "text") -> DataFrame:
    """(window, token, n) over event time."""
    tokens = stream.withWatermark(time_col, delay).select(time_col, F.explode(T.tokenize(text_col)).alias("token"))
    return tokens.groupBy(F.window(time_col, window), "token").agg(F.count("*").alias("n"))


def near_duplicate_writer(index_path: str, pairs_path: str, id_col: str, threshold: float = 0.8, num_perm: int = 128, text_col: str = "text"):
    """A foreachBatch function: each batch is paired with itself and with the index kept so far, verified pairs and the
    batch's index rows are written under its number. A batch that is repeated replaces its own rows."""
    b, r = dedup.lsh_params(threshold, num_perm)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        sets = dedup.shingle_sets(batch, id_col, text_col, exclude_empty=True)
        rows = dedup.bucket_table(dedup.classes(sets).select("id", "h", dedup.signature_udf(b * r)(F.col("h")).alias("sig")), b, r)
        path = f"{index_path}/batch={number}"
        sets.select("id", "h", "n").write.mode("overwrite").parquet(f"{path}/sets")
        rows.write.mode("overwrite").parquet(f"{path}/buckets")
        mine = spark.read.schema("band int, bucket long, id long").parquet(f"{path}/buckets")
        numbers = range(number + 1)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

        def there(p: str) -> bool:
            q = jvm.org.apache.hadoop.fs.Path(p)
            return q.getFileSystem(conf).exists(q)

        known = [f"{index_path}/batch={k}" for k in numbers if there(f"{index_path}/batch={k}/sets/_SUCCESS")]
        every = spark.read.schema("band int, bucket long, id long").parquet(*(f"{p}/buckets" for p in known))
        near = mine.withColumnRenamed("id", "x").join(every.withColumnRenamed("id", "y"), ["band", "bucket"]).where("x <> y")
        near = near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        all_sets = spark.read.schema("id long, h array<long>, n int").parquet(*(f"{p}/sets" for p in known))
        dedup.verify(near, all_sets, threshold).write.mode("overwrite").parquet(f"{pairs_path}/batch={number}")

    return write
