"""Streams of schedule rows: windowed counts, currency gate, newest run per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.session import scratch_path


def read_rows(spark: SparkSession, folder_or_file: str, time: str) -> DataFrame:
    """A parquet folder (or file) as a stream; the time column becomes a TIMESTAMP, as watermarks need."""
    schema = spark.read.parquet(folder_or_file).schema
    at = folder_or_file.rstrip("/")
    parent, name = at.rsplit("/", 1)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    files = stream.parquet(at) if _is_folder(spark, at) else spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(parent)
    return files.withColumn(time, F.col(time).cast("timestamp"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).isDirectory()


def run_once(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process what is there and give the sink's rows; state and sink lie in the shared folder."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", out)
    else:
        # each trigger holds the whole result, so the last one stands
        query = stream.writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(out))
    query = query.option("checkpointLocation", out + "-state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def window_counts(stream: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Rows per key and window of event time; state older than the watermark is dropped."""
    w = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n_rows"))
    return w.select(F.col("w.start").alias("window_start"), key, "n_rows")


def currency_gate(stream: DataFrame, time: str, since: str) -> DataFrame:
    """Stateless: rows from a day on."""
    return stream.filter(F.col(time) >= F.lit(since).cast("timestamp"))
