"""Resumable ingestion as streams of files: each identifier once, each document segmented once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import strip
from ..functions.validate import valid_pmid
from ..operators.segment import segment


def new_records(spark: SparkSession, folder: str, schema: str, pmid: str = "PMID") -> DataFrame:
    """A stream of the rows with a valid identifier that was not seen before. There is no watermark:
    an identifier stays known for good."""
    rows = spark.readStream.schema(schema).option("header", True).csv(folder)
    return rows.where(valid_pmid(pmid)).withColumn("pmid", strip(F.col(pmid))).dropDuplicates(["pmid"])


def process_once(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "pmid") -> StreamingQuery:
    """Run ``work`` on new keys and append its rows to ``out``. Keys that ``out`` has already are left
    out, so a batch that is run again after a crash adds nothing twice."""
    schema: dict = {}

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(out)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            done = spark.read.schema(schema["out"]).parquet(out) if "out" in schema else spark.read.parquet(out)
            rows = rows.join(done.select(key).distinct(), key, "left_anti")
        result = work(rows)
        schema["out"] = result.schema
        result.write.mode("append").parquet(out)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def segment_arrivals(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Segment Markdown files as they arrive. Its windows are by document, not by time, so they run on
    each batch."""
    rows = spark.readStream.format("text").schema("value string").option("wholetext", True).option("pathGlobFilter", "*.md").load(folder)
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # a stream has it as in an address
    docs = rows.select(F.regexp_replace(name, r"\.md$", "").alias("doc_id"), F.col("value").alias("md"))
    return process_once(docs, lambda df: segment(df), out, checkpoint, key="doc_id")
