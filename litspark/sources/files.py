"""Files in and out: record tables, Markdown and PDF folders, structured JSON; reports and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.validate import pdf_reason


def read_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text, names stripped, fields as they are; ``row_no`` counts from 0 in file order
    within a file."""
    rows = spark.read.csv(path, header=True, sep=sep, inferSchema=False, multiLine=True, escape='"')
    rows = rows.toDF(*[c.strip() for c in rows.columns])
    return rows.withColumn("row_no", F.monotonically_increasing_id())


def read_markdown(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(doc_id, path, md): a row per Markdown file, named by its stem."""
    rows = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.md").option("recursiveFileLookup", recursive).load(path)
    name = F.col("_metadata.file_name")
    return rows.select(F.regexp_replace(name, r"\.md$", "").alias("doc_id"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("md"))


def read_pdfs(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, length, reason): PDF files, with why one is not usable."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", recursive).load(path)
    return rows.select("path", "length", pdf_reason("content", F.col("length")).alias("reason"))


def downloaded(spark: SparkSession, path: str) -> DataFrame:
    return read_pdfs(spark, path).where("reason IS NULL").select(F.regexp_extract("path", r"([^/]*)\.pdf$", 1).alias("pmid"), "path")


def processed(spark: SparkSession, path: str) -> DataFrame:
    """Documents whose Markdown begins with some text."""
    return read_markdown(spark, path).where(strip(F.left("md", F.lit(100))) != "").select("doc_id", "path")


def read_structured(spark: SparkSession, path: str) -> DataFrame:
    """(path, tables): tables listed in structured content, one JSON object a file."""
    schema = "Tables array<struct<id:string,content:string,line_start:int>>"
    return spark.read.schema(schema).json(path, multiLine=True).select(F.col("_metadata.file_path").alias("path"), F.coalesce("Tables", F.array().cast("array<struct<id:string,content:string,line_start:int>>")).alias("tables"))


def failed_pmids(spark: SparkSession, path: str) -> DataFrame:
    """Identifiers of a list of failed downloads: its first column."""
    rows = spark.read.csv(path, header=True, sep="\t", inferSchema=False)
    return rows.select(F.col(f"`{rows.columns[0]}`").alias("pmid")).where("pmid IS NOT NULL")


def write_csv(rows: DataFrame, path: str, sep: str = ",") -> None:
    """With a header; nothing is written for no rows."""
    if rows.limit(1).count():
        rows.write.mode("overwrite").csv(path, header=True, sep=sep, escape='"')


def write_json(rows: DataFrame, path: str, partition_by: str | None = None) -> None:
    """A JSON object a line, non-ASCII characters as they are."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).json(path)


def write_report(row: DataFrame, path: str) -> None:
    """A report of one row, as one JSON file."""
    row.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_table_files(cells: DataFrame, path: str, keys: tuple[str, str] = ("doc_id", "table_index")) -> None:
    """Cells of tables of any columns, in long form, a folder for each document and table."""
    cells.write.mode("overwrite").partitionBy(*keys).csv(path, header=True, escape='"')


def writable(spark: SparkSession, path: str) -> bool:
    """Whether a folder can be made and written to, on any file system that Spark knows."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path, "_litspark_probe")
    try:
        fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.create(fs_path, True).close()
        return bool(fs.delete(fs_path, False))
    except Exception:  # noqa: BLE001
        return False
