"""The library's end-to-end paths: screening, the document library, activation tables, a paper's stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..adapters import call
from ..operators import reports, screening, segment, tables
from ..operators.ingest import unique_records

Make = Callable[[], Callable[[dict], str | None]]


def screen(records: DataFrame, judge: Make, done: DataFrame | None = None, provided: DataFrame | None = None) -> DataFrame:
    """(pmid, title, abstract, include, confidence, reason, labels): a decision for each record without
    one. Without an abstract, and where the judge fails, it is no, with the reason."""
    rows = screening.unprocessed(records, done) if done is not None else records
    rows = screening.with_abstract(rows, provided).select("pmid", "title", "abstract")
    answers = call(rows.where("abstract IS NOT NULL"), judge, ["pmid", "abstract"])
    said = screening.decisions(answers.where("error IS NULL"))
    failed = answers.where("error IS NOT NULL").select("pmid", *screening.failed_decision(F.concat(F.lit("llm_error: "), "error")))
    none = rows.where("abstract IS NULL").select("pmid", *screening.failed_decision(F.lit("abstract_unavailable")))
    return rows.join(said.unionByName(failed).unionByName(none), "pmid")


def library(docs: DataFrame, key: str = "doc_id", text: str = "md") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Blocks with categories, an index row per document, and document frequencies of the parts."""
    kinds = segment.line_kinds(segment.lines(docs, key, text), key)
    found = segment.classify(segment.blocks(kinds, key), key)
    n = segment.tables(kinds, key).groupBy(key).agg(F.count("*").alias("table_count"))
    index = docs.select(key).join(segment.section_summary(found, key), key, "left").join(n, key, "left").join(segment.page_meta(kinds, key), key, "left")
    index = index.withColumn("table_count", F.coalesce("table_count", F.lit(0))).withColumn("block_count", F.coalesce("block_count", F.lit(0)))
    return found, index, segment.part_document_frequency(found, key)


def document_tables(docs: DataFrame, key: str = "doc_id", text: str = "md", context: int = 5) -> DataFrame:
    """Pipe tables of all documents with context and structure."""
    found = tables.table_runs(segment.lines(docs, key, text), key, context=context)
    return found.withColumn("structure", tables.structure(F.col("table_text")))


def papers(records: DataFrame, download: Make, ocr: Make, order: str = "row_no", pmid: str = "raw_pmid") -> tuple[DataFrame, DataFrame]:
    """Each paper's stage after download and OCR, and the totals. ``download`` answers with a path."""
    got = call(unique_records(records, order, pmid).select("pmid"), download, ["pmid"], output="pdf_path").withColumnRenamed("error", "download_error")
    read = call(got.where("pdf_path IS NOT NULL"), ocr, ["pdf_path"], output="markdown").withColumnRenamed("error", "ocr_error").select("pmid", "markdown", "ocr_error")
    out = got.join(read, "pmid", "left")
    out = out.withColumn("download_status", F.when(F.col("pdf_path").isNotNull(), "success").when(F.col("download_error").isNotNull(), "error").otherwise("failed"))
    out = out.withColumn("ocr_status", F.when(F.col("markdown").isNotNull(), "success").when(F.col("ocr_error").isNotNull(), "error"))
    staged = reports.paper_stage(out)
    return staged, reports.pipeline_totals(staged)
