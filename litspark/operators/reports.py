"""Counts and rates over downloads, OCR runs and whole pipelines; numbers, not formatted texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import detect_language, ocr_quality, strip
from ..shared import running

STATUSES = ("success", "failed", "skipped", "error")


def status_counts(status: str = "status") -> list[Column]:
    names = {"success": "succeeded"}
    return [F.count_if(F.col(status) == s).alias(names.get(s, s)) for s in STATUSES]


def rate(part: str, whole: str = "total") -> Column:
    return F.coalesce(F.col(part) * 100.0 / F.nullif(whole, F.lit(0)), F.lit(0.0))


def positive_mean(c: str) -> Column:
    return F.coalesce(F.avg(F.when(F.col(c) > 0, F.col(c))), F.lit(0.0))


def source_name(used: str = "downloader_used", source: str = "source") -> Column:
    """What served a download; empty names do not count."""
    return F.coalesce(F.nullif(used, F.lit("")), F.nullif(source, F.lit("")), F.lit("unknown"))


def download_stats(results: DataFrame) -> DataFrame:
    """Means of size and time are over positive ones, that of retries over all."""
    out = results.agg(
        F.count("*").alias("total"), *status_counts(), positive_mean("file_size").alias("avg_file_size"), positive_mean("download_time").alias("avg_download_time"),
        F.coalesce(F.avg("retry_count"), F.lit(0.0)).alias("avg_retries"), F.coalesce(F.sum(F.when(F.col("file_size") > 0, F.col("file_size"))), F.lit(0)).alias("total_file_size"),
    )
    return out.withColumn("success_rate", rate("succeeded"))


def source_distribution(results: DataFrame) -> DataFrame:
    return results.groupBy(source_name().alias("source_used")).agg(F.count("*").alias("n"))


def ocr_stats(results: DataFrame) -> DataFrame:
    out = results.agg(
        F.count("*").alias("total"), *status_counts(), F.coalesce(F.sum("pages_processed"), F.lit(0)).cast("bigint").alias("total_pages"),
        F.coalesce(F.sum("text_length"), F.lit(0)).cast("bigint").alias("total_text_length"), positive_mean("processing_time").alias("avg_processing_time"),
    )
    whole = F.nullif("total", F.lit(0))
    return out.select("*", rate("succeeded").alias("success_rate"), F.coalesce(F.col("total_pages") / whole, F.lit(0.0)).alias("avg_pages_per_doc"), F.coalesce(F.col("total_text_length") / whole, F.lit(0.0)).alias("avg_text_per_doc"))


def distribution(results: DataFrame, column: str) -> DataFrame:
    """(value, n) of the values that are there."""
    return results.where(F.coalesce(F.col(column), F.lit("")) != "").groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def batch_totals(results: DataFrame) -> DataFrame:
    """Errors count as failed."""
    return results.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "success").alias("succeeded"), F.count_if(F.col("status").isin("failed", "error")).alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
    )


def pipeline_totals(papers: DataFrame, stage: str = "stage") -> DataFrame:
    out = papers.agg(F.count("*").alias("total"), F.count_if(F.col(stage) == "completed").alias("completed"), F.count_if(F.col(stage) == "failed").alias("failed"))
    return out.withColumn("skipped", F.col("total") - F.col("completed") - F.col("failed")).withColumn("success_rate", rate("completed"))


def paper_status(papers: DataFrame) -> DataFrame:
    """Derived columns of (stage, pdf_path, markdown_path, start_time, end_time)."""
    return papers.select(
        "*", (F.col("stage") == "completed").alias("success"), (F.coalesce("pdf_path", F.lit("")) != "").alias("has_pdf"), (F.coalesce("markdown_path", F.lit("")) != "").alias("has_markdown"),
        (F.col("end_time") - F.col("start_time")).alias("processing_time"),
    )


def paper_stage(results: DataFrame, legacy: bool = False) -> DataFrame:
    """Stage of papers from the status of download and OCR. A paper whose Markdown was there already
    is complete; with ``legacy`` it counts as failed, as it once did."""
    done = ("success",) if legacy else ("success", "skipped")
    got = F.col("download_status").isin("success", "skipped")
    return results.withColumn("stage", F.when(~got, "failed").when(F.col("ocr_status").isin(*done), "completed").otherwise("failed"))


def manual_checklist(results: DataFrame) -> DataFrame:
    """Downloads to do by hand: three addresses each, padded, commas in messages made full-width."""
    urls = F.slice(F.concat(F.coalesce("suggestions", F.array().cast("array<string>")), F.array_repeat(F.lit(""), 3)), 1, 3)
    return results.where(~F.col("status").isin("success", "skipped")).select(
        "pmid", "status", *[F.get(urls, F.lit(i)).alias(f"url_{i + 1}") for i in range(3)], F.replace(F.coalesce("error_message", F.lit("")), F.lit(","), F.lit("，")).alias("error")
    )


def failed_downloads(results: DataFrame) -> DataFrame:
    """(PMID, Error) of failures that have a message; of an identifier's the first."""
    rows = results.where(F.col("status").isin("failed", "error") & (F.coalesce("error_message", F.lit("")) != ""))
    return rows.groupBy(F.col("pmid").alias("PMID")).agg(F.min_by("error_message", "event_id").alias("Error"))


def export_results(papers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the success and the failure file."""
    good = papers.where("stage = 'completed'").select("pmid", "pdf_path", "markdown_path", "quality_score", "quality_level", "processing_time")
    bad = papers.where("stage <> 'completed'").select("pmid", "stage", F.array_join("errors", "; ").alias("errors"), F.array_join("suggestions", " | ").alias("suggestions"), F.to_json("attempts").alias("attempts"))
    return good, bad


def assemble_pages(pages: DataFrame, key: str = "pdf") -> DataFrame:
    """(key, markdown, failed_pages): pages (page_num, success, markdown, error) in order, under
    markers; failed ones say so."""
    number = F.col("page_num").cast("string")
    # The texts around pages.
    good = F.concat(F.lit("\n## Page "), number, F.lit("\n\n"), F.regexp_replace("markdown", r"(?U)^\s+|\s+$", ""))
    bad = F.concat(
        F.lit("\n## ⚠️ Page "), number, F.lit(" - OCR FAILED\n\n```\nERROR: "), F.coalesce(F.nullif("error", F.lit("")), F.lit("Unknown error")),
        F.lit("\nThis page could not be converted to markdown.\nPlease check the original PDF for page "), number, F.lit(".\n```"),
    )
    part = F.concat(F.lit("\n\n"), F.when(F.col("success"), good).otherwise(bad), F.lit("\n\n" + "-" * 80 + "\n"))
    out = pages.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("page_num", part.alias("x")))).alias("parts"), F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("page_num")))).alias("failed_pages")
    )
    failed = F.array_join(F.transform("failed_pages", lambda p: p.cast("string")), ", ")
    status = F.when(F.size("failed_pages") == 0, "**Status:** All pages converted successfully").otherwise(F.concat(F.lit("**Failed Pages:** "), failed))
    head = F.concat(F.lit("# "), F.col(key), F.lit("\n\n**Total Pages:** "), F.size("parts").cast("string"), F.lit("\n"), status, F.lit("\n\n" + "=" * 80 + "\n\n"))
    return out.select(key, F.concat(head, F.array_join(F.transform("parts", lambda p: p["x"]), "\n")).alias("markdown"), "failed_pages")


def ocr_report(results: DataFrame) -> DataFrame:
    """Rows of an OCR report; times to two places, half to even."""
    return results.select(
        "pdf", "status", F.coalesce("markdown", F.lit("")).alias("markdown"), "pages_processed", F.bround("processing_time", 2).alias("processing_time"), F.coalesce("error", F.lit("")).alias("error")
    )


def run_summary(results: DataFrame, status: str = "status") -> DataFrame:
    """Total, and how many succeeded and did not."""
    good = F.coalesce(F.lower(status) == "success", F.lit(False))
    return results.agg(F.count("*").alias("total"), F.count_if(good).alias("success"), F.count_if(~good).alias("failed"))


def success_means(results: DataFrame) -> DataFrame:
    """Counts, and means of quality and length over successful runs; 0 without any."""
    good = F.col("status") == "success"
    mean = lambda c: F.coalesce(F.bround(F.avg(F.when(good, F.col(c))), 2), F.lit(0.0))
    return results.agg(
        F.count("*").alias("sample_size"), F.count_if(good).alias("success_count"), F.count_if(~good).alias("failed_count"), mean("quality_score").alias("avg_quality_score_success"),
        mean("text_length").alias("avg_text_length_success"),
    )


def table_summary(tables: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Tables by document, and over all."""
    per = tables.groupBy(key).agg(F.count("*").alias("tables"))
    return per, per.agg(F.count("*").alias("documents"), F.coalesce(F.sum("tables"), F.lit(0)).alias("total_tables"))


def progress(papers: DataFrame, order: str, every: int = 10, stage: str = "stage") -> DataFrame:
    """Running numbers of completed and failed papers at every ``every``-th one."""
    is_ = lambda s: (F.col("its_stage") == s).cast("int")
    rows = papers.select(F.col(order).alias("its_place"), F.col(stage).alias("its_stage"))
    rows = running(rows, "its_place", done=F.lit(1), completed=is_("completed"), failed=is_("failed"))
    return rows.where(F.col("done") % every == 0).select("done", "completed", "failed").orderBy("done")


def markdown_stats(docs: DataFrame, key: str = "doc_id", text: str = "md") -> DataFrame:
    """Sizes, lines, language, marks and quality of Markdown texts that are not blank."""
    x = F.col(text)
    lines = F.split(x, "\n", -1)
    score, level = ocr_quality(x)
    return docs.where(F.coalesce(strip(x), F.lit("")) != "").select(
        key, F.octet_length(x).alias("file_size"), F.length(x).alias("text_length"), F.size(lines).alias("line_count"), F.size(F.filter(lines, lambda s: strip(s) != "")).alias("non_empty_lines"),
        detect_language(x).alias("language"), (x.contains("|") & x.contains("---")).alias("has_tables"), x.contains("#").alias("has_headings"), score.alias("quality_score"), level.alias("quality_level"),
    )
