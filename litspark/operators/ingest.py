"""Publication records: typed rows from CSV, validity, duplicates and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.validate import pmid_reason, valid_pmid
from ..shared import numbered

# A record's fields and the columns they may come in, in order.
FIELDS = {
    "title": ("Title", "Article Title", "title"),
    "authors": ("Authors", "Author List", "authors"),
    "citation": ("Citation", "citation"),
    "first_author": ("First Author", "first_author"),
    "journal": ("Journal/Book", "Journal", "journal"),
    "publication_year": ("Publication Year", "Year", "year"),
    "create_date": ("Create Date", "Date", "create_date"),
    "pmcid": ("PMCID", "pmcid"),
    "nihms_id": ("NIHMS ID", "nihms_id"),
    "abstract": ("Abstract", "abstract"),
    "keywords": ("Keywords", "keywords"),
    "doi": ("DOI", "doi"),
}


def first_column(columns: list[Column]) -> Column:
    """The first value that is not null, stripped; where that is blank, nothing, whatever follows."""
    return F.nullif(strip(F.coalesce(*columns)), F.lit(""))


def records(rows: DataFrame, pmid: str = "PMID") -> DataFrame:
    """Typed records of the rows with a valid identifier; duplicates stay."""
    rows = rows.toDF(*[c.strip() for c in rows.columns])
    fields = []
    for name, aliases in FIELDS.items():
        have = [F.col(f"`{c}`") for c in aliases if c in rows.columns]
        fields.append((first_column(have) if have else F.lit(None).cast("string")).alias(name))
    return rows.where(valid_pmid(F.col(f"`{pmid}`").cast("string"))).select(strip(F.col(f"`{pmid}`").cast("string")).alias("pmid"), *fields)


def export_rows(found: DataFrame) -> DataFrame:
    """Records under the first of their columns' names, nulls as empty."""
    return found.select(F.col("pmid").alias("PMID"), *[F.coalesce(F.col(n), F.lit("")).alias(a[0]) for n, a in FIELDS.items()])


def mark_duplicates(rows: DataFrame, order: str = "row_no", pmid: str = "raw_pmid") -> DataFrame:
    """Adds ``pmid`` (stripped), ``reason`` (null if valid) and ``occurrence`` among the valid."""
    out = rows.withColumn("pmid", strip(F.col(pmid))).withColumn("reason", pmid_reason(F.col(pmid)))
    out = out.withColumn("its_valid", F.when(F.col("reason").isNull(), F.col("pmid")))
    return numbered(out, "its_valid", order, "occurrence").drop("its_valid")


def unique_records(rows: DataFrame, order: str = "row_no", pmid: str = "raw_pmid") -> DataFrame:
    """Valid rows, of each identifier the first. An aggregation, so hot identifiers combine early."""
    valid = rows.where(valid_pmid(pmid)).withColumn("pmid", strip(F.col(pmid)))
    rest = [c for c in rows.columns if c != "pmid"]
    return valid.groupBy("pmid").agg(F.min_by(F.struct(*rest), order).alias("x")).select("pmid", "x.*")


def management_report(rows: DataFrame, order: str = "row_no", pmid: str = "raw_pmid") -> DataFrame:
    """One row: numbers of rows, valid, invalid and duplicate ones."""
    valid = pmid_reason(F.col(pmid)).isNull()
    per = rows.groupBy(F.when(valid, strip(F.col(pmid))).alias("p")).agg(F.count("*").alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("p").alias("valid_records"), F.coalesce(F.sum(F.when(F.col("p").isNull(), F.col("n"))), F.lit(0)).alias("invalid_count"),
        F.coalesce(F.sum(F.when(F.col("p").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("duplicate_count"),
    )


def report_lists(rows: DataFrame, order: str = "row_no", pmid: str = "raw_pmid") -> DataFrame:
    """The report's lists as rows (kind, row, pmid, reason); ``row`` counts the header line too."""
    marked = mark_duplicates(rows, order, pmid)
    kind = F.when(F.col("reason").isNotNull(), "invalid").when(F.col("occurrence") > 1, "duplicate").otherwise("valid")
    return marked.select(kind.alias("kind"), (F.col(order) + 2).alias("row"), "pmid", "reason")


def coverage(found: DataFrame, fields: tuple[str, ...] = ("abstract", "title", "journal")) -> DataFrame:
    """Numbers of records, valid ones, and those with text in each field; percentages, if any rows."""
    has = {f: F.count_if(F.coalesce(strip(F.col(f)), F.lit("")) != "") for f in fields}
    out = found.agg(F.count("*").alias("total"), F.count_if(valid_pmid("pmid")).alias("valid"), *[n.alias(f"with_{f}") for f, n in has.items()])
    out = out.withColumn("invalid", F.col("total") - F.col("valid"))
    return out.select("*", *[(F.col(f"with_{f}") * 100.0 / F.nullif("total", F.lit(0))).alias(f"{f}_coverage") for f in fields])


def sample_records(spark: SparkSession, n: int = 10) -> DataFrame:
    """Example rows of a record file."""
    i = F.col("id").cast("string")
    t = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return spark.range(1, n + 1).select(
        t("3000000", i).alias("PMID"), t("Sample Article Title ", i).alias("Title"), t("Author A", i, ", Author B", i, ", Author C", i).alias("Authors"),
        t("J Sample Res. ", (F.col("id") + 2020).cast("string"), ";", i, "(", i, "):", (F.col("id") * 100).cast("string"), "-", (F.col("id") * 100 + 50).cast("string")).alias("Citation"),
        t("Author A", i).alias("First Author"), F.lit("Journal of Sample Research").alias("Journal/Book"), (F.col("id") + 2020).cast("string").alias("Publication Year"),
        t("2020-0", i, "-0", i).alias("Create Date"), t("PMC", i, "00000", i).alias("PMCID"), t("NIHMS", i, "00000", i).alias("NIHMS ID"),
        t("This is a sample abstract for article ", i, ". It demonstrates the structure of a typical abstract.").alias("Abstract"),
        t("sample", i, ", test", i, ", example", i).alias("Keywords"), t("10.1000/sample.", i).alias("DOI"),
    )


def check_columns(rows: DataFrame, required: tuple[str, ...], pmid: str = "PMID", order: str = "row_no") -> DataFrame:
    """One row: required columns that are missing, number of rows, and the first five bad identifiers, in
    the order of ``order`` (that of the rows as they are read, without such a column)."""
    missing = F.array(*[F.lit(c) for c in required if c not in rows.columns]).cast("array<string>")
    if pmid not in rows.columns:
        return rows.agg(F.count("*").alias("total_rows")).select("total_rows", missing.alias("missing_columns"), F.array().cast("array<string>").alias("bad_pmids"))
    place = F.col(order) if order in rows.columns else F.monotonically_increasing_id()
    bad = rows.where(F.col(pmid).isNotNull() & ~valid_pmid(F.col(pmid))).select(place.alias("place"), F.col(pmid).alias("bad")).orderBy("place").limit(5)
    bad = bad.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "bad"))), lambda x: x["bad"])).scalar()
    return rows.agg(F.count("*").alias("total_rows")).select("total_rows", missing.alias("missing_columns"), bad.alias("bad_pmids"))


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows by md5 of seed and key: the same ones on any cluster."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), key).limit(n)


def valid_pmids(rows: DataFrame, pmid: str = "PMID") -> DataFrame:
    """Valid identifiers, stripped; duplicates stay."""
    return rows.where(valid_pmid(F.col(pmid))).select(strip(F.col(pmid)).alias("pmid"))


def existing_paths(listing: DataFrame, decisions: DataFrame | None = None, path: str = "PDFPath") -> DataFrame:
    """(path) of the files to read: all that are listed or, with ``decisions``, those named there."""
    if decisions is None:
        return listing.select("path").orderBy("path")
    named = decisions.select(strip(F.col(path)).alias("path")).where("path <> ''")
    return named.join(listing.select("path").distinct(), "path", "left_semi")


def europe_pmc_pdf(answer: Column) -> Column:
    """The first PDF address in an answer of the full-text service."""
    schema = "struct<resultList:struct<result:array<struct<fullTextUrlList:struct<fullTextUrl:array<struct<documentStyle:string,url:string>>>>>>>"
    lists = F.transform(F.from_json(answer, schema)["resultList"]["result"], lambda r: F.coalesce(r["fullTextUrlList"]["fullTextUrl"], F.array().cast("array<struct<documentStyle:string,url:string>>")))
    hits = F.filter(F.flatten(lists), lambda u: (F.lower(u["documentStyle"]) == "pdf") & (F.coalesce(u["url"], F.lit("")) != ""))
    return F.get(hits, F.lit(0))["url"]


def idconv_pmcid(answer: Column) -> Column:
    """The first record's archive identifier in an answer of the converter."""
    return F.nullif(F.get(F.from_json(answer, "struct<records:array<struct<pmcid:string>>>")["records"], F.lit(0))["pmcid"], F.lit(""))
