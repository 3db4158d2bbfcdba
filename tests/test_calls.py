"""Model calls are made once for each row, however often a result is read; numbering without one task."""

import json

from pyspark.sql import functions as F

from litspark import adapters
from litspark.operators import ingest, model_tables
from litspark.operators import reports as R
from litspark.plans import pipelines
from litspark.shared import running


def counting(spark, ask):
    """An adapter that counts its calls, and its counter."""
    n = spark.sparkContext.accumulator(0)

    def make():
        def one(record):
            n.add(1)
            return ask(record)

        return one

    return make, n


def test_screening_calls_once(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("pmid"), F.lit("t").alias("title"), F.lit("fMRI of language").alias("abstract"))
    judge, n = counting(spark, lambda r: adapters.keyword_judge()(r) if int(r["pmid"]) % 4 else 1 / 0)
    out = pipelines.screen(rows, judge)
    got = [out.collect() for _ in range(2)][0]
    assert n.value == 100
    assert len(got) == 100 and sum(r.include for r in got) == 75 and sum(r.reason.startswith("llm_error") for r in got) == 25


def test_papers_call_once(spark):
    rows = spark.range(60).select(F.col("id").alias("row_no"), (F.col("id") + 30000000).cast("string").alias("raw_pmid"))
    load, loads = counting(spark, lambda r: f"/{r['pmid']}.pdf" if int(r["pmid"]) % 3 else None)
    ocr, reads = counting(spark, adapters.echo_ocr())
    staged, totals = pipelines.papers(rows, load, ocr)
    assert staged.count() == 60 and totals.first().total == 60
    assert loads.value == 60 and reads.value == 40


def test_categorize_calls_once(spark):
    tables = [(i, "| a |\n|---|\n" + "\n".join(f"| {j} |" for j in range(40 if i % 2 else 3)), "c") for i in range(50)]
    rows = spark.createDataFrame(tables, "doc_id long, table_text string, full_context string")
    judge, n = counting(spark, lambda r: json.dumps({"category": "statistical", "need_full_scan": True}))
    out = model_tables.categorize(rows, judge, ("doc_id",))
    parts = rows.select(F.size(model_tables.chunks(F.col("table_text"))).alias("n"), "doc_id").where("doc_id % 2 = 1").agg(F.sum("n")).first()[0]
    for _ in range(2):
        assert {r.category for r in out.collect()} == {"statistical"}
    assert n.value == 50 + parts


def test_running_sums_are_those_of_the_whole_table(spark):
    rows = spark.createDataFrame([(i * 7 % 101, i % 3) for i in range(101)], "k int, part int").repartition(5)
    got = running(rows, "k", place=F.lit(1), total=F.col("part")).orderBy("k").collect()
    want, total = sorted((i * 7 % 101, i % 3) for i in range(101)), 0
    for i, (k, part) in enumerate(want):
        total += part
        assert (got[i].k, got[i].place, got[i].total, got[i].part) == (k, i + 1, total, part)
    assert running(rows.where("false"), "k", place=F.lit(1)).count() == 0
    assert R.progress(rows.where("false").withColumn("stage", F.lit("x")), "k").count() == 0


def test_first_bad_identifiers_in_the_order_of_the_file(spark):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(["z", "30000000", "y", None, "y", "b", "a", "c"])], "row_no long, PMID string").repartition(4)
    assert ingest.check_columns(rows, ("PMID", "DOI")).first().bad_pmids == ["z", "y", "y", "b", "a"]


def test_downloads_of_bytes(spark):
    rows = spark.createDataFrame([("1",), ("2",)], "pmid string")
    got = {r.pmid: (r.content, r.error) for r in adapters.download(rows, lambda: lambda r: iter([b"%PDF-", b"x" * 200]), ["pmid"]).collect()}
    assert got["1"] == (b"%PDF-" + b"x" * 200, None)
    assert {r.error for r in adapters.download(rows, lambda: lambda r: iter([b"%PDF-", b"x" * 200]), ["pmid"], most=100).collect()} == {"ValueError: too large"}
