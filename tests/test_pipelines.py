import json

import pytest
from pyspark.sql import functions as F

from litspark import adapters as A
from litspark.config import Config
from litspark.operators import features, model_tables
from litspark.plans import pipelines


def test_screening_leaves_a_decision_for_each_record(spark):
    rows = spark.createDataFrame([("1", "a", "fMRI of language"), ("2", "b", ""), ("3", "c", "boom"), ("4", "d", "x")], "pmid string, title string, abstract string")

    def make():
        judge = A.keyword_judge()

        def ask(record):
            if record["abstract"] == "boom":
                raise RuntimeError("down")
            return judge(record)

        return ask

    got = {r.pmid: (r.include, r.reason) for r in pipelines.screen(rows, make, done=rows.where("pmid = '4'")).collect()}
    assert got == {"1": (True, "method+topic fit"), "2": (False, "abstract_unavailable"), "3": (False, "llm_error: RuntimeError: down")}


def test_library(spark):
    docs = spark.createDataFrame([(0, "# T\n**Total Pages:** 2\n## Page 1\n## Methods\n| a |\n|---|\n| 1 |\n## Results\nx"), (1, "")], "doc_id long, md string")
    found, index, parts = pipelines.library(docs)
    rows = {r.doc_id: r for r in index.collect()}
    assert (rows[0].block_count, rows[0].table_count, rows[0].declared_total_pages, rows[0].parsed_page_markers) == (3, 1, 2, 1)
    assert (rows[1].block_count, rows[1].table_count) == (0, 0)
    assert {r.part: r.n_docs for r in parts.collect()}["Methods"] == 1
    assert pipelines.document_tables(docs).first().structure.data_rows == [["1"]]
    assert found.count() == 3


def test_activation_tables(spark):
    long = "| h | x |\n|---|---|\n" + "\n".join(f"| r{i} | {i} |" for i in range(20)) + "\n| peak | 9 |\n" + "\n".join(f"| s{i} | {i} |" for i in range(8))
    rows = spark.createDataFrame([(0, 0, "| a |\n|---|\n| 1 |", "ctx"), (0, 1, long, "ctx"), (1, 0, "| b |", "c")], "doc_id long, table_index int, table_text string, full_context string")

    def judge():
        return lambda r: json.dumps({"category": "Brain_Activation" if "peak" in r["snippet"] else "statistical", "need_full_scan": True})

    got = {(r.doc_id, r.table_index): r.category for r in model_tables.categorize(rows, judge).collect()}
    assert got == {(0, 0): "statistical", (0, 1): "brain_activation", (1, 0): "statistical"}
    assessor = lambda: lambda r: json.dumps({"contains_coordinates": "Yes", "Task_name": ""})
    parser = lambda: lambda r: '```csv\nRegion,X,X\n"a, b",1,2\nc,3\n```'
    out = {(r.doc_id, r.table_index): r for r in model_tables.activation_tables(rows, judge, assessor, parser).collect()}
    assert set(out) == {(0, 1), (1, 0)}  # labelled ones; of a document without any, all
    one = out[(0, 1)]
    assert (one.task, one.parsed.columns, one.parsed.rows, one.parsed.ragged, one.error) == ("Unknown", ["Region", "X", "X.2"], [{"Region": "a, b", "X": "1", "X.2": "2"}], 1, None)
    strict = model_tables.parse(rows.withColumn("task", F.lit("t")), parser, all_or_nothing=True).first()
    assert strict.parsed.rows == [] and strict.error == "no rows"


def test_features_close_upwards_and_fail_absent(spark):
    papers = spark.createDataFrame([("p", "naming", "We name."), ("q", "", "x"), ("r", "bad", "y")], "task_id string, task_name string, methods string")

    def make():
        def ask(r):
            if r["task_name"] == "bad":
                raise ValueError("no")
            return json.dumps({"prosody_perception": 0, "syntactic_parsing": "yes", "comprehension": True, "speech_rate_normalization": "present" if r["kind"] == "processing" else 1})

        return ask

    got = {(r.task_id, r.feature): r.value for r in features.extract_features(papers, make).collect()}
    assert {f for (t, f), v in got.items() if t == "p" and v == 0} >= {"prosody_perception", "syntactic_parsing", "syntax", "language", "task_structure", "speech_rate_normalization", "rhythm/metrical_structure", "processing"}
    assert got[("p", "comprehension")] == 1  # true reads as 1
    assert all(v == 1 for (t, _), v in got.items() if t in "qr") and len(got) == 3 * 83
    ids = features.paper_ids(spark.createDataFrame([(None, 1), ("x", 2)], "task_id string, n int"), "n")
    assert [r.task_id for r in ids.orderBy("n").collect()] == ["paper_1", "x"]


def test_papers(spark):
    rows = spark.createDataFrame([(0, "11111"), (1, "11111"), (2, "22222"), (3, "bad")], "row_no long, raw_pmid string")
    download = lambda: lambda r: f"/{r['pmid']}.pdf" if r["pmid"] == "11111" else None
    stages, totals = pipelines.papers(rows, download, A.echo_ocr)
    assert {r.pmid: r.stage for r in stages.collect()} == {"11111": "completed", "22222": "failed"}
    assert totals.first().asDict() == {"total": 2, "completed": 1, "failed": 1, "skipped": 0, "success_rate": 50.0}


def test_settings(tmp_path):
    (tmp_path / "c.json").write_text('{"ocr": {"dpi": 300}, "new": {"a": 1}}')
    c = Config(str(tmp_path / "c.json"), environment={"LITSPARK_MODEL__NAME": "m", "OTHER": "x"})
    assert (c.get("ocr.dpi"), c.get("ocr.max_retries"), c.get("new.a"), c.get("model.name"), c.get("no.such", 5)) == (300, 1, 1, "m", 5)
    c.save(str(tmp_path / "out.json"))
    assert Config(str(tmp_path / "out.json"), environment={}).get("ocr.dpi") == 300
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(ValueError):
        Config(str(tmp_path / "bad.json"))
