import json

import pytest
from pyspark.sql import functions as F

from litspark import adapters as A
from litspark.operators import html as H
from litspark.operators import ingest as I
from litspark.operators import ontology as O
from litspark.operators import reports as R
from litspark.operators import screening as C
from litspark.operators import segment as S
from litspark.operators import tables as T

PAPER = """# A Great Study
## Authors
A. B.
## Keywords
k
## Abstract
abs
## Introduction
intro
## Methods
how
### Subjects
20
### Statistical Analysis
t test
## Results
res
## Discussion
dis
## References
[1]
"""
VAGUE = "# Weird Title\n## Section A\nour methods\n## Section B\nour results\n## Section C\nthe discussion and introduction\n## Section D\nreferences"


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, md string")


def test_full_paper(spark):
    found = S.segment(docs(spark, PAPER))
    top = S.section_summary(found).first()
    assert top.strategy == "rule_based" and top.required_sections_complete
    parents = {r.heading: r.parent_line for r in S.methods_parents(found).collect()}
    assert parents == {"Methods": None, "Subjects": 10, "Statistical Analysis": 10}
    texts = {r.category: r.content for r in S.section_text(found).collect()}
    assert texts["Methods"].startswith("### Methods\nhow\n\n### Subjects")


def test_vague_headings_fall_back_on_content(spark):
    found = S.segment(docs(spark, VAGUE))
    assert {r.strategy for r in found.collect()} == {"keyword_fallback"}
    assert S.tables(S.line_kinds(S.lines(docs(spark, VAGUE)))).count() == 0


def test_mapping_is_laid_over_incomplete_papers(spark):
    text = "# T\n## Section A\nx"
    mapping = spark.createDataFrame([(0, "Section A", "Results")], "doc_id long, heading string, category string")
    got = {r.heading: (r.category, r.strategy) for r in S.segment(docs(spark, text), mapping=mapping).collect()}
    assert got["Section A"] == ("Results", "keyword_fallback")


def test_lines(spark):
    text = "before\n| a |\n| b |\n\n| c |\n<table>\n# no heading\n</table>\n## Page 1\n## Head\n<table>open\n## lost"
    kinds = S.line_kinds(S.lines(docs(spark, text)))
    assert [r.kind for r in kinds.orderBy("i").collect()] == ["text", "pipe", "pipe", "skip", "pipe", "html_start", "html_body", "html_body", "page_marker", "heading", "html_start", "html_body"]
    assert [(r.table_no, r.line_start) for r in S.tables(kinds).orderBy("table_no").collect()] == [(1, 2), (2, 5), (3, 6), (4, 11)]
    blocks = {r.heading: (r.line_start, r.heading_level, r.content) for r in S.blocks(kinds).collect()}
    assert blocks == {"Document_Root": (1, 0, "before\n[TABLE: table_1]\n[TABLE: table_2]\n[TABLE: table_3]"), "Head": (10, 2, "[TABLE: table_4]")}


def test_segmentation_ignores_partitioning(spark):
    many = docs(spark, *[PAPER, VAGUE] * 5)
    one, two = (sorted(map(tuple, S.segment(d).collect())) for d in (many.coalesce(1), many.repartition(7)))
    assert one == two


def test_blank_separated_tables_merge(spark):
    text = "x\n| a |\n\n| b |\n\ny\n| half"
    found = T.table_runs(S.lines(docs(spark, text))).collect()
    assert [(r.table_text, r.before_context, r.after_context) for r in found] == [("| a |\n\n| b |\n", "x", "y\n| half")]


def test_many_tables_of_one_document(spark):
    text = "\n".join(x for i in range(3000) for x in (f"| {i} |", f"t{i}"))
    found = T.table_runs(S.lines(docs(spark, text)), context=3).orderBy("table_index").collect()
    assert [r.table_text for r in found] == [f"| {i} |" for i in range(3000)]
    assert (found[0].before_context, found[9].line_start) == ("", 19)
    assert (found[9].before_context, found[9].after_context) == ("t7\n| 8 |\nt8", "t9\n| 10 |\nt10")


def test_duplicates_of_a_frequent_identifier(spark):
    hot = spark.range(5000).select(F.col("id").alias("row_no"), F.expr("if(id % 3 = 0, ' 12345678 ', if(id % 3 = 1, '', cast(20000000 + id as string)))").alias("raw_pmid"))
    got = I.mark_duplicates(hot.repartition(7)).orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(5000))
    assert [r.occurrence for r in got[::3]] == list(range(1, len(got[::3]) + 1))
    assert all(r.occurrence is None and r.reason for r in got[1::3]) and all(r.occurrence == 1 for r in got[2::3])
    assert I.mark_duplicates(hot.where("row_no < 0")).count() == 0


def test_blank_cells_delete_rows(spark):
    got = docs(spark, "| h | i |\n|---|---|\n| 1 | 2 |\n| 3 |  |", "<table></table>", "").select(T.structure(F.col("md")).alias("t")).collect()
    assert [(r.t.num_rows, r.t.num_columns, r.t.has_header) for r in got] == [(1, 2, True), (0, 1, False), (0, 0, False)]


def test_structured_tables_have_context(spark):
    rows = docs(spark, "a\nb\n| x |\n\nc").withColumn("tables", F.expr("array(named_struct('id', 't', 'content', '| x |', 'line_start', 3), named_struct('id', cast(null as string), 'content', '', 'line_start', 0))"))
    got = T.structured_tables(rows).orderBy("table_index").collect()
    assert [(r.table_id, r.line_start, r.before_context, r.after_context) for r in got] == [("t", 3, "a\nb", "\nc"), ("table_2", None, "", "")]


def test_canonical_coordinates(spark):
    rows = spark.createDataFrame([([{"Brain_Region": "IFG", "H": "L", "x": "-42", "T_Score": "3.1", "p": "<0.001", "Voxels": "9"}],)], "rows array<map<string,string>>")
    got = rows.select(T.canonical_rows(F.col("rows")).alias("r")).first().r[0]
    assert (got.region, got.hemisphere, got.x, got.statistic, got.p, got.p_number, got.cluster_size) == ("IFG", "L", -42.0, 3.1, "<0.001", None, 9.0)


def test_ontology_facts():
    assert (len(O.NODES), len(O.EDGES), len(O.LEAVES), len(O.ancestors())) == (83, 83, 73, 138)
    assert [len(O.schema_leaves(k)) for k in ("representational", "processing", "design")] == [41, 16, 18]


def test_closure_is_idempotent_and_monotone(spark):
    rows = spark.createDataFrame([(1, "rhythm_class_judgement", 0), (1, "syntactic_parsing", 1), (2, "unknown", 0)], "task_id long, feature string, value int")
    closed = O.closure(rows)
    got = {(r.task_id, r.feature): r.value for r in closed.collect()}
    assert {f for (t, f), v in got.items() if t == 1 and v == 0} == {"rhythm_class_judgement", "rhythm/metrical_structure", "prosody", "phonetics/phonology", "language"}
    assert got == {(r.task_id, r.feature): r.value for r in O.closure(closed).collect()}
    assert got[(2, "unknown")] == 0


def criteria():
    return {k: [] for k in C.REQUIRED_KEYS} | {"methodology": {"include": ["fMRI"], "exclude": []}}


def test_criteria_name_what_is_missing():
    with pytest.raises(ValueError, match="decision_policy"):
        C.flatten_criteria({k: v for k, v in criteria().items() if k != "decision_policy"})


def test_screening_with_doubles(spark):
    rows = spark.createDataFrame([("1001", "An unrelated plant study."), ("1002", "")], "pmid string, abstract string")
    provided = spark.createDataFrame([("1002", "This fMRI study tests language networks in healthy adults.")], "pmid string, abstract string")
    have = C.with_abstract(rows, provided)
    judged = C.decisions(A.call(have.where("abstract IS NOT NULL"), A.keyword_judge, ["pmid", "abstract"]))
    out = have.join(judged, "pmid", "left").withColumn("download_status", F.when(F.col("include"), "success")).withColumn("ocr_status", F.when(F.col("include"), "SUCCESS"))
    assert C.funnel(out).first().asDict() == {"total": 2, "abstract_available": 2, "included": 1, "excluded": 1, "downloaded": 1, "ocr_success": 1}
    payload = C.criteria_frame(spark, criteria()).first().criteria
    records = [json.loads(r) for r in C.training_records(out, F.lit(payload)).toJSON().collect()]
    assert len(records) == 2 and all(r["metadata"]["target_model"] == "Qwen3-3B" for r in records)
    assert C.unprocessed(rows, rows).count() == 0
    assert C.confident(judged, 0.95).where("include").count() == 0


def test_answers_are_coerced(spark):
    answers = ['{"include": "false"}', '{"include": false, "confidence": 0.5}', '{"include": 0}', '{"include": 2}', "not json", None, '{"include": ""}', '{"include": true, "labels": {"a": "b"}}']
    rows = spark.createDataFrame(list(enumerate(answers)), "pmid long, answer string")
    got = C.decisions(rows).orderBy("pmid").collect()
    assert [r.include for r in got] == [True, False, False, True, False, False, False, True]
    assert got[1].confidence == 0.5 and got[7].labels == {"a": "b"} and got[4].reason == ""


def test_failed_calls_are_rows(spark):
    rows = spark.createDataFrame([("a.pdf",), ("",)], "pdf_path string")
    got = {r.pdf_path: (r.answer, r.error) for r in A.call(rows, A.echo_ocr, ["pdf_path"], retries=1).collect()}
    assert got["a.pdf"][0].startswith("# a.pdf") and got[""] == (None, "ValueError: no file")


def test_fallback_logs_attempts(spark):
    def miss(record):
        return None

    def hit(record):
        return "https://x/" + record["pmid"]

    rows = spark.createDataFrame([("7",)], "pmid string")
    got = json.loads(A.call(rows, A.first_source([miss, hit]), ["pmid"]).first().answer)
    assert got["pdf_url"] == "https://x/7" and [a["status"] for a in got["attempts"]] == ["miss", "hit"]


def test_blank_alias_wins_and_goes(spark):
    rows = spark.createDataFrame([("12345", "  ", "t"), ("12346", None, "u"), ("x", "v", "w")], "PMID string, Title string, `Article Title` string")
    assert [tuple(r) for r in I.records(rows).select("pmid", "title").orderBy("pmid").collect()] == [("12345", None), ("12346", "u")]
    checked = I.check_columns(rows, ("PMID", "DOI")).first()
    assert checked.missing_columns == ["DOI"] and checked.bad_pmids == ["x"]
    assert set(I.export_rows(I.records(rows)).columns) >= {"PMID", "Journal/Book"}


def test_coverage_of_nothing(spark):
    got = I.coverage(spark.createDataFrame([], "pmid string, abstract string, title string, journal string")).first()
    assert got.total == 0 and got.abstract_coverage is None


def test_skipped_ocr_is_complete_but_once_was_not(spark):
    rows = spark.createDataFrame([("skipped", "skipped")], "download_status string, ocr_status string")
    assert R.paper_stage(rows).first().stage == "completed" and R.paper_stage(rows, legacy=True).first().stage == "failed"


def test_quotes_in_tags(spark):
    page = "<META content='https://p/1.pdf' name=citation_pdf_url><a HREF='/doi/pdf/2'>x</a>"
    got = spark.createDataFrame([(page,)], "h string").select(H.find_pdf(F.lit("https://h.org/x/y"), F.col("h"), ("nope", "future_medicine", "generic_citation")).alias("f")).first().f
    assert (got.finder, got.pdf_url) == ("future_medicine", "https://h.org/doi/pdf/2")


def test_summaries(spark):
    rows = spark.createDataFrame([("a", "success", None, 2, 1.005, None), ("b", "ERROR", "m", 0, 2.675, "e")], "pdf string, status string, markdown string, pages_processed int, processing_time double, error string")
    assert [tuple(r) for r in R.ocr_report(rows).collect()] == [("a", "success", "", 2, 1.0, ""), ("b", "ERROR", "m", 0, 2.68, "e")]
    assert tuple(R.run_summary(rows).first()) == (2, 1, 1)
    none = spark.createDataFrame([], "status string, quality_score double, text_length long")
    assert R.success_means(none).first().avg_quality_score_success == 0.0
    papers = spark.range(25).select("id", F.when(F.col("id") % 5 == 0, "failed").otherwise("completed").alias("stage"))
    assert [tuple(r) for r in R.progress(papers, "id").collect()] == [(10, 8, 2), (20, 16, 4)]


def test_paths_named_in_decisions(spark):
    listing = spark.createDataFrame([("/b.pdf",), ("/a.pdf",)], "path string")
    named = spark.createDataFrame([(" /a.pdf",), ("",), (None,), ("/gone.pdf",)], "PDFPath string")
    assert [r.path for r in I.existing_paths(listing).collect()] == ["/a.pdf", "/b.pdf"]
    assert [r.path for r in I.existing_paths(listing, named).collect()] == ["/a.pdf"]


def test_lists_are_zipped_to_the_shortest(spark):
    rows = spark.createDataFrame([(1, ["| a | b |\n| 1 | 2 |", "x"], ["before"], ["after", "z"])], "doc_id long, tables array<string>, infos array<string>, annotations array<string>")
    assert [tuple(r)[1:] for r in T.zipped_tables(rows).collect()] == [("table_1", "| a | b |\n| 1 | 2 |", "before", "after", 2, 2)]


def test_pages_stream_and_fail_apart(spark):
    def make():
        def render(r):
            yield b"1"
            if r["path"] == "bad":
                raise ValueError("torn")
            yield b"2"

        return render

    files = spark.createDataFrame([("good",), ("bad",)], "path string")
    got = sorted((r.path, r.page_num, bytes(r.image) if r.image else None, r.error) for r in A.explode_pages(files, make, ["path"]).collect())
    assert got == [("bad", 1, b"1", None), ("bad", 2, None, "ValueError: torn"), ("good", 1, b"1", None), ("good", 2, b"2", None)]


def test_texts_of_concept_scores_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Their files may be smaller than the concepts'."""
    texts, concepts = f"{tmp_path}/texts", f"{tmp_path}/concepts"
    spark.createDataFrame([(1, "Steel and a red cat"), (2, "nothing"), (3, None)], "text_id long, text string").coalesce(1).write.parquet(texts)
    long = [(str(i), f"{i}w{i * i}", f"d{i * 7} e{i * 11}") for i in range(2000)]
    spark.createDataFrame([("c", "red cat", "steel of a cat"), ("d", "Cat", "nothing"), *long], "concept_id string, name string, definitions string").coalesce(1).write.parquet(concepts)

    def sent(plan):
        """Whether a broadcast reads the texts."""
        deep, found = None, 0
        for line in plan.splitlines():
            at = len(line) - len(line.lstrip(" :+-"))
            deep = None if deep is not None and at <= deep else deep
            deep = at if deep is None and "BroadcastExchange" in line else deep
            found += deep is not None and "FileScan parquet [text_id" in line
        return found

    for size, broadcasts in ((O.SENT, 3), (0, 0)):
        monkeypatch.setattr(O, "SENT", size)
        df = O.concept_scores(spark.read.parquet(texts), spark.read.parquet(concepts))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet [text_id" in plan and not sent(plan)
        assert plan.count("BroadcastExchange") == broadcasts
        assert sorted(map(tuple, df.collect())) == [(1, "c", 3.5), (1, "d", 2.0), (2, "d", 0.5)]


def test_pages_are_handed_on_in_bounded_batches_by_many_tasks(spark, monkeypatch):
    def make():
        def render(r):
            for i in range(r["n"]):
                yield b"x" * (i + 1)
            if r["n"] == 3:
                raise ValueError("torn")

        return render

    files = spark.range(200).selectExpr("string(id) AS path", "int(id % 4) AS n").coalesce(1)
    expected = sorted([(str(i), k + 1, k + 1, None) for i in range(200) for k in range(i % 4)] + [(str(i), 4, None, "ValueError: torn") for i in range(3, 200, 4)])
    work = {}

    def kept(rows, f, schema):
        work["f"], work["tasks"] = f, rows.rdd.getNumPartitions()
        return mapped(rows, f, schema)

    mapped = type(files).mapInPandas
    monkeypatch.setattr(type(files), "mapInPandas", kept)
    for most, size in ((A.PAGES, A.PAGE_BYTES), (7, A.PAGE_BYTES), (100, 5), (100, 1)):
        monkeypatch.setattr(A, "PAGES", most)
        monkeypatch.setattr(A, "PAGE_BYTES", size)
        out = A.explode_pages(files, make, ["path", "n"])
        assert work["tasks"] == 4  # the session's number
        batches = list(work["f"](iter([files.toPandas()])))
        rows = [r for b in batches for r in b.itertuples(index=False)]
        assert sorted((r.k, r.page_num, len(r.image) if r.image else None, r.error) for r in rows) == expected
        assert len(batches) <= 1 + len(rows) // min(most, max(1, size // 30))
        assert all(len(b) <= most and (len(b) == 1 or sum(len(x or b"") for x in b["image"]) <= size) for b in batches)
    assert sorted((r.path, r.page_num, len(r.image) if r.image else None, r.error) for r in out.collect()) == expected
