from pyspark.sql import functions as F

from litspark.sources import files
from litspark.streaming import resume


def test_markdown_folder(spark, tmp_path):
    (tmp_path / "a.md").write_text("# A\n\n| x |\n")
    (tmp_path / "b.md").write_text("   ")
    (tmp_path / "c.txt").write_text("no")
    assert {r.doc_id for r in files.read_markdown(spark, str(tmp_path)).collect()} == {"a", "b"}
    assert [r.doc_id for r in files.processed(spark, str(tmp_path)).collect()] == ["a"]


def test_pdf_folder(spark, tmp_path):
    (tmp_path / "1.pdf").write_bytes(b"%PDF-" + b"0" * 200)
    (tmp_path / "2.pdf").write_bytes(b"junk" * 100)
    assert [r.pmid for r in files.downloaded(spark, str(tmp_path)).collect()] == ["1"]


def test_records_round_trip(spark, tmp_path):
    (tmp_path / "in.csv").write_text('PMID, Title \n0012345,"a, ""b"""\n,\n')
    rows = files.read_records(spark, str(tmp_path / "in.csv"))
    assert rows.columns == ["PMID", "Title", "row_no"] and rows.first().PMID == "0012345" and rows.first().Title == 'a, "b"'
    files.write_csv(rows.where("false"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    files.write_csv(rows.select("PMID", "Title"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True, escape='"').count() == 2


def test_json_files(spark, tmp_path):
    (tmp_path / "d_structured_content.json").write_text('{"Tables": [{"id": "table_1", "content": "| a |", "line_start": 2}], "Title": "x"}')
    assert files.read_structured(spark, str(tmp_path)).first().tables[0].line_start == 2
    files.write_report(spark.range(1).select(F.lit("é").alias("a")), str(tmp_path / "report"))
    assert "é" in spark.read.text(str(tmp_path / "report")).first().value


def test_each_identifier_once(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    (src / "1.csv").write_text("PMID,Title\n12345,a\n12345,b\nbad,c\n")

    def run():
        stream = resume.new_records(spark, str(src), "PMID string, Title string")
        resume.process_once(stream, lambda df: df.select("pmid", "Title"), out, ckpt).awaitTermination()
        return sorted(r.pmid for r in spark.read.parquet(out).collect())

    assert run() == ["12345"]
    assert run() == ["12345"]
    (src / "2.csv").write_text("PMID,Title\n12345,again\n54321,d\n")
    assert run() == ["12345", "54321"]


def test_arrivals_are_segmented(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "p.md").write_text("# T\n## Methods\nx\n")
    resume.segment_arrivals(spark, str(src), out, str(tmp_path / "ckpt")).awaitTermination()
    assert {r.heading for r in spark.read.parquet(out).collect()} == {"T", "Methods"}
