from pyspark.sql import functions as F

from litspark.functions import text as X
from litspark.functions import validate as V


def one(spark, value, *columns):
    return tuple(spark.createDataFrame([(value,)], "x string").select(*columns).first())


def test_newlines_vanish_in_clean_text(spark):
    assert one(spark, " a\n\n b　c ", X.clean_text("x")) == ("a b c",)
    assert one(spark, None, X.clean_text("x"), X.normalize_text("x"), X.count_words("x"), X.count_tokens("x")) == ("", "", 0, 0)


def test_full_stop_ends_no_sentence_in_chinese(spark):
    assert one(spark, "a. b! c", X.sentences("x"), X.sentences("x", "zh")) == (["a", "b", "c"], ["a. b", "c"])


def test_tabs_are_removed_not_collapsed(spark):
    assert one(spark, "a\tb\r\nc  d\r", X.normalize_text("x")) == ("ab\nc d",)


def test_sections(spark):
    got = one(spark, "x METHODS: m+(1)\nmore Results r", X.extract_section("x", "methods:", "results"), X.extract_section("x", "m+(1)"), X.extract_section("x", "none"))
    assert got == ("m+(1)\nmore", "more Results r", "")


def test_words_are_not_tokens(spark):
    assert one(spark, "naïve été 中文 x_1 a-b", X.count_words("x"), X.count_tokens("x")) == (6, 5)


def test_references_go_from_mid_sentence_on(spark):
    assert one(spark, "see references in\nthe end", X.remove_references("x")) == ("see",)


def test_languages(spark):
    langs = [one(spark, t, X.detect_language("x"))[0] for t in ("", "语言处理", "语言abc", "abc。。", None)]
    assert langs == ["en", "zh", "mixed", "en", "en"]


def test_two_rule_sets(spark):
    got = {h: one(spark, h, X.rule_category("x"), X.list_rule_category("x")) for h in ("2. Materials and Methods", "Statistical results", "Authors", "Thanks")}
    assert got == {"2. Materials and Methods": ("Methods", "Author"), "Statistical results": ("Methods", "Results"), "Authors": ("Author", "Author"), "Thanks": ("Other", "Acknowledgements")}


def test_file_names(spark):
    assert one(spark, 'a<b>:"c".txt ', X.sanitize_filename("x")) == ("a_b___c_.txt",)
    assert one(spark, "a" * 30 + ".md", X.sanitize_filename("x", 10)) == ("a" * 7 + ".md",)
    assert one(spark, "/d.e/F.TXT", X.file_extension("x")) == (".txt",)
    assert one(spark, "/d/paper.md", X.file_stem("x", ".md")) == ("paper",)


def test_csv_of_an_answer(spark):
    assert one(spark, "Sure!\n```csv\nX,Y\n1,2\n```\nnot here\nq,r", X.clean_csv_text("x")) == ("X,Y\n1,2",)


def test_legacy_clean_up_destroys_text(spark):
    assert one(spark, "| a | b |\n|---|---|", X.legacy_postprocess("x"))[0].count("a") == 0


def test_answer_fields(spark):
    assert [one(spark, t, X.response_text("x"))[0] for t in ('{"markdown": " ", "text": "t"}', "plain", '{"z": 1}')] == ["t", "plain", ""]


def test_quality_needs_confidence_to_be_good(spark):
    long = "line\n" * 4000
    score, level = X.ocr_quality("x")
    assert one(spark, long, level) == ("fair",)
    assert one(spark, long, X.ocr_quality("x", F.lit(100.0))[1]) == ("excellent",)
    assert one(spark, "", score, level) == (0.0, "poor")


def test_identifiers(spark):
    cases = {None: "empty", "": "empty", "  ": "not_numeric", "12": "bad_length", " 12345\t": None, "x1": "not_numeric", "12345678901": "bad_length"}
    assert {k: one(spark, k, V.pmid_reason("x"))[0] for k in cases} == cases
    assert one(spark, "1", V.downloadable_pmid("x")) == (True,)


def test_files(spark):
    pdf = b"%PDF-" + b"0" * 100
    rows = spark.createDataFrame([(pdf,), (b"%PDF-",), (b"x" * 200,), (None,)], "x binary")
    assert [r[0] for r in rows.select(V.pdf_reason("x")).collect()] == [None, "too_small", "bad_header", "missing"]
    texts = [one(spark, t, V.markdown_reason("x"))[0] for t in (None, "", " \n ", "1234567890123", "enough text here")]
    assert texts == ["missing", "empty", "blank", "too_little_text", None]


def test_addresses_of_services(spark):
    got = one(spark, "123", X.service_urls("x", F.lit("PMC9")).alias("u"))[0]
    assert got.pmc_pdf == "https://pmc.ncbi.nlm.nih.gov/articles/PMC9/pdf/"
    assert "id=123&" in got.elink
