"""Registered queries at the library's edges: files written and read back, streams, services, models.

Files go to the shared folder, where every executor sees them; services and models are deterministic
doubles.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import adapters as A
from ..functions import text as X
from ..functions import validate as V
from ..operators import features as E
from ..operators import ingest as I
from ..operators import ontology as O
from ..operators import reports as R
from ..operators import screening as C
from ..operators import tables as T
from ..shared import new_path, running
from ..sources import files as S
from ..streaming import resume as Z
from .queries import query
from .views import table, view


def put(spark: SparkSession, folder: str, name: str, content: bytes) -> None:
    """A small file, made by the driver on whatever file system the shared folder is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, name)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(content))
    out.close()


# ---- files


@query(
    """SELECT (30000000 + c_custkey)::VARCHAR AS "PMID", 'Study of "' || c_name || '", part 1' AS "Title", CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS "Journal/Book" FROM customer WHERE c_custkey % 5 > 0"""
)
def records_csv(spark: SparkSession, d: str) -> DataFrame:
    """A record file read, typed, exported, and the export read again."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(
        F.when(k % 5 > 0, (k + 30000000).cast("string")).otherwise("x").alias(" PMID "), F.concat(F.lit(' Study of "'), "c_name", F.lit('", part 1 ')).alias("Article Title"),
        F.when(k % 3 > 0, F.col("c_mktsegment")).otherwise("  ").alias("Journal"),
    )
    first, second = new_path(spark, "records"), new_path(spark, "export")
    S.write_csv(rows, first)
    S.write_csv(I.export_rows(I.records(S.read_records(spark, first))), second)
    return S.read_records(spark, second).select("PMID", "Title", "`Journal/Book`")


@query(
    """SELECT n_name AS doc_id, CASE WHEN n_nationkey % 4 = 0 THEN 'blank' WHEN n_nationkey % 4 = 1 THEN 'too_little_text' END AS reason, n_nationkey % 4 > 0 AS processed, length(n_comment) AS n_chars
    FROM (SELECT n_name, n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN ' ' || chr(10) WHEN 1 THEN '# 12 345' ELSE '# ' || n_name || chr(10) || 'nation of the region ' || n_regionkey END AS n_comment FROM nation)"""
)
def markdown_files(spark: SparkSession, d: str) -> DataFrame:
    """A folder of Markdown files: those found, those usable, those processed."""
    folder = new_path(spark, "markdown")
    for r in table(spark, d, "nation").collect():  # 25 rows
        kind = r.n_nationkey % 4
        put(spark, folder, f"{r.n_name}.md", (" \n" if kind == 0 else "# 12 345" if kind == 1 else f"# {r.n_name}\nnation of the region {r.n_regionkey}").encode())
    put(spark, folder, "not.txt", b"no Markdown")
    done = S.processed(spark, folder).select("doc_id", F.lit(True).alias("p"))
    rows = S.read_markdown(spark, folder).join(done, "doc_id", "left")
    return rows.select("doc_id", V.markdown_reason("md").alias("reason"), F.coalesce("p", F.lit(False)).alias("processed"), F.length("md").cast("bigint").alias("n_chars"))


@query(
    """WITH f AS (SELECT n_name AS pmid, CASE n_nationkey % 3 WHEN 0 THEN 'too_small' WHEN 1 THEN 'bad_header' END AS reason FROM nation)
    SELECT pmid, reason, reason IS NULL AS downloaded, row_number() OVER (ORDER BY pmid) AS place, pmid < 'G' AS named FROM f"""
)
def pdf_files(spark: SparkSession, d: str) -> DataFrame:
    """A folder of PDF files: why some are not usable, those downloaded, the list in order, and those that
    a table of decisions names."""
    folder = new_path(spark, "pdfs")
    for r in table(spark, d, "nation").collect():  # 25 rows
        put(spark, folder, f"{r.n_name}.pdf", (b"%PDF-", b"GIF89" + b"x" * 200, b"%PDF-" + b"x" * 200)[r.n_nationkey % 3])
    name = F.regexp_extract("path", r"([^/]*)\.pdf$", 1).alias("pmid")
    found = S.read_pdfs(spark, folder)
    good = S.downloaded(spark, folder).select("pmid", F.lit(True).alias("good"))
    order = I.existing_paths(found).select(F.collect_list("path").alias("all")).select(F.posexplode("all").alias("i", "path")).select("path", (F.col("i") + 1).cast("bigint").alias("place"))
    named = I.existing_paths(found, found.where(name < "G").select(F.concat(F.lit(" "), "path").alias("PDFPath"))).select("path", F.lit(True).alias("yes"))
    rows = found.join(order, "path").join(named, "path", "left").select(name, "reason", "place", F.coalesce("yes", F.lit(False)).alias("named"))
    return rows.join(good, "pmid", "left").select("pmid", "reason", F.coalesce("good", F.lit(False)).alias("downloaded"), "place", "named")


@query(
    """SELECT r_regionkey AS doc_id, i::INT AS table_index, CASE WHEN i = 0 THEN 'table_1' ELSE 'T' || r_regionkey END AS table_id, CASE WHEN i = 0 THEN 3 END AS line_start,
    CASE WHEN i = 0 THEN 'one' || chr(10) || r_name ELSE '' END AS before_context, CASE WHEN i = 0 THEN 'after' ELSE '' END AS after_context, '| a |' || chr(10) || '|---|' || chr(10) || '| ' || r_regionkey || ' |' AS table_text
    FROM region CROSS JOIN range(2) t(i)"""
)
def structured_files(spark: SparkSession, d: str) -> DataFrame:
    """Structured content, a JSON file each, joined with the Markdown that its tables are in."""
    folder = new_path(spark, "structured")
    rows = table(spark, d, "region").collect()  # 5 rows
    tables = {r.r_regionkey: f"| a |\n|---|\n| {r.r_regionkey} |" for r in rows}
    for r in rows:
        items = [{"content": tables[r.r_regionkey], "line_start": 3}, {"id": f"T{r.r_regionkey}", "content": tables[r.r_regionkey], "line_start": 0}]
        put(spark, folder, f"{r.r_regionkey}.json", json.dumps({"Tables": items}, indent=1).encode())
    docs = spark.createDataFrame([(r.r_regionkey, f"one\n{r.r_name}\n{tables[r.r_regionkey]}\nafter") for r in rows], "doc_id long, md string")
    key = F.regexp_extract("path", r"([^/]*)\.json$", 1).cast("bigint")
    out = T.structured_tables(S.read_structured(spark, folder).select(key.alias("doc_id"), "tables").join(docs, "doc_id"))
    return out.select("doc_id", "table_index", "table_id", "line_start", "before_context", "after_context", "table_text")


@query("SELECT doc_id, source, lang, n_chars, 'é ' || doc_id AS title FROM documents WHERE doc_id IS NOT NULL")
def sections_json(spark: SparkSession, d: str) -> DataFrame:
    """Results written as JSON, a folder for each source, and read back with their keys."""
    folder = new_path(spark, "json")
    rows = table(spark, d, "documents").where("doc_id IS NOT NULL").select("doc_id", F.concat(F.lit("s"), "source").alias("part"), F.struct("source", "lang", "n_chars").alias("x"), F.concat(F.lit("é "), F.col("doc_id").cast("string")).alias("title"))
    S.write_json(rows, folder, "part")
    return spark.read.schema("doc_id long, x struct<source:string,lang:string,n_chars:long>, title string").json(folder).select("doc_id", "x.*", "title")


@query("SELECT count(*) AS total, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status IN ('failed', 'error')) AS failed, count(*) FILTER (status = 'skipped') AS skipped FROM v_dl", "v_dl")
def report_json(spark: SparkSession, d: str) -> DataFrame:
    """A report written as one JSON file and read back."""
    folder = new_path(spark, "report")
    S.write_report(R.batch_totals(view(spark, d, "v_dl")), folder)
    return spark.read.schema("total long, succeeded long, failed long, skipped long").json(folder)


@query("SELECT DISTINCT pmid FROM v_dl WHERE status IN ('failed', 'error') AND error_message IS NOT NULL", "v_dl")
def failed_list(spark: SparkSession, d: str) -> DataFrame:
    """The list of failed downloads, written with tabs, read back to resume from."""
    path = new_path(spark, "failed")
    S.write_csv(R.failed_downloads(view(spark, d, "v_dl")), path, sep="\t")
    return S.failed_pmids(spark, path)


@query("SELECT CAST(p_partkey AS VARCHAR) AS concept_id, p_name AS name, row_number() OVER (ORDER BY p_name, p_partkey) AS place FROM part")
def concepts_file(spark: SparkSession, d: str) -> DataFrame:
    """A concept file written and loaded, its concepts numbered by name."""
    path = new_path(spark, "concepts")
    raw = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.lit("ctp_C6").alias("class_id"), F.col("p_brand").alias("class_name"), F.array("p_type").alias("definitions"))
    S.write_csv(O.concept_definitions(raw), path)
    rows = S.read_records(spark, path).select("concept_id", "name", F.struct("name", F.col("concept_id").cast("bigint").alias("id")).alias("order"))
    return running(rows, "order", place=F.lit(1).cast("bigint")).select("concept_id", "name", "place")


@query("SELECT region || '/' || nation AS path, r_regionkey AS region_key FROM (SELECT r_name AS region, r_regionkey, n_name AS nation FROM region JOIN nation ON r_regionkey = n_regionkey)")
def table_files(spark: SparkSession, d: str) -> DataFrame:
    """Cells written in a folder for each document and table, and found there again."""
    folder = new_path(spark, "tables")
    rows = table(spark, d, "region").join(table(spark, d, "nation"), F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("r_name").alias("doc_id"), F.col("n_name").alias("table_index"), F.col("r_regionkey").alias("value"))
    S.write_table_files(rows, folder)
    back = spark.read.option("header", True).csv(folder)
    return back.select(F.concat("doc_id", F.lit("/"), "table_index").alias("path"), F.col("value").cast("bigint").alias("region_key"))


@query("SELECT true AS shared, false AS missing_scheme")
def writable_folders(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(1).select(F.lit(S.writable(spark, new_path(spark, "probe"))).alias("shared"), F.lit(S.writable(spark, "nosuch://host/folder")).alias("missing_scheme"))


# ---- validity


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'missing' WHEN event_id % 5 = 1 THEN 'too_small' WHEN event_id % 5 = 2 THEN 'bad_header' END AS pdf,
    CASE WHEN event_id % 4 = 0 THEN 'missing' WHEN event_id % 4 = 1 THEN 'empty' WHEN event_id % 4 = 2 THEN 'too_little_text' END AS markdown FROM events""")
def file_validity(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    body = F.when(n % 5 == 1, "%PDF-1").when(n % 5 == 2, F.repeat(F.lit("GIF8 "), F.lit(40))).when(n % 5 > 2, F.repeat(F.lit("%PDF-"), F.lit(40))).cast("binary")
    md = F.when(n % 4 == 1, "").when(n % 4 == 2, "# 1 | 2 | ab").when(n % 4 == 3, "# a heading of words")
    return table(spark, d, "events").select("event_id", V.pdf_reason(body).alias("pdf"), V.markdown_reason(md).alias("markdown"))


@query(
    """SELECT count(*) AS total_rows, 'DOI' AS missing_columns, (SELECT string_agg(raw_pmid, '|' ORDER BY row_no) FROM (SELECT row_no, raw_pmid FROM v_pmid WHERE NOT regexp_full_match(trim(raw_pmid), '[0-9]{5,10}') ORDER BY row_no LIMIT 5)) AS bad_pmids FROM v_pmid""",
    "v_pmid",
)
def first_bad(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_pmid").withColumnRenamed("raw_pmid", "PMID")
    return I.check_columns(rows, ("PMID", "DOI")).select("total_rows", F.array_join("missing_columns", "|").alias("missing_columns"), F.array_join("bad_pmids", "|").alias("bad_pmids"))


@query(
    """SELECT pmid, 'http://eutils.ncbi.nlm.nih.gov/entrez/eutils/elink.fcgi?dbfrom=pubmed&id=' || pmid || '&retmode=ref&cmd=prlinks' AS elink,
    'https://www.ebi.ac.uk/europepmc/webservices/rest/search?query=EXT_ID:' || pmid || '%20AND%20SRC:MED&format=json&resultType=core' AS europe_pmc,
    'https://www.ncbi.nlm.nih.gov/pmc/utils/idconv/v1.0/?ids=' || pmid || '&format=json' AS idconv, 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || event_id || '/pdf/' AS pmc_pdf FROM v_dl""",
    "v_dl",
)
def service_addresses(spark: SparkSession, d: str) -> DataFrame:
    pmcid = F.concat(F.lit("PMC"), F.col("event_id").cast("string"))
    return view(spark, d, "v_dl").select("pmid", X.service_urls("pmid", pmcid).alias("u")).select("pmid", "u.*")


# ---- reports


@query("SELECT count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status <> 'success') AS failed FROM v_dl", "v_dl")
def run_totals(spark: SparkSession, d: str) -> DataFrame:
    return R.run_summary(view(spark, d, "v_dl").withColumn("status", F.initcap("status")))


@query(
    """SELECT done, completed, failed FROM (SELECT row_number() OVER (ORDER BY o_orderkey) AS done, sum((o_orderkey % 3 > 0)::INT) OVER (ORDER BY o_orderkey)::BIGINT AS completed,
    sum((o_orderkey % 3 = 0)::INT) OVER (ORDER BY o_orderkey)::BIGINT AS failed FROM orders) WHERE done % 10 = 0"""
)
def progress_marks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, "completed").otherwise("failed").alias("stage"))
    return R.progress(rows, "o_orderkey")


# ---- screening criteria

CRITERIA = {
    "review_name": "r", "research_field": "f", "research_topic_statement": "language", "methodology": {"include": ["fMRI"], "exclude": None}, "participant_scope": "adults", "disease_and_case_report_policy": "none",
    "publication_filters": {}, "decision_policy": {"min_confidence_to_include": 0.6},
}


@query(
    """SELECT doc_id::VARCHAR AS pmid, doc_id % 10 >= 6 AS include, 'fMRI' AS methodology, 0 AS n_exclude, '["language",0.6]' AS shown FROM documents"""
)
def screening_criteria(spark: SparkSession, d: str) -> DataFrame:
    """Decisions above the confidence that the criteria ask for, and the criteria as a judge is shown them."""
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("pmid"), F.lit("t").alias("title"), F.lit("a").alias("abstract"), F.lit(True).alias("include"), ((F.col("doc_id") % 10) / 10).alias("confidence"))
    criteria = C.criteria_frame(spark, CRITERIA).select(F.from_json("criteria", "research_topic_statement string, methodology_include array<string>, methodology_exclude array<string>, decision_policy struct<min_confidence_to_include:double>").alias("c")).first().c
    sure = C.confident(rows, criteria.decision_policy.min_confidence_to_include)
    shown = F.to_json(F.struct(F.lit(criteria.research_topic_statement).alias("topic"), F.lit(criteria.decision_policy.min_confidence_to_include).alias("least")))
    asked = C.prompts(rows, shown).select("pmid", F.try_parse_json(F.substring_index("prompt", "\n", -1)).alias("v"))
    inner = F.from_json(F.try_variant_get("v", "$.criteria", "string"), "topic string, least double")
    asked = asked.select("pmid", F.concat(F.lit('["'), inner["topic"], F.lit('",'), inner["least"].cast("string"), F.lit("]")).alias("shown"))
    return sure.join(asked, "pmid").select("pmid", "include", F.lit(criteria.methodology_include[0]).alias("methodology"), F.lit(len(criteria.methodology_exclude)).alias("n_exclude"), "shown")


# ---- models and services


def answers_double():
    """Of an even task all features are there; of an odd one the model fails."""

    def ask(r: dict) -> str:
        if r["task_name"].endswith("odd"):
            raise ValueError("no answer")
        return json.dumps(dict.fromkeys(json.loads(r["leaves"]), "present"))

    return ask


@query(
    f"""SELECT task_id, n.feature, CASE WHEN s_suppkey % 2 = 0 AND s_suppkey % 7 > 0 THEN 0 ELSE 1 END AS value FROM (SELECT s_suppkey, 'paper_' || row_number() OVER (ORDER BY s_suppkey) AS task_id FROM supplier)
    CROSS JOIN (SELECT unnest([{", ".join(repr(n) for n in O.NODES)}]) AS feature) n"""
)
def feature_answers(spark: SparkSession, d: str) -> DataFrame:
    """Three questions on each paper, merged and closed upwards. Blank methods are not asked about."""
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(F.lit(None).cast("string").alias("task_id"), F.concat(F.lit("task "), F.when(k % 2 == 0, "even").otherwise("odd")).alias("task_name"), F.when(k % 7 == 0, " ").otherwise(F.repeat(F.lit("We. "), F.lit(900))).alias("methods"), "s_suppkey")
    papers = E.paper_ids(rows, "s_suppkey").select("task_id", "task_name", "methods")
    return E.extract_features(papers, answers_double)


@query(
    """SELECT (30000000 + c_custkey)::VARCHAR AS pmid, CASE WHEN c_custkey % 4 > 0 THEN 'About ' || (30000000 + c_custkey) END AS abstract, CASE WHEN c_custkey % 4 = 0 THEN 'no abstract' END AS error FROM customer"""
)
def abstract_answers(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "customer").select((F.col("c_custkey") + 30000000).cast("string").alias("pmid"))
    return A.fetch_abstracts(ids, lambda asked: {p: f"About {p}" for p in asked if int(p) % 4}, size=50)


def chunks_double():
    def get(r: dict):
        n = int(r["pmid"])
        yield b"%PDF-" if n % 3 else b"<html>"
        if n % 5 == 0:
            raise OSError("cut off")
        for _ in range(3):
            yield b"x" * 100

    return get


@query(
    """SELECT c_custkey::VARCHAR AS pmid, CASE WHEN c_custkey % 3 > 0 AND c_custkey % 5 > 0 THEN 305 END AS size, CASE WHEN c_custkey % 5 = 0 THEN 'OSError: cut off' WHEN c_custkey % 3 = 0 THEN 'ValueError: not a PDF' END AS error FROM customer"""
)
def downloads_in_chunks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("pmid"))
    return A.download(rows, chunks_double, ["pmid"]).select("pmid", F.octet_length("content").alias("size"), "error")


def render_double():
    def render(r: dict):
        n = int(r["path"])
        for i in range(n % 4):
            yield b"p" * (i + 1)
        if n % 4 == 3:
            raise ValueError("broken page")

    return render


@query(
    """SELECT c_custkey::VARCHAR AS path, i::INT AS page_num, CASE WHEN i <= c_custkey % 4 THEN i END::INT AS size, CASE WHEN i > c_custkey % 4 THEN 'ValueError: broken page' END AS error
    FROM customer CROSS JOIN range(1, 5) t(i) WHERE i <= c_custkey % 4 OR (c_custkey % 4 = 3 AND i = 4)"""
)
def rendered_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("path"))
    return A.explode_pages(rows, render_double, ["path"]).select("path", "page_num", F.octet_length("image").alias("size"), "error")


@query(
    """SELECT page_id, CASE WHEN page_id % 3 > 0 THEN 'https://s.org/' || page_id || '.pdf' END AS pdf_url FROM pages"""
)
def two_hop_links(spark: SparkSession, d: str) -> DataFrame:
    """The finder that asks two more pages, with a double of the fetcher, as the only source."""

    def fetch(url: str) -> str:
        n = url.rsplit("/", 1)[1]
        if "/a/" in url:
            return f'<head><meta name="citation_title" content="t"><meta name="citation_pdf_url" content="https://s.org/b/{n}"></head>'
        return f"<a href='https://s.org/{n}.pdf'>here</a><a href='x'>y</a>"

    n = F.col("page_id").cast("string")
    page = F.when(F.col("page_id") % 3 > 0, F.concat(F.lit('<form><input type="hidden" value="https%3A%2F%2Fs.org%2Fa%2F'), n, F.lit('"></form>'))).otherwise("<p>no form</p>")
    out = A.call(table(spark, d, "pages").select("page_id", page.alias("html")), A.first_source([A.science_direct(fetch)]), ["html"])
    return out.select("page_id", F.try_variant_get(F.try_parse_json("answer"), "$.pdf_url", "string").alias("pdf_url"))


# ---- tables


@query(
    """SELECT s_suppkey AS doc_id, 'table_' || i AS table_id, 'before ' || i AS preceding_context, 'after ' || i AS following_context, 3 AS num_rows, 2 AS num_columns FROM supplier CROSS JOIN range(1, 3) t(i)"""
)
def zipped_lists(spark: SparkSession, d: str) -> DataFrame:
    two = lambda word, n: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit(f"{word} "), i.cast("string")))
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id"), F.array_repeat(F.lit("| a | b |\n|---|---|\n| 1 | 2 |"), 3).alias("tables"), two("before", 2).alias("infos"), two("after", 4).alias("annotations"))
    return T.zipped_tables(rows).drop("table_content")


@query(
    """SELECT s_suppkey AS doc_id, 'r' || s_suppkey AS region, s_suppkey::DOUBLE AS x, -1.5::DOUBLE AS y, CASE WHEN s_suppkey % 2 = 0 THEN 3.0 END::DOUBLE AS z, '<0.001' AS p, NULL::DOUBLE AS p_number FROM supplier"""
)
def coordinate_rows(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("s_suppkey")
    row = F.create_map(F.lit("Region"), F.concat(F.lit("r"), n.cast("string")), F.lit("X"), n.cast("string"), F.lit("y"), F.lit("-1.5"), F.lit("Z"), F.when(n % 2 == 0, "3").otherwise("n/a"), F.lit("P_value"), F.lit("<0.001"))
    return table(spark, d, "supplier").select(n.alias("doc_id"), F.get(T.canonical_rows(F.array(row)), F.lit(0)).alias("r")).select("doc_id", "r.region", "r.x", "r.y", "r.z", "r.p", "r.p_number")


# ---- streams


@query("SELECT (30000000 + c_custkey)::VARCHAR AS pmid, 1::BIGINT AS times, c_custkey % 3 AS part FROM customer")
def records_once(spark: SparkSession, d: str) -> DataFrame:
    """Three files that share identifiers arrive in two runs of a stream; each identifier is done once."""
    folder, out, checkpoint = (new_path(spark, n) for n in ("arrivals", "done", "checkpoint"))
    rows = table(spark, d, "customer").select((F.col("c_custkey") + 30000000).cast("string").alias("PMID"), (F.col("c_custkey") % 3).cast("string").alias("part"))
    for part in (rows.where("part < 2"), rows):  # the second run sees the first one's identifiers again
        part.write.mode("append").option("header", True).csv(folder)
        stream = Z.new_records(spark, folder, "PMID string, part string")
        Z.process_once(stream, lambda df: df.select("pmid", F.col("part").cast("bigint").alias("part")), out, checkpoint).awaitTermination()
    return spark.read.parquet(out).groupBy("pmid", "part").agg(F.count("*").alias("times"))


@query("SELECT r_name AS doc_id, 2::BIGINT AS n FROM region")
def arrivals_segmented(spark: SparkSession, d: str) -> DataFrame:
    """Markdown files segmented as they arrive, in two runs of a stream."""
    folder, out, checkpoint = (new_path(spark, n) for n in ("arrivals", "segments", "checkpoint"))
    rows = table(spark, d, "region").collect()  # 5 rows
    for some in (rows[:2], rows[2:]):
        for r in some:
            put(spark, folder, f"{r.r_name}.md", f"## Methods\nWe read {r.r_name}.\n## Results\nNone.\n".encode())
        Z.segment_arrivals(spark, folder, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).groupBy("doc_id").agg(F.count("*").alias("n"))
