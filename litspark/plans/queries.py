"""The registered queries over the derived inputs, each with the SQL that DuckDB answers it by."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import validate as V
from ..adapters import echo_ocr, keyword_judge
from ..operators import html as H
from ..operators import ingest as I
from ..operators import model_tables as M
from ..operators import ontology as O
from ..operators import reports as R
from ..operators import screening as C
from ..operators import segment as S
from ..operators import tables as T
from ..shared import written
from . import pipelines as P
from .views import duck, table, view

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    """Register a query with its SQL, the views it uses put in front."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ctes = ",\n".join(f"{v} AS ({duck(v)})" for v in views)
            recursive = "RECURSIVE " if "--recursive" in sql else ""
            body = sql.replace("--recursive", "").strip()
            if ctes:
                body = f"WITH {recursive}{ctes}" + (f",\n{body[5:]}" if body.startswith("WITH ") else f"\n{body}")
            SQL[f.__name__] = body
        return f

    return put


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x)


def sql_rules(x: str, rules: dict) -> str:
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'contains({x}, {w!r})' for w in words)} THEN '{name}'" for name, words in rules.items()) + " ELSE 'Other' END"


def norm(h: str) -> str:
    return strip(rf"regexp_replace(regexp_replace(lower({h}), '^[\d.\-()\s]+', ''), '\s+', ' ', 'g')")


CLEAN = strip(r"regexp_replace(md, '\s+', ' ', 'g')")


# ---- texts


@query(f"SELECT doc_id, {CLEAN} AS cleaned FROM v_md", "v_md")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_md").select("doc_id", X.clean_text("md").alias("cleaned"))


@query(
    f"""SELECT doc_id, len(x) AS n, x[1] AS first, array_to_string(x, '/') AS joined FROM (
    SELECT doc_id, list_filter(list_transform(string_split_regex({CLEAN}, '[.!?;]'), lambda s: {strip('s')}), lambda s: s <> '') AS x FROM v_md)""",
    "v_md",
)
def sentences(spark: SparkSession, d: str) -> DataFrame:
    x = X.sentences("md")
    return view(spark, d, "v_md").select("doc_id", x.alias("x")).select("doc_id", F.size("x").cast("bigint").alias("n"), F.get("x", F.lit(0)).alias("first"), F.array_join("x", "/").alias("joined"))


@query(
    rf"""SELECT doc_id, {strip(r"regexp_replace(regexp_replace(regexp_replace(chr(13) || chr(10) || replace(md, ' the ', chr(9) || ' the' || chr(9)  || '  '), '\r\n?', chr(10), 'g'), '[\x00-\x09\x0b-\x1f]', '', 'g'), ' +', ' ', 'g')")} AS normal FROM v_md""",
    "v_md",
)
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.lit("\r\n"), F.replace("md", F.lit(" the "), F.lit("\t the\t  ")))
    return view(spark, d, "v_md").select("doc_id", X.normalize_text(x).alias("normal"))


@query(
    rf"""SELECT doc_id, {strip(r"coalesce(regexp_extract(md, '(?is)introduction(.*?)(?:## Results|\z)', 1), '')")} AS body,
    {strip(r"coalesce(regexp_extract(md, '(?is)METHODS(.*)', 1), '')")} AS rest FROM v_md""",
    "v_md",
)
def extract_section(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_md").select("doc_id", X.extract_section("md", "introduction", "## Results").alias("body"), X.extract_section("md", "METHODS").alias("rest"))


@query(
    r"""SELECT doc_id, len(regexp_extract_all(md, '[\p{L}\p{N}\p{M}_]+')) AS n_regex,
    len(list_filter(string_split_regex(md, '\s+'), lambda w: w <> '')) AS n_space FROM v_md""",
    "v_md",
)
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_md").select("doc_id", X.count_words("md").cast("bigint").alias("n_regex"), X.count_tokens("md").cast("bigint").alias("n_space"))


@query(rf"SELECT doc_id, {strip(r'''regexp_replace(regexp_replace(md, '(?is)References.*', ''), '(?is)Bibliography.*', '')''')} AS body FROM v_md", "v_md")
def remove_references(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_md").select("doc_id", X.remove_references("md").alias("body"))


@query(
    """SELECT doc_id, CASE WHEN zh > 0.3 AND en > 0.3 THEN 'mixed' WHEN zh > en THEN 'zh' ELSE 'en' END AS language FROM (
    SELECT doc_id, length(regexp_replace(t, '[^一-鿿]', '', 'g')) / length(t)::DOUBLE AS zh, length(regexp_replace(t, '[^a-zA-Z]', '', 'g')) / length(t)::DOUBLE AS en
    FROM (SELECT doc_id, left(CASE doc_id % 3 WHEN 0 THEN repeat('语言', 200) || text WHEN 1 THEN repeat('语言处理', 150) ELSE text END, 1000) AS t FROM documents))"""
)
def detect_language(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("doc_id") % 3
    x = F.when(r == 0, F.concat(F.repeat(F.lit("语言"), 200), F.col("text"))).when(r == 1, F.repeat(F.lit("语言处理"), 150)).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", X.detect_language(x).alias("language"))


@query("SELECT doc_id, array_to_string(list_filter(['Subjects', 'ANOVA', 'page 2', 'the', 'zzz'], lambda k: contains(lower(md), lower(k))), ',') AS found FROM v_md", "v_md")
def find_keywords(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_md").select("doc_id", F.array_join(X.find_keywords("md", ["Subjects", "ANOVA", "page 2", "the", "zzz"]), ",").alias("found"))


@query(
    r"""SELECT page_id, array_to_string((string_split(url, '/'))[1:3], '/') AS main, regexp_replace(url, '[<>:"/\\|?*]', '_', 'g') AS file_name,
    lower(regexp_extract(regexp_extract(url, '([^/]*)/*$', 1), '^.+?(\.[^./]+)$', 1)) AS ext, md5(html) AS md5, sha256(html) AS sha256 FROM pages"""
)
def names_and_digests(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(
        "page_id", X.main_url("url").alias("main"), X.sanitize_filename("url").alias("file_name"), X.file_extension("url").alias("ext"), X.digest("html").alias("md5"), X.digest("html", "sha256").alias("sha256")
    )


@query(
    """SELECT event_id, array_to_string(list_distinct_ordered, ' ') AS urls FROM (SELECT event_id, list_filter([
     'https://pubmed.ncbi.nlm.nih.gov/' || pmid || '/', 'https://www.ncbi.nlm.nih.gov/pmc/?term=' || pmid, 'https://europepmc.org/search?query=EXT_ID:' || pmid || '%20SRC:MED',
     CASE WHEN event_id % 2 = 0 THEN 'https://a.org/' || pmid END, CASE WHEN event_id % 3 = 0 AND NOT (event_id % 2 = 0) THEN 'https://a.org/' || pmid END,
     CASE WHEN event_id % 5 = 0 THEN 'https://b.org/' || pmid END], lambda u: u IS NOT NULL) AS list_distinct_ordered FROM v_dl)""",
    "v_dl",
)
def manual_suggestions(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    a, b = F.concat(F.lit("https://a.org/"), F.col("pmid")), F.concat(F.lit("https://b.org/"), F.col("pmid"))
    met = F.array(F.when(e % 2 == 0, a), F.when(e % 3 == 0, a), F.when(e % 5 == 0, b), F.lit(""))
    return view(spark, d, "v_dl").select("event_id", F.array_join(X.manual_suggestions("pmid", met), " ").alias("urls"))


@query(
    rf"""SELECT doc_id, CASE WHEN md = '' THEN 0.0 ELSE least(30.0, length(md) / 1000.0::DOUBLE * 3) + len(list_filter(string_split(md, chr(10)), lambda s: {strip('s')} <> ''))::DOUBLE / len(string_split(md, chr(10))) * 30 + (doc_id % 101) * 0.4::DOUBLE END AS score,
    CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 70 THEN 'good' WHEN score >= 50 THEN 'fair' ELSE 'poor' END AS level,
    CASE WHEN length(md) < 500 THEN 'too_short' WHEN score >= 80 THEN 'good' WHEN score >= 60 THEN 'medium' ELSE 'poor' END AS tag,
    coalesce(nullif(doc_id % 4, 0), greatest(1, length(md) // 3000))::INT AS pages FROM v_md""",
    "v_md",
)
def ocr_quality(spark: SparkSession, d: str) -> DataFrame:
    score, level = X.ocr_quality("md", (F.col("doc_id") % 101).cast("double"))
    pages = X.page_estimate((F.col("doc_id") % 4).cast("int"), F.length("md"))
    return view(spark, d, "v_md").select("doc_id", score.alias("score"), level.alias("level"), X.quality_tag(score, F.length("md")).alias("tag"), pages.alias("pages"))


# ---- identifiers and records

PMID = strip("raw_pmid")
REASON = rf"CASE WHEN coalesce(raw_pmid, '') = '' THEN 'empty' WHEN NOT regexp_matches({PMID}, '^[0-9]+$') THEN 'not_numeric' WHEN length({PMID}) < 5 OR length({PMID}) > 10 THEN 'bad_length' END"


@query(f"SELECT row_no, {REASON} AS reason, regexp_matches({PMID}, '^[0-9]+$') AS downloadable FROM v_pmid", "v_pmid")
def validate_pmid(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_pmid").select("row_no", V.pmid_reason("raw_pmid").alias("reason"), V.downloadable_pmid("raw_pmid").alias("downloadable"))


@query(
    r"""SELECT page_id, regexp_matches(u, '(?i)^(https?|ftp)://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$') AS url_ok,
    regexp_matches(m, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$') AS mail_ok
    FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'ftp:/' || url WHEN 2 THEN 'http://10.0.0.' || page_id::VARCHAR || ':80/a b' ELSE 'HTTP://localhost?x' END AS u,
      CASE page_id % 3 WHEN 0 THEN 'a' || page_id::VARCHAR || '@b.org' WHEN 1 THEN 'a b@c.de' ELSE 'x@y.z' END AS m FROM pages)"""
)
def validate_addresses(spark: SparkSession, d: str) -> DataFrame:
    p, s = F.col("page_id"), F.col("page_id").cast("string")
    u = F.when(p % 4 == 0, F.col("url")).when(p % 4 == 1, F.concat(F.lit("ftp:/"), "url")).when(p % 4 == 2, F.concat(F.lit("http://10.0.0."), s, F.lit(":80/a b"))).otherwise("HTTP://localhost?x")
    m = F.when(p % 3 == 0, F.concat(F.lit("a"), s, F.lit("@b.org"))).when(p % 3 == 1, "a b@c.de").otherwise("x@y.z")
    return table(spark, d, "pages").select("page_id", V.valid_url(u).alias("url_ok"), V.valid_email(m).alias("mail_ok"))


@query(
    f"""WITH p AS (SELECT {PMID} AS pmid, {REASON} AS reason FROM v_pmid)
    SELECT count(*) AS total_rows, count(DISTINCT CASE WHEN reason IS NULL THEN pmid END) AS valid_records, count(reason) AS invalid_count,
    count(*) - count(reason) - count(DISTINCT CASE WHEN reason IS NULL THEN pmid END) AS duplicate_count FROM p""",
    "v_pmid",
)
def pmid_report(spark: SparkSession, d: str) -> DataFrame:
    return I.management_report(view(spark, d, "v_pmid"))


@query(
    f"""WITH p AS (SELECT row_no, {PMID} AS pmid, {REASON} AS reason FROM v_pmid),
    n AS (SELECT *, row_number() OVER (PARTITION BY pmid, reason IS NULL ORDER BY row_no) AS n FROM p)
    SELECT CASE WHEN reason IS NOT NULL THEN 'invalid' WHEN n > 1 THEN 'duplicate' ELSE 'valid' END AS kind, row_no + 2 AS "row", pmid, reason FROM n""",
    "v_pmid",
)
def pmid_report_lists(spark: SparkSession, d: str) -> DataFrame:
    return I.report_lists(view(spark, d, "v_pmid"))


@query(
    f"""WITH p AS (SELECT *, {PMID} AS pmid FROM v_pmid WHERE ({REASON}) IS NULL)
    SELECT pmid, min(row_no) AS row_no, arg_min(coalesce(title_a, '?'), row_no) AS title_a FROM p GROUP BY pmid""",
    "v_pmid",
)
def unique_records(spark: SparkSession, d: str) -> DataFrame:
    return I.unique_records(view(spark, d, "v_pmid")).select("pmid", "row_no", F.coalesce("title_a", F.lit("?")).alias("title_a"))


@query(f"SELECT {PMID} AS pmid, nullif({strip('coalesce(title_a, title_b)')}, '') AS title FROM v_pmid WHERE ({REASON}) IS NULL", "v_pmid")
def record_coalesce(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_pmid").select(F.col("raw_pmid").alias(" PMID "), F.col("title_a").alias("Title"), F.col("title_b").alias("Article Title"))
    return I.records(rows).select("pmid", "title")


@query(
    f"""WITH r AS (SELECT nullif({strip('coalesce(title_a, title_b)')}, '') AS title, CASE WHEN row_no % 2 = 0 THEN 'J' END AS journal, raw_pmid FROM v_pmid)
    SELECT count(*) AS total, count(*) FILTER (({REASON}) IS NULL) AS valid, count(*) FILTER (({REASON}) IS NOT NULL) AS invalid, 0::BIGINT AS with_abstract, count(title) AS with_title, count(journal) AS with_journal,
    0.0::DOUBLE AS abstract_coverage, count(title) * 100.0::DOUBLE / count(*) AS title_coverage, count(journal) * 100.0::DOUBLE / count(*) AS journal_coverage FROM r""",
    "v_pmid",
)
def record_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_pmid").select(
        F.col("raw_pmid").alias("pmid"), I.first_column([F.col("title_a"), F.col("title_b")]).alias("title"), F.when(F.col("row_no") % 2 == 0, "J").alias("journal"), F.lit(None).cast("string").alias("abstract")
    )
    return I.coverage(rows)


@query(
    """SELECT '3000000' || i AS "PMID", 'Sample Article Title ' || i AS "Title", 'J Sample Res. ' || (2020 + i) || ';' || i || '(' || i || '):' || i * 100 || '-' || i * 100 + 50 AS "Citation",
    '10.1000/sample.' || i AS "DOI", 'PMC' || i || '00000' || i AS "PMCID" FROM range(1, 21) t(i)"""
)
def sample_records(spark: SparkSession, d: str) -> DataFrame:
    return I.sample_records(spark, 20).select("PMID", "Title", "Citation", "DOI", "PMCID")


# ---- segmentation

PAGES = r"regexp_matches(s, '(?i)\*\*Total Pages:\*\*\s*\d+')"
KINDS = rf"""ln AS (SELECT doc_id, unnest(string_split(md, chr(10))) AS raw, generate_subscripts(string_split(md, chr(10)), 1) - 1 AS i FROM v_md),
k0 AS (SELECT *, {strip('raw')} AS s FROM ln),
k1 AS (SELECT *, CASE WHEN regexp_matches(raw, '(?i)</table>') THEN 0 WHEN regexp_matches(s, '(?i)^<table\b[^>]*>') AND NOT {PAGES} THEN 1 END AS mark FROM k0),
k2 AS (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opened FROM k1),
k3 AS (SELECT *, CASE WHEN opened = 1 THEN 'html_body' WHEN s = '' OR regexp_matches(s, '^={{10,}}$|^-{{10,}}$') THEN 'skip' WHEN {PAGES} THEN 'pages'
  WHEN regexp_matches(s, '(?i)^##\s+Page\s+\d+') THEN 'page_marker' WHEN regexp_matches(s, '(?i)^<table\b[^>]*>') THEN 'html_start' WHEN s LIKE '|%' THEN 'pipe' WHEN regexp_matches(s, '^#{{1,6}}\s+') THEN 'heading' ELSE 'text' END AS kind FROM k2),
k AS (SELECT *, (kind = 'html_start' OR (kind = 'pipe' AND coalesce(lag(kind) OVER w, '') <> 'pipe')) AS table_start, (sum((kind = 'heading')::INT) OVER w)::BIGINT AS heads FROM k3 WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""
BLOCKS = (
    KINDS
    + rf""",
b0 AS (SELECT *, (sum(table_start::INT) OVER w)::BIGINT AS table_no, max((kind = 'text' AND heads = 0)::INT) OVER w AS rooted FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
b1 AS (SELECT *, CASE WHEN kind = 'text' THEN raw WHEN table_start AND (heads > 0 OR rooted = 1) THEN '[TABLE: table_' || table_no || ']' END AS line FROM b0),
b AS (SELECT doc_id, coalesce(max(CASE WHEN kind = 'heading' THEN i + 1 END), 1)::INT AS line_start, coalesce(max(CASE WHEN kind = 'heading' THEN {strip("regexp_extract(s, '^#{1,6}" + chr(92) + "s+(.*)', 1)")} END), 'Document_Root') AS heading,
  coalesce(max(CASE WHEN kind = 'heading' THEN length(regexp_extract(s, '^(#{{1,6}})\s', 1)) END), 0)::INT AS heading_level, {strip("coalesce(string_agg(line, chr(10) ORDER BY i), '')")} AS content
  FROM b1 WHERE kind = 'heading' OR line IS NOT NULL GROUP BY doc_id, heads)"""
)
CORE_SQL = "('Introduction', 'Methods', 'Results', 'Discussion', 'References')"
CATS = (
    BLOCKS
    + f""",
c0 AS (SELECT *, {sql_rules(norm('heading'), X.RULES)} AS r0, row_number() OVER (PARTITION BY doc_id ORDER BY line_start) AS n FROM b),
c1 AS (SELECT *, CASE WHEN r0 = 'Other' AND (n = 1 OR heading = 'Document_Root') THEN 'Title' ELSE r0 END AS rule FROM c0),
c2 AS (SELECT doc_id, count(DISTINCT CASE WHEN rule IN {CORE_SQL} THEN rule END) < 5 AS short FROM c1 GROUP BY doc_id),
c AS (SELECT c1.doc_id, line_start, heading, heading_level, content, CASE WHEN short AND rule = 'Other' THEN {sql_rules(norm("heading || ' ' || left(content, 400)"), X.RULES)} ELSE rule END AS category,
  CASE WHEN short THEN 'keyword_fallback' ELSE 'rule_based' END AS strategy FROM c1 JOIN c2 USING (doc_id))"""
)


def md_lines(spark: SparkSession, d: str) -> DataFrame:
    return S.lines(view(spark, d, "v_md"))


def md_blocks(spark: SparkSession, d: str) -> DataFrame:
    return S.segment(view(spark, d, "v_md"))


@query(f"WITH {KINDS} SELECT doc_id, i::INT AS i, kind, table_start, heads FROM k", "v_md")
def line_kinds(spark: SparkSession, d: str) -> DataFrame:
    return S.line_kinds(md_lines(spark, d)).select("doc_id", "i", "kind", "table_start", "heads")


@query(f"WITH {BLOCKS} SELECT * FROM b", "v_md")
def blocks(spark: SparkSession, d: str) -> DataFrame:
    return S.blocks(S.line_kinds(md_lines(spark, d)))


@query(f"WITH {CATS} SELECT doc_id, line_start, heading, category, strategy FROM c", "v_md")
def block_categories(spark: SparkSession, d: str) -> DataFrame:
    return md_blocks(spark, d).select("doc_id", "line_start", "heading", "category", "strategy")


@query(
    f"""WITH {CATS}, p(part) AS (VALUES {', '.join(f"('{c}')" for c in X.CATEGORIES)})
    SELECT p.part, count(DISTINCT c.doc_id) AS n_docs FROM p LEFT JOIN c ON c.category = p.part GROUP BY p.part""",
    "v_md",
)
def part_doc_freq(spark: SparkSession, d: str) -> DataFrame:
    return S.part_document_frequency(md_blocks(spark, d))


@query(
    f"""WITH {CATS} SELECT doc_id, category, string_agg({strip("'### ' || heading || chr(10) || content")}, chr(10) || chr(10) ORDER BY line_start) AS content FROM c GROUP BY doc_id, category""",
    "v_md",
)
def section_text(spark: SparkSession, d: str) -> DataFrame:
    return S.section_text(md_blocks(spark, d))


@query(
    f"""WITH {CATS} SELECT doc_id, any_value(strategy) AS strategy, count(*) AS block_count, array_to_string(list_sort(list(DISTINCT category)), ',') AS sections_detected,
    coalesce(array_to_string(list_sort(list(DISTINCT category) FILTER (category IN {CORE_SQL})), ','), '') AS required_sections_found,
    count(DISTINCT category) FILTER (category IN {CORE_SQL}) = 5 AS required_sections_complete FROM c GROUP BY doc_id""",
    "v_md",
)
def section_summary(spark: SparkSession, d: str) -> DataFrame:
    out = S.section_summary(md_blocks(spark, d))
    return out.withColumn("sections_detected", F.array_join("sections_detected", ",")).withColumn("required_sections_found", F.array_join("required_sections_found", ","))


@query(
    f"""WITH {CATS}, m AS (SELECT * FROM c WHERE category = 'Methods')
    SELECT m.doc_id, m.line_start, m.heading, m.heading_level, max(p.line_start) AS parent_line FROM m LEFT JOIN m p ON p.doc_id = m.doc_id AND p.line_start < m.line_start AND p.heading_level < m.heading_level
    GROUP BY ALL""",
    "v_md",
)
def methods_parents(spark: SparkSession, d: str) -> DataFrame:
    return S.methods_parents(md_blocks(spark, d))


@query(
    rf"""WITH {KINDS} SELECT doc_id, arg_max(CASE WHEN kind = 'pages' THEN regexp_extract(s, '(?i)\*\*Total Pages:\*\*\s*(\d+)', 1)::INT END, CASE WHEN kind = 'pages' THEN i END) AS declared_total_pages,
    count(*) FILTER (kind = 'page_marker')::INT AS parsed_page_markers FROM k GROUP BY doc_id""",
    "v_md",
)
def page_meta(spark: SparkSession, d: str) -> DataFrame:
    return S.page_meta(S.line_kinds(md_lines(spark, d)))


@query(
    f"""WITH {KINDS}, t AS (SELECT *, (sum(table_start::INT) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS table_no FROM k WHERE kind IN ('html_start', 'html_body', 'pipe'))
    SELECT doc_id, table_no, (min(i) + 1)::INT AS line_start, string_agg(raw, chr(10) ORDER BY i) AS content FROM t GROUP BY doc_id, table_no""",
    "v_md",
)
def segment_tables(spark: SparkSession, d: str) -> DataFrame:
    return S.tables(S.line_kinds(md_lines(spark, d)))


STRUCTURE = BLOCKS + ", st AS (SELECT doc_id, heading, min(line_start) AS pos, arg_max(content, line_start) AS content FROM b WHERE content <> '' GROUP BY doc_id, heading)"


@query(f"WITH {STRUCTURE} SELECT doc_id, heading, pos, content FROM st", "v_md")
def document_structure(spark: SparkSession, d: str) -> DataFrame:
    return S.document_structure(S.blocks(S.line_kinds(md_lines(spark, d))))


@query(
    f"""WITH {STRUCTURE}, h AS (SELECT doc_id, max(contains(lower(heading), 'method')) AS has_methods, max(contains(lower(heading), 'result')) AS has_results FROM st GROUP BY doc_id)
    SELECT doc_id, has_methods, has_results, array_to_string(list_filter([CASE WHEN NOT has_methods THEN 'Methods' END, CASE WHEN NOT has_results THEN 'Results' END], lambda x: x IS NOT NULL), ',') AS missing_sections FROM h""",
    "v_md",
)
def validate_sections(spark: SparkSession, d: str) -> DataFrame:
    out = S.validate_sections(S.document_structure(S.blocks(S.line_kinds(md_lines(spark, d)))))
    return out.withColumn("missing_sections", F.array_join("missing_sections", ","))


LISTED = BLOCKS + f", hl AS (SELECT doc_id, line_start, heading, CASE WHEN line_start = min(line_start) FILTER (heading <> '') OVER (PARTITION BY doc_id) THEN 'Title' ELSE {sql_rules('lower(heading)', X.LIST_RULES)} END AS list_category FROM b)"


@query(f"WITH {LISTED} SELECT * FROM hl", "v_md")
def heading_list_categories(spark: SparkSession, d: str) -> DataFrame:
    return S.classify_heading_list(S.blocks(S.line_kinds(md_lines(spark, d))))


RANK = "list_position(['" + "', '".join(X.CATEGORIES) + "'], list_category)"
MAPPED = LISTED + f", mp AS (SELECT doc_id, heading, arg_min(list_category, {RANK}) AS category FROM hl WHERE heading <> '' GROUP BY doc_id, heading)"


def mapped(found: DataFrame) -> DataFrame:
    listed = S.classify_heading_list(found).groupBy("doc_id", F.col("list_category").alias("category")).agg(F.collect_list("heading").alias("headings"))
    return S.map_sections(found, listed)


@query(f"WITH {MAPPED} SELECT doc_id, heading, category FROM mp", "v_md")
def section_map(spark: SparkSession, d: str) -> DataFrame:
    return mapped(S.blocks(S.line_kinds(md_lines(spark, d))))


_part = lambda n: f"coalesce(string_agg(content || chr(10) || chr(10), '' ORDER BY pos) FILTER (part = '{n}'), '')"
_words = lambda x: rf"len(list_filter(string_split_regex({x}, '\s+'), lambda w: w <> ''))"
REORGANIZED = (
    STRUCTURE.replace(BLOCKS, MAPPED)
    + f""", pt AS (SELECT st.*, CASE WHEN category IN {CORE_SQL} THEN category ELSE 'Unassigned' END AS part FROM st LEFT JOIN mp USING (doc_id, heading)),
ro AS (SELECT doc_id, {', '.join(f'{_part(n)} AS p_{n}' for n in (*X.CORE, 'Unassigned'))}, string_agg(content, chr(10) || chr(10) ORDER BY pos) AS whole FROM pt GROUP BY doc_id),
rw AS (SELECT *, {_words('whole')} AS total_words, {' + '.join(_words(f'p_{n}') for n in X.CORE)} AS core_words, {_words('p_Unassigned')} AS free_words FROM ro)"""
)


def reorganized(spark: SparkSession, d: str) -> DataFrame:
    # blocks are made once and dealt by document once; all that follows stays in that dealing
    found = written(S.blocks(S.line_kinds(md_lines(spark, d))), "blocks").repartition(F.col("doc_id"))
    return S.reorganize(S.document_structure(found), mapped(found))


@query(
    f"""WITH {REORGANIZED} SELECT doc_id, p_Methods AS methods, p_Unassigned AS unassigned, {_words('p_Methods')}::INT AS method_words, length(p_Methods)::INT AS method_chars,
    total_words::INT AS total_words, length(whole)::INT AS total_chars, (total_words - core_words)::INT AS uncounted_words FROM rw""",
    "v_md",
)
def reorganize(spark: SparkSession, d: str) -> DataFrame:
    p, w, c = F.col("parts"), F.col("num_words"), F.col("num_chars")
    return reorganized(spark, d).select("doc_id", p["Methods"].alias("methods"), p["Unassigned"].alias("unassigned"), w["Methods"].alias("method_words"), c["Methods"].alias("method_chars"), "total_words", "total_chars", "uncounted_words")


@query(
    f"""WITH {REORGANIZED} SELECT doc_id, {strip('p_Methods')} <> '' AS has_methods, {strip('p_Results')} <> '' AS has_results, free_words::DOUBLE / nullif(total_words, 0) * 100 AS unassigned_percent,
    free_words::DOUBLE / nullif(total_words, 0) * 100 > 30 AS mostly_unassigned FROM rw""",
    "v_md",
)
def reorganize_warnings(spark: SparkSession, d: str) -> DataFrame:
    return S.validate_reorganization(reorganized(spark, d)).select("doc_id", "has_methods", "has_results", "unassigned_percent", "mostly_unassigned")


# ---- tables


def runs_sql(full: str, member: str) -> str:
    return rf"""ln AS (SELECT doc_id, unnest(string_split(md, chr(10))) AS raw, generate_subscripts(string_split(md, chr(10)), 1) - 1 AS i FROM v_md),
t0 AS (SELECT *, {strip('raw')} AS s FROM ln), t1 AS (SELECT *, {full} AS full_line, {member} AS member FROM t0),
t2 AS (SELECT *, member <> coalesce(lag(member) OVER (PARTITION BY doc_id ORDER BY i), false) AS change FROM t1),
t3 AS (SELECT *, sum(change::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM t2),
t4 AS (SELECT *, CASE WHEN member THEN min(CASE WHEN full_line THEN i END) OVER (PARTITION BY doc_id, run) END AS start FROM t3),
t5 AS (SELECT doc_id, start, max(i) AS stop, string_agg(raw, chr(10) ORDER BY i) AS table_text FROM t4 WHERE i >= start GROUP BY doc_id, start),
tb AS (SELECT t5.doc_id, (row_number() OVER (PARTITION BY t5.doc_id ORDER BY start) - 1)::INT AS table_index, (start + 1)::INT AS line_start, table_text,
  array_to_string((string_split(md, chr(10)))[greatest(start - 5, 0) + 1:start], chr(10)) AS before_context, array_to_string((string_split(md, chr(10)))[stop + 2:stop + 6], chr(10)) AS after_context FROM t5 JOIN v_md USING (doc_id))"""


LOOSE = runs_sql("s LIKE '|%' AND s LIKE '%|'", "s = '' OR s LIKE '|%'")
STRICT = runs_sql(r"regexp_matches(s, '^\|.*\|$')", r"s = '' OR regexp_matches(s, '^\|.*\|$')")


def md_tables_of(spark: SparkSession, d: str, strict: bool = False) -> DataFrame:
    return T.table_runs(md_lines(spark, d), strict=strict)


@query(f"WITH {LOOSE} SELECT doc_id, table_index, line_start, table_text, before_context, after_context, before_context || chr(10) || '[TABLE ' || (table_index + 1) || ']' || chr(10) || after_context AS full_context FROM tb", "v_md")
def md_tables(spark: SparkSession, d: str) -> DataFrame:
    return md_tables_of(spark, d)


@query(f"WITH {STRICT} SELECT doc_id, table_index, line_start, table_text, before_context, after_context FROM tb", "v_md")
def md_tables_strict(spark: SparkSession, d: str) -> DataFrame:
    return md_tables_of(spark, d, strict=True).drop("full_context")


@query(r"SELECT doc_id, unnest(regexp_extract_all(md || chr(10), '(?:\|.*\|\n)+\|?[\s-]+\|.*\n(?:\|.*\|\n)+')) AS table_text FROM v_mdtab", "v_mdtab")
def md_tables_pattern(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_mdtab").select("doc_id", F.explode(T.tables_by_pattern(F.concat("md", F.lit("\n")))).alias("table_text"))


CELLS = lambda x: f"list_filter(list_transform(string_split({x}, '|'), lambda c: {strip('c')}), lambda c: c <> '')"
TABLE_ROWS = f"""r0 AS (SELECT doc_id, list_filter(list_transform(string_split(md, chr(10)), lambda s: {strip('s')}), lambda s: s <> '') AS x FROM v_mdtab),
r1 AS (SELECT *, list_position(list_transform(x, lambda s: regexp_matches({strip("replace(s, '|', '')")}, '^[:' || chr(92) || '-' || chr(92) || 's]+$')), true) AS rule FROM r0),
r2 AS (SELECT doc_id, rule > 1 AS has_header, {CELLS('x[CASE WHEN rule > 1 THEN rule - 1 ELSE 1 END]')} AS header, x[coalesce(rule, 1) + 1:] AS body FROM r1),
r3 AS (SELECT *, list_filter(list_transform(list_filter(body, lambda s: contains(s, '|')), lambda s: {CELLS('s')}), lambda c: len(c) = len(header)) AS data FROM r2)"""


@query(f"WITH {TABLE_ROWS} SELECT doc_id, len(data) AS num_rows, len(header) AS num_columns, has_header, array_to_string(header, ',') AS header, array_to_string(data[1], ',') AS first_row FROM r3", "v_mdtab")
def table_structure(spark: SparkSession, d: str) -> DataFrame:
    out = view(spark, d, "v_mdtab").select("doc_id", T.structure(F.col("md")).alias("t"))
    return out.select(
        "doc_id", F.col("t.num_rows").cast("bigint").alias("num_rows"), F.col("t.num_columns").cast("bigint").alias("num_columns"), "t.has_header",
        F.array_join("t.header_row", ",").alias("header"), F.array_join(F.get("t.data_rows", F.lit(0)), ",").alias("first_row"),
    )


@query(
    f"""WITH {TABLE_ROWS}, e AS (SELECT doc_id, header, unnest(data) AS cells, generate_subscripts(data, 1) - 1 AS row_no FROM r3)
    SELECT doc_id, row_no::INT AS row_no, (j - 1)::INT AS col_no, header[j] AS "column", cells[j] AS value FROM (SELECT *, unnest(generate_series(1, len(cells))) AS j FROM e)""",
    "v_mdtab",
)
def table_cells_long(spark: SparkSession, d: str) -> DataFrame:
    return T.cells_long(view(spark, d, "v_mdtab").select("doc_id", T.structure(F.col("md")).alias("structure")), ["doc_id"])


@query(
    f"""WITH {LOOSE} SELECT doc_id, table_index, table_text FROM tb WHERE contains(lower(table_text), 'r | 4') OR contains(lower(table_text), 'doc 1')
    OR contains(lower(before_context || chr(10) || '[TABLE ' || (table_index + 1) || ']' || chr(10) || after_context), 'r | 4') OR contains(lower(before_context || chr(10) || '[TABLE ' || (table_index + 1) || ']' || chr(10) || after_context), 'doc 1')""",
    "v_md",
)
def filter_tables(spark: SparkSession, d: str) -> DataFrame:
    return T.filter_by_keywords(md_tables_of(spark, d), ["R | 4", "Doc 1"]).select("doc_id", "table_index", "table_text")


FILLED = f"list_filter(string_split(md, chr(10)), lambda s: {strip('s')} <> '')"


@query(
    f"""SELECT doc_id, array_to_string(CASE WHEN len(x) > 10 THEN x[1:5] || ['...'] || x[len(x) - 4:] ELSE x END, chr(10)) AS snippet, (len(x) + 9) // 10 AS n_chunks,
    array_to_string(x[((len(x) + 9) // 10 - 1) * 10 + 1:], chr(10)) AS last_chunk FROM (SELECT doc_id, {FILLED} AS x FROM v_mdtab)""",
    "v_mdtab",
)
def table_snippets(spark: SparkSession, d: str) -> DataFrame:
    out = view(spark, d, "v_mdtab").select("doc_id", T.snippet(F.col("md")).alias("snippet"), T.chunks(F.col("md")).alias("x"))
    return out.select("doc_id", "snippet", F.size("x").cast("bigint").alias("n_chunks"), F.element_at("x", -1).alias("last_chunk"))


@query(
    rf"""WITH h AS (SELECT doc_id, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS i FROM v_mdtab),
    g AS (SELECT *, list_transform(string_split(regexp_replace(regexp_replace({strip('line')}, '^\|', ''), '\|$', ''), '|'), lambda c: {strip('c')}) AS x FROM h),
    f AS (SELECT *, len(list_filter(x, lambda c: c <> '' AND NOT regexp_matches(c, '^:?-+:?$'))) = 0 AS rule, list_filter(x, lambda c: c <> '') AS y, CASE WHEN i = 1 THEN 'th' ELSE 'td' END AS tag FROM g WHERE {strip('line')} <> '')
    SELECT doc_id, '<table>' || chr(10) || coalesce(string_agg('  <tr>' || chr(10) || array_to_string(list_transform(y, lambda c: '    <' || tag || '>' || c || '</' || tag || '>' || chr(10)), '') || '  </tr>' || chr(10), '' ORDER BY i) FILTER (NOT rule), '') || '</table>' AS html
    FROM f GROUP BY doc_id""",
    "v_mdtab",
)
def table_html(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_mdtab").select("doc_id", T.to_html(F.col("md")).alias("html"))


@query(
    rf"""SELECT doc_id, coalesce(greatest(length(f) - length(replace(f, '|', '')) - 1, 0), 0)::INT AS n_columns, n::INT AS n_rows FROM (
    SELECT doc_id, (list_filter(string_split({strip('md')}, chr(10)), lambda s: {strip('s')} LIKE '|%'))[1] AS f, len(list_filter(string_split(md, chr(10)), lambda s: {strip('s')} LIKE '|%')) AS n FROM v_md)""",
    "v_md",
)
def pipe_sizes(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_md").select("doc_id", T.pipe_columns(F.col("md")).alias("n_columns"), T.pipe_rows(F.col("md")).alias("n_rows"))


LABEL = "CASE doc_id % 7 WHEN 0 THEN 'brain_activation' WHEN 1 THEN 'statistical' WHEN 2 THEN 'odd' WHEN 3 THEN 'demographic' ELSE 'other' END"


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_mdtab").withColumn("category", F.expr(LABEL)).withColumn("paper", F.floor(F.col("doc_id") / 3))


@query(
    f"""WITH l AS (SELECT {LABEL} AS c FROM v_mdtab), p(category) AS (VALUES ('brain_activation'), ('demographic'), ('statistical'), ('methodological'), ('other'))
    SELECT category, (SELECT count(*) FROM l WHERE CASE WHEN c IN ('brain_activation', 'demographic', 'statistical', 'methodological') THEN c ELSE 'other' END = p.category) AS n FROM p""",
    "v_mdtab",
)
def category_counts(spark: SparkSession, d: str) -> DataFrame:
    return T.category_counts(labelled(spark, d))


@query(
    f"""WITH l AS (SELECT doc_id, {LABEL} AS category, doc_id // 3 AS paper FROM v_mdtab)
    SELECT doc_id, category FROM l WHERE category = 'brain_activation' OR paper NOT IN (SELECT paper FROM l WHERE category = 'brain_activation')""",
    "v_mdtab",
)
def candidate_tables(spark: SparkSession, d: str) -> DataFrame:
    return T.candidate_tables(labelled(spark, d).drop("md"), key="paper").select("doc_id", "category")


# ---- ontology

EDGE_ROWS = ", ".join(f"('{c}', '{p}')" for c, p in O.EDGES)
CLOSED = f"""e(child, parent) AS (VALUES {EDGE_ROWS}),
up AS (SELECT child AS feature, child AS node FROM e UNION SELECT up.feature, e.parent FROM up JOIN e ON e.child = up.node),
nodes AS (SELECT DISTINCT child AS feature FROM e UNION SELECT parent FROM e),
raised AS (SELECT task_id, node AS feature, min(value) AS value FROM v_feat JOIN up USING (feature) WHERE value = 0 GROUP BY ALL),
cl AS (SELECT t.task_id, n.feature, least(coalesce(r.value, 1), coalesce(f.value, 1))::INT AS value FROM (SELECT DISTINCT task_id FROM v_feat) t CROSS JOIN nodes n
  LEFT JOIN raised r ON r.task_id = t.task_id AND r.feature = n.feature LEFT JOIN v_feat f ON f.task_id = t.task_id AND f.feature = n.feature)"""


@query(f"WITH {CLOSED} SELECT task_id, feature, value FROM cl --recursive", "v_feat")
def feature_closure(spark: SparkSession, d: str) -> DataFrame:
    return O.closure(view(spark, d, "v_feat"))


@query(f"WITH {CLOSED} SELECT task_id, count(*) AS total, count(*) FILTER (value = 0) AS present, count(*) FILTER (value = 1) AS absent FROM cl GROUP BY task_id --recursive", "v_feat")
def feature_closure_counts(spark: SparkSession, d: str) -> DataFrame:
    return O.closure_counts(O.closure(view(spark, d, "v_feat")))


@query(f"""WITH {CLOSED} SELECT task_id, max(value) FILTER (feature = 'language') AS language, max(value) FILTER (feature = 'prosody') AS prosody, max(value) FILTER (feature = 'processing') AS processing FROM cl GROUP BY task_id --recursive""", "v_feat")
def feature_flat(spark: SparkSession, d: str) -> DataFrame:
    return O.flat_features(O.closure(view(spark, d, "v_feat"))).select("task_id", "language", "prosody", "processing")


@query(
    """SELECT task_id, feature, (CASE WHEN feature = 'input_audio' THEN 1 - value WHEN feature = 'speech_rate_normalization' THEN 0 ELSE value END)::INT AS value FROM v_feat""",
    "v_feat",
)
def feature_merge(spark: SparkSession, d: str) -> DataFrame:
    own = view(spark, d, "v_feat")
    second = own.where("feature = 'speech_rate_normalization'").withColumn("value", F.lit(0))
    third = own.where("feature = 'input_audio'").withColumn("value", 1 - F.col("value"))
    return O.merge_features(own, second, third)


ANSWERS = """'0', '1', '2', '-3', '"0"', '"1"', '0.4', 'true', 'false', '"true"', '"Present"', '" yes "', '"no"', '"maybe"', 'null'"""


@query(
    f"""SELECT event_id, answer, CASE WHEN event_id % 15 IN (0, 4, 6, 8, 9, 10, 11) THEN 0 ELSE 1 END AS value
    FROM (SELECT event_id, ([{ANSWERS}])[event_id % 15 + 1] AS answer FROM events)"""
)
def normalize_flags(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", F.expr(f"element_at(array({ANSWERS}), CAST(event_id % 15 + 1 AS INT))").alias("answer"))
    return rows.select("event_id", "answer", O.normalize_flag("answer").alias("value"))


@query(
    r"""WITH t AS (SELECT p_partkey AS text_id, lower(p_name || ' ' || p_type) AS low FROM part), c AS (SELECT concept_id, lower(name) AS name, lower(definitions) AS defs FROM v_concept),
    s AS (SELECT text_id, concept_id, 2 * contains(low, name)::INT + len(list_filter(string_split_regex(name, '\s+'), lambda w: length(w) > 3 AND contains(low, w)))
      + 0.5 * len(list_intersect(list_distinct(string_split_regex(low, '\s+')), list_distinct(string_split_regex(defs, '\s+')))) AS score FROM t CROSS JOIN c)
    SELECT text_id, concept_id, least(score, 10.0)::DOUBLE AS relevance_score FROM s WHERE score > 0""",
    "v_concept",
)
def concept_scores(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "part").select(F.col("p_partkey").alias("text_id"), F.concat("p_name", F.lit(" "), "p_type").alias("text"))
    return O.concept_scores(texts, view(spark, d, "v_concept"))


WORDY = "CASE doc_id % 3 WHEN 0 THEN 'steel/brass_' || doc_id % 50 ELSE 'brand_economy/' || doc_id % 9 END"


@query(
    rf"""WITH f AS (SELECT doc_id AS task_id, {WORDY} AS feature, (doc_id % 2)::INT AS value FROM documents),
    w AS (SELECT feature, list_distinct(list_filter(string_split_regex(replace(replace(lower(feature), '/', ' '), '_', ' '), '\s+'), lambda x: x <> '')) AS words FROM f WHERE value = 0 GROUP BY feature),
    m AS (SELECT feature, concept_id, concept_no, len(list_intersect(words, string_split_regex(lower(name) || ' ' || lower(definitions), '\s+')))::DOUBLE / len(words) AS relevance FROM w CROSS JOIN v_concept),
    r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY relevance DESC, concept_no) AS n FROM m WHERE relevance > 0.3)
    SELECT task_id, feature, n::INT AS "rank", concept_id, relevance FROM f JOIN r USING (feature) WHERE value = 0 AND n <= 5""",
    "v_concept",
)
def feature_concepts(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "documents").select(F.col("doc_id").alias("task_id"), F.expr(WORDY.replace("'steel/brass_' ||", "'steel/brass_' ||")).alias("feature"), (F.col("doc_id") % 2).cast("int").alias("value"))
    return O.feature_concepts(f, view(spark, d, "v_concept"))


@query(
    """SELECT p_partkey AS concept_id, p_name AS name, CASE WHEN p_size % 3 = 0 THEN p_type ELSE p_type || chr(10) || '---' || chr(10) || p_brand END AS definitions, p_brand AS cognitive_category FROM part WHERE p_size % 2 = 0"""
)
def concept_definitions(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, "ctp_C6").otherwise("ctp_C1").alias("class_id"), F.col("p_brand").alias("class_name"),
        F.when(F.col("p_size") % 3 == 0, F.array("p_type", F.lit(" "), "p_type")).otherwise(F.array("p_type", "p_brand", "p_type")).alias("definitions"),
    )
    return O.concept_definitions(raw)


# ---- reports


@query(
    """SELECT count(*) AS total, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'error') AS error,
    avg(file_size) FILTER (file_size > 0) AS avg_file_size, round(avg(download_time) FILTER (download_time > 0), 6) AS avg_download_time, avg(retry_count) AS avg_retries, sum(file_size)::BIGINT AS total_file_size,
    count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*) AS success_rate FROM v_dl""",
    "v_dl",
)
def pdf_stats(spark: SparkSession, d: str) -> DataFrame:
    return R.download_stats(view(spark, d, "v_dl")).withColumn("avg_download_time", F.round("avg_download_time", 6))


@query("SELECT coalesce(nullif(downloader_used, ''), nullif(source, ''), 'unknown') AS source_used, count(*) AS n FROM v_dl GROUP BY 1", "v_dl")
def source_distribution(spark: SparkSession, d: str) -> DataFrame:
    return R.source_distribution(view(spark, d, "v_dl"))


def ocr_view(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(F.col("event_id") % 5 == 0, "good").when(F.col("event_id") % 5 == 1, "poor")
    return view(spark, d, "v_dl").select("status", (F.col("event_id") % 30).alias("pages_processed"), F.col("file_size").alias("text_length"), F.col("download_time").alias("processing_time"), level.alias("quality_level"))


@query(
    """SELECT count(*) AS total, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'error') AS error,
    sum(event_id % 30)::BIGINT AS total_pages, sum(file_size)::BIGINT AS total_text_length, round(avg(download_time) FILTER (download_time > 0), 6) AS avg_processing_time,
    count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*) AS success_rate, sum(event_id % 30)::DOUBLE / count(*) AS avg_pages_per_doc, sum(file_size)::DOUBLE / count(*) AS avg_text_per_doc FROM v_dl""",
    "v_dl",
)
def ocr_stats(spark: SparkSession, d: str) -> DataFrame:
    return R.ocr_stats(ocr_view(spark, d)).withColumn("avg_processing_time", F.round("avg_processing_time", 6))


@query("SELECT CASE event_id % 5 WHEN 0 THEN 'good' WHEN 1 THEN 'poor' END AS value, count(*) AS n FROM v_dl WHERE event_id % 5 < 2 GROUP BY 1", "v_dl")
def quality_distribution(spark: SparkSession, d: str) -> DataFrame:
    return R.distribution(ocr_view(spark, d), "quality_level")


@query("SELECT count(*) AS total, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status IN ('failed', 'error')) AS failed, count(*) FILTER (status = 'skipped') AS skipped FROM v_dl", "v_dl")
def batch_totals(spark: SparkSession, d: str) -> DataFrame:
    return R.batch_totals(view(spark, d, "v_dl"))


def papers(spark: SparkSession, d: str, legacy: bool = False) -> DataFrame:
    ocr = F.when(F.col("retry_count") == 0, "success").when(F.col("retry_count") == 1, "skipped").otherwise("error")
    return R.paper_stage(view(spark, d, "v_dl").withColumnRenamed("status", "download_status").withColumn("ocr_status", ocr), legacy)


@query(
    """WITH p AS (SELECT CASE WHEN status NOT IN ('success', 'skipped') THEN 'failed' WHEN retry_count < 2 THEN 'completed' ELSE 'failed' END AS stage, CASE WHEN status IN ('success', 'skipped') AND retry_count = 0 THEN 1 ELSE 0 END AS old FROM v_dl)
    SELECT count(*) AS total, count(*) FILTER (stage = 'completed') AS completed, count(*) FILTER (stage = 'failed') AS failed, 0::BIGINT AS skipped, count(*) FILTER (stage = 'completed') * 100.0::DOUBLE / count(*) AS success_rate, sum(old)::BIGINT AS legacy_completed FROM p""",
    "v_dl",
)
def pipeline_totals(spark: SparkSession, d: str) -> DataFrame:
    old = papers(spark, d, legacy=True).agg(F.count_if(F.col("stage") == "completed")).scalar()
    return R.pipeline_totals(papers(spark, d)).withColumn("legacy_completed", old)


@query(
    """SELECT pmid, status, CASE WHEN event_id % 2 = 0 THEN 'https://a.org/' || pmid ELSE '' END AS url_1, '' AS url_2, '' AS url_3, replace(coalesce(error_message, ''), ',', '，') AS error, event_id
    FROM v_dl WHERE status NOT IN ('success', 'skipped')""",
    "v_dl",
)
def manual_checklist(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_dl").withColumn("suggestions", F.when(F.col("event_id") % 2 == 0, F.array(F.concat(F.lit("https://a.org/"), "pmid"))))
    # the event keeps rows of one paper apart
    out = R.manual_checklist(rows.withColumn("pmid", F.concat("pmid", F.lit("#"), F.col("event_id").cast("string"))))
    parts = F.split("pmid", "#")
    return out.select(F.get(parts, F.lit(0)).alias("pmid"), "status", "url_1", "url_2", "url_3", "error", F.get(parts, F.lit(1)).cast("bigint").alias("event_id"))


@query("SELECT pmid AS \"PMID\", arg_min(error_message, event_id) AS \"Error\" FROM v_dl WHERE status IN ('failed', 'error') AND error_message IS NOT NULL GROUP BY pmid", "v_dl")
def failed_downloads(spark: SparkSession, d: str) -> DataFrame:
    return R.failed_downloads(view(spark, d, "v_dl"))


@query("SELECT event_id, status FROM v_dl WHERE status IN ('failed', 'error')", "v_dl")
def status_filter(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_dl").where(F.col("status").isin("failed", "error")).select("event_id", "status")


@query(
    """WITH p AS (SELECT conv_id, turn, text, turn % 3 <> 1 AS ok FROM conversations)
    SELECT conv_id::VARCHAR AS pdf, '# ' || conv_id || chr(10) || chr(10) || '**Total Pages:** ' || count(*) || chr(10)
    || CASE WHEN bool_and(ok) THEN '**Status:** All pages converted successfully' ELSE '**Failed Pages:** ' || string_agg(turn::VARCHAR, ', ' ORDER BY turn) FILTER (NOT ok) END || chr(10) || chr(10) || repeat('=', 80) || chr(10) || chr(10)
    || string_agg(chr(10) || chr(10) || CASE WHEN ok THEN chr(10) || '## Page ' || turn || chr(10) || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g')
       ELSE chr(10) || '## ⚠️ Page ' || turn || ' - OCR FAILED' || chr(10) || chr(10) || '```' || chr(10) || 'ERROR: Unknown error' || chr(10) || 'This page could not be converted to markdown.' || chr(10) || 'Please check the original PDF for page ' || turn || '.' || chr(10) || '```' END
       || chr(10) || chr(10) || repeat('-', 80) || chr(10), chr(10) ORDER BY turn) AS markdown FROM p GROUP BY conv_id"""
)
def assemble_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("pdf"), F.col("turn").alias("page_num"), (F.col("turn") % 3 != 1).alias("success"), F.col("text").alias("markdown"), F.lit(None).cast("string").alias("error")
    )
    return R.assemble_pages(pages).select("pdf", "markdown")


# ---- screening


def screened(spark: SparkSession, d: str) -> DataFrame:
    """Records with abstracts, whole texts, that a judge, written as an expression, decides on."""
    docs = table(spark, d, "documents")
    r = F.col("doc_id") % 6
    abstract = F.when(r == 0, "").when(r < 3, F.concat(F.lit("An fMRI study of language: "), F.col("text"))).otherwise(F.col("text"))
    rows = C.with_abstract(docs.select(F.col("doc_id").cast("string").alias("pmid"), abstract.alias("abstract"), "doc_id"), docs.where("doc_id % 12 = 0").select(F.col("doc_id").cast("string").alias("pmid"), F.lit("Language and fMRI.").alias("abstract")))
    low = F.lower("abstract")
    hit = low.contains("fmri") & low.contains("language")
    reply = F.to_json(F.struct(hit.alias("include"), F.when(hit, 0.92).otherwise(0.25).alias("confidence"), F.when(hit, "method+topic fit").otherwise("not in scope").alias("reason")))
    judged = C.decisions(rows.where("abstract IS NOT NULL").withColumn("answer", reply))
    return rows.join(judged, "pmid", "left")


_ABSTRACT = """a AS (SELECT doc_id, CASE WHEN doc_id % 12 = 0 THEN 'Language and fMRI.' WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 6 < 3 THEN 'An fMRI study of language: ' || text ELSE text END AS abstract FROM documents),
j AS (SELECT *, contains(lower(abstract), 'fmri') AND contains(lower(abstract), 'language') AS hit FROM a)"""


@query(
    f"""WITH {_ABSTRACT} SELECT doc_id::VARCHAR AS pmid, coalesce(hit, false) AS include, CASE WHEN hit THEN 0.92 WHEN abstract IS NULL THEN 0.0 ELSE 0.25 END::DOUBLE AS confidence,
    CASE WHEN hit THEN 'method+topic fit' WHEN abstract IS NULL THEN 'abstract_unavailable' ELSE 'not in scope' END AS reason FROM j"""
)
def screen_decisions(spark: SparkSession, d: str) -> DataFrame:
    rows = screened(spark, d)
    return rows.select("pmid", F.coalesce("include", F.lit(False)).alias("include"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("reason", F.lit("abstract_unavailable")).alias("reason"))


@query(
    f"""WITH {_ABSTRACT} SELECT count(*) AS total, count(abstract) AS abstract_available, count(*) FILTER (hit) AS included, count(*) FILTER (abstract IS NOT NULL AND NOT hit) AS excluded,
    count(*) FILTER (hit AND doc_id % 5 > 0) AS downloaded, count(*) FILTER (hit AND doc_id % 5 > 1) AS ocr_success FROM j"""
)
def screen_funnel(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id") % 5
    return C.funnel(screened(spark, d).withColumn("download_status", F.when(n > 0, "success").otherwise("failed")).withColumn("ocr_status", F.when(n > 1, "Success")))


@query(f"WITH {_ABSTRACT} SELECT count(*) AS total, count(*) FILTER (hit) AS included, count(*) FILTER (NOT coalesce(hit, false)) AS excluded, count(*) FILTER (doc_id % 5 > 0 AND doc_id % 2 = 0) AS downloaded FROM j")
def screen_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = screened(spark, d).withColumn("include", F.coalesce("include", F.lit(False)))
    return C.summary(rows.withColumn("download_status", F.when(F.col("doc_id") % 5 > 0, "success").otherwise("failed")).withColumn("pdf_path", F.when(F.col("doc_id") % 2 == 0, "a.pdf").otherwise("")))


@query(
    f"""WITH {_ABSTRACT} SELECT doc_id::VARCHAR AS pmid, abstract, hit AS include, 'Qwen3-3B' AS target_model, '{C.INSTRUCTION}' AS instruction FROM j WHERE abstract IS NOT NULL"""
)
def training_records(spark: SparkSession, d: str) -> DataFrame:
    out = C.training_records(screened(spark, d).where("abstract IS NOT NULL"), F.lit("{}"))
    return out.select("metadata.pmid", "input.abstract", "output.include", "metadata.target_model", "instruction")


@query("SELECT row_no, raw_pmid FROM v_pmid WHERE raw_pmid NOT IN (SELECT raw_pmid FROM v_pmid WHERE row_no % 10 = 0)", "v_pmid")
def resume_antijoin(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_pmid").select("row_no", "raw_pmid")
    return C.unprocessed(rows, rows.where("row_no % 10 = 0"), "raw_pmid")


# ---- links

_MAIN = "array_to_string((string_split(landing, '/'))[1:3], '/')"
_LINKS = f"""SELECT page_id, CASE WHEN page_id % 8 = 0 THEN 'https://x.org/' || page_id || '.pdf' END AS generic_citation,
  CASE page_id % 8 WHEN 1 THEN 'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || page_id || '/' WHEN 2 THEN {_MAIN} || '/dl/' || page_id || '/full.pdf' END AS pubmed_central,
  CASE WHEN page_id % 8 = 3 THEN {_MAIN} || '/hr/' || page_id END AS acs, CASE WHEN page_id % 8 = 4 THEN {_MAIN} || '/nejm/' || page_id END AS nejm,
  CASE WHEN page_id % 8 = 5 THEN {_MAIN} || '/doi/pdf/' || page_id WHEN page_id % 8 = 6 THEN {_MAIN} || 'https://j.edu/doi/pdf' || page_id END AS future_medicine, CASE WHEN page_id % 8 = 6 THEN {_MAIN} || 'https://j.edu/doi/pdf' || page_id END AS uchicago_press,
  CASE WHEN lower(landing) LIKE '%.pdf' THEN landing END AS direct_pdf FROM v_link"""


@query(_LINKS, "v_link")
def finder_links(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_link")
    return rows.select("page_id", *[f(F.col("landing"), F.col("page")).alias(n) for n, f in H.FINDERS.items()])


@query(f"WITH l AS ({_LINKS}) SELECT page_id, CASE WHEN generic_citation IS NOT NULL THEN 'generic_citation' WHEN pubmed_central IS NOT NULL THEN 'pubmed_central' WHEN acs IS NOT NULL THEN 'acs' WHEN nejm IS NOT NULL THEN 'nejm' END AS finder, coalesce(generic_citation, pubmed_central, acs, nejm) AS pdf_url FROM l", "v_link")
def finder_first(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_link").select("page_id", H.find_pdf(F.col("landing"), F.col("page")).alias("x")).select("page_id", "x.finder", "x.pdf_url")


# ---- through adapters, with deterministic doubles of the models


@query(
    """SELECT doc_id::VARCHAR AS pmid, doc_id % 5 = 1 AS include, CASE WHEN doc_id % 5 = 1 THEN 0.92 WHEN doc_id % 5 = 0 THEN 0.0 ELSE 0.25 END::DOUBLE AS confidence,
    CASE WHEN doc_id % 5 = 1 THEN 'method+topic fit' WHEN doc_id % 5 = 0 THEN 'abstract_unavailable' ELSE 'not in scope' END AS reason FROM documents WHERE doc_id % 7 > 0"""
)
def screen_with_model(spark: SparkSession, d: str) -> DataFrame:
    abstract = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 5 == 1, "fMRI of language").otherwise(F.col("text"))
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("pmid"), F.col("source").alias("title"), abstract.alias("abstract"), "doc_id")
    return P.screen(rows.drop("doc_id"), keyword_judge, done=rows.where("doc_id % 7 = 0")).select("pmid", "include", "confidence", "reason")


def label_double():
    return lambda r: json.dumps({"category": "brain_activation" if " | 7 |" in r["snippet"] else "Statistical", "need_full_scan": True})


@query("SELECT doc_id, CASE WHEN contains(md, ' | 7 |') THEN 'brain_activation' ELSE 'statistical' END AS category FROM v_mdtab", "v_mdtab")
def table_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_mdtab").select("doc_id", F.col("md").alias("table_text"), F.lit("").alias("full_context"))
    return M.categorize(rows, label_double, ("doc_id",)).select("doc_id", "category")


@query(
    """SELECT o_orderkey, 2 AS n_columns, (o_orderkey % 3 + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END)::INT AS n_rows, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END AS ragged,
    CASE WHEN o_orderkey % 3 > 0 THEN 'a, ' || o_orderstatus WHEN o_orderkey % 2 = 0 THEN 'b' END AS first_region FROM orders"""
)
def csv_answers(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    body = F.repeat(F.concat(F.lit('"a, '), "o_orderstatus", F.lit('",1\n')), (key % 3).cast("int"))
    answer = F.concat(F.lit("Here:\n```csv\nRegion,X\n"), body, F.when(key % 2 == 0, "b,2\n").otherwise("b,2,3\n"), F.lit("```\nthe end"))
    out = table(spark, d, "orders").select("o_orderkey", M.csv_rows(answer).alias("p"))
    return out.select("o_orderkey", F.size("p.columns").alias("n_columns"), F.size("p.rows").alias("n_rows"), "p.ragged", F.try_element_at(F.get("p.rows", F.lit(0)), F.lit("Region")).alias("first_region"))


def path_double():
    return lambda r: f"/pdf/{r['pmid']}.pdf" if int(r["pmid"]) % 3 else None


@query(
    f"""WITH p AS (SELECT DISTINCT {PMID} AS pmid FROM v_pmid WHERE ({REASON}) IS NULL)
    SELECT pmid, CASE WHEN pmid::BIGINT % 3 > 0 THEN 'success' ELSE 'failed' END AS download_status, CASE WHEN pmid::BIGINT % 3 > 0 THEN 'completed' ELSE 'failed' END AS stage FROM p""",
    "v_pmid",
)
def paper_stages(spark: SparkSession, d: str) -> DataFrame:
    return P.papers(view(spark, d, "v_pmid").select("row_no", "raw_pmid"), path_double, echo_ocr)[0].select("pmid", "download_status", "stage")


@query(
    f"""WITH {CATS}, t AS (SELECT doc_id, sum(table_start::INT)::BIGINT AS table_count, count(*) FILTER (kind = 'page_marker')::INT AS pages FROM k GROUP BY doc_id)
    SELECT t.doc_id, table_count, pages, count(c.category) AS block_count, any_value(strategy) AS strategy FROM t LEFT JOIN c USING (doc_id) GROUP BY t.doc_id, table_count, pages""",
    "v_md",
)
def library_index(spark: SparkSession, d: str) -> DataFrame:
    index = P.library(view(spark, d, "v_md").select("doc_id", "md"))[1]
    return index.select("doc_id", "table_count", F.col("parsed_page_markers").alias("pages"), "block_count", "strategy")


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'https://e/' || event_id || '.pdf' END AS pdf, CASE WHEN event_id % 4 > 1 THEN 'PMC' || event_id END AS pmcid FROM events"""
)
def service_answers(spark: SparkSession, d: str) -> DataFrame:
    e, i = F.col("event_id"), F.col("event_id").cast("string")
    link = F.concat(F.lit('{"documentStyle": "html", "url": "https://e/x"}'), F.when(e % 3 == 0, F.concat(F.lit(', {"documentStyle": "PDF", "url": "https://e/'), i, F.lit('.pdf"}'))).otherwise(""))
    full = F.concat(F.lit('{"resultList": {"result": [{}, {"fullTextUrlList": {"fullTextUrl": ['), link, F.lit("]}}]}}"))
    conv = F.when(e % 4 == 0, '{"records": []}').when(e % 4 == 1, "broken").otherwise(F.concat(F.lit('{"records": [{"pmcid": "PMC'), i, F.lit('"}]}')))
    return table(spark, d, "events").select("event_id", I.europe_pmc_pdf(full).alias("pdf"), I.idconv_pmcid(conv).alias("pmcid"))


@query(
    rf"""SELECT doc_id, strlen(md)::INT AS file_size, length(md)::INT AS text_length, len(string_split(md, chr(10)))::INT AS line_count, len({FILLED})::INT AS non_empty_lines, 'en' AS language,
    contains(md, '|') AND contains(md, '---') AS has_tables, contains(md, '#') AS has_headings, least(30.0, length(md) / 1000.0::DOUBLE * 3) + len({FILLED})::DOUBLE / len(string_split(md, chr(10))) * 30 AS quality_score,
    CASE WHEN quality_score >= 50 THEN 'fair' ELSE 'poor' END AS quality_level FROM v_md""",
    "v_md",
)
def markdown_stats(spark: SparkSession, d: str) -> DataFrame:
    return R.markdown_stats(view(spark, d, "v_md"))


@query(
    """SELECT count(*) AS sample_size, count(*) FILTER (status = 'success') AS success_count, count(*) FILTER (status <> 'success') AS failed_count,
    round(avg(event_id % 100) FILTER (status = 'success'), 1) AS avg_quality_score_success, round(avg(file_size) FILTER (status = 'success'), 1) AS avg_text_length_success FROM v_dl""",
    "v_dl",
)
def success_means(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_dl").select("status", (F.col("event_id") % 100).alias("quality_score"), F.col("file_size").alias("text_length"))
    out = R.success_means(rows)
    return out.withColumns({c: F.round(c, 1) for c in ("avg_quality_score_success", "avg_text_length_success")})


@query("SELECT count(*) AS documents, sum(n)::BIGINT AS total_tables FROM (SELECT doc_id, count(*) AS n FROM (WITH " + LOOSE + " SELECT doc_id FROM tb) GROUP BY doc_id)", "v_md")
def table_summary(spark: SparkSession, d: str) -> DataFrame:
    return R.table_summary(md_tables_of(spark, d))[1]


@query(f"SELECT {PMID} AS pmid FROM v_pmid WHERE ({REASON}) IS NULL", "v_pmid")
def valid_pmids(spark: SparkSession, d: str) -> DataFrame:
    return I.valid_pmids(view(spark, d, "v_pmid"), "raw_pmid")


@query("SELECT doc_id, source FROM documents ORDER BY md5('7:' || doc_id::VARCHAR), doc_id LIMIT 50")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return I.seeded_sample(table(spark, d, "documents").select("doc_id", "source"), "doc_id", 50, seed=7)


from . import boundary_queries  # noqa: E402,F401  registers its queries too
