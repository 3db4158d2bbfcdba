"""Inputs of the registered queries, derived in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "v_md": r"""
SELECT doc_id, lang, source,
 (CASE WHEN doc_id % 6 = 5 THEN '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |' || chr(10) ELSE '' END)
 || '# Doc ' || CAST(doc_id AS STRING) || chr(10) || chr(10)
 || '**Total Pages:** ' || CAST(CAST(floor(n_chars / 3000.0) AS INT) + 1 AS STRING) || chr(10)
 || repeat('=', 80) || chr(10) || '## Page 1' || chr(10)
 || '## Abstract' || chr(10) || substring(text, 1, 200) || chr(10)
 || '## 1. Introduction' || chr(10) || substring(text, 201, 300) || chr(10)
 || (CASE WHEN doc_id % 6 = 3 THEN '## Section A' || chr(10) || 'We describe methods and participants.' || chr(10)
     ELSE '## Methods' || chr(10) || '### Subjects' || chr(10) || CAST(doc_id % 40 AS STRING) || ' participants.' || chr(10)
       || '#### Statistical model' || chr(10) || 'ANOVA.' || chr(10) || '### Statistical Analysis' || chr(10) || 't test.' || chr(10) END)
 || (CASE WHEN doc_id % 6 = 1 THEN '<table><tr><td>x</td>' || chr(10) || '# not a heading' || chr(10) || '</tr></table>' || chr(10) ELSE '' END)
 || (CASE WHEN doc_id % 6 = 2 THEN '| r | x | y | z |' || chr(10) || '|---|---|---|---|' || chr(10) || '| L |  | 2 | 3 |' || chr(10) || chr(10) || '| R | 4 | 5 | 6 |' || chr(10)
       || '## Page 2' || chr(10) || '## FAILED Page 3 - OCR FAILED' || chr(10) ELSE '' END)
 || '## Results' || chr(10) || substring(text, 501, 300) || chr(10) || '## Discussion' || chr(10) || substring(text, 801) || chr(10)
 || '## References' || chr(10) || '[1] Ref' || chr(10)
 || (CASE WHEN doc_id % 6 = 4 THEN '<table><tr><td>open' || chr(10) || '## Funding' || chr(10) ELSE '' END) AS md
FROM documents""",
    "v_pmid": r"""
SELECT o_orderkey AS row_no,
 CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'PMC' || CAST(o_orderkey AS STRING)
      WHEN o_orderkey % 17 = 0 THEN '12' WHEN o_orderkey % 19 = 0 THEN ' ' || CAST(30000000 + o_custkey AS STRING) || ' '
      ELSE CAST(30000000 + o_custkey AS STRING) END AS raw_pmid,
 CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS STRING) WHEN o_orderkey % 7 = 0 THEN '  ' ELSE 'T ' || o_orderpriority END AS title_a,
 o_orderstatus AS title_b FROM orders""",
    "v_dl": r"""
SELECT event_id, CAST(30000000 + user_id AS STRING) AS pmid,
 CASE event_type WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'skipped' WHEN 'error' THEN 'error' ELSE 'failed' END AS status,
 CASE WHEN event_type IN ('purchase','view') THEN CAST(floor(value * 100000) AS BIGINT) ELSE 0 END AS file_size,
 CASE WHEN event_type = 'purchase' THEN CASE WHEN user_id % 3 = 0 THEN 'generic_citation' WHEN user_id % 3 = 1 THEN 'europe_pmc_fulltext' ELSE '' END END AS downloader_used,
 CASE WHEN event_id % 4 = 0 THEN 'pubmed_prlinks' END AS source,
 CAST(event_id % 4 AS INT) AS retry_count, value AS download_time,
 CASE WHEN event_type IN ('error', 'click') AND event_id % 3 > 0 THEN 'no link, try ' || CAST(event_id % 5 AS STRING) END AS error_message FROM events""",
    "v_feat": r"""
SELECT d.doc_id AS task_id, f.feature, CASE WHEN (d.doc_id * 31 + f.idx * 17) % 7 = 0 THEN 0 ELSE 1 END AS value
FROM documents d CROSS JOIN (VALUES (0,'rhythm_class_judgement'),(1,'speech_rate_normalization'),(2,'syntactic_parsing'),(3,'lexical_semantics'),(4,'input_audio'),(5,'working_memory/maintenance')) AS f(idx, feature)""",
    "v_concept": r"""
SELECT CAST(min(p_partkey) AS STRING) AS concept_id, min(p_partkey) AS concept_no, min(p_name) AS name, lower(min(p_type)) || ' ' || lower(p_brand) || ' ' || max(p_name) || ' ' || lower(max(p_type)) AS definitions,
 p_brand AS cognitive_category FROM part GROUP BY p_brand""",
    "v_link": r"""
SELECT page_id, url, CASE WHEN page_id % 9 = 8 THEN url || '/paper.PDF' ELSE url END AS landing, html
 || CASE page_id % 8
  WHEN 0 THEN '<meta name="citation_pdf_url" content="https://x.org/' || CAST(page_id AS STRING) || '.pdf">'
  WHEN 1 THEN '<a href="/pmc/articles/PMC' || CAST(page_id AS STRING) || '/">article</a>'
  WHEN 2 THEN '<a href="/dl/' || CAST(page_id AS STRING) || '/full.pdf">Full PDF</a>'
  WHEN 3 THEN '<a title="High-Res PDF" href="/hr/' || CAST(page_id AS STRING) || '">get</a>'
  WHEN 4 THEN '<a data-download-type="article pdf" href="/nejm/' || CAST(page_id AS STRING) || '">get</a>'
  WHEN 5 THEN '<a href="/doi/pdf/' || CAST(page_id AS STRING) || '">get</a>'
  WHEN 6 THEN '<a href="https://j.edu/doi/pdf' || CAST(page_id AS STRING) || '">get</a>'
  ELSE '<a href="/epdf/' || CAST(page_id AS STRING) || '">PDF</a>' END AS page FROM pages""",
}

CELL = "'| ' || CAST(l_linenumber AS STRING) || ' | ' || CAST(l_partkey AS STRING) || ' | ' || CASE WHEN l_partkey % 9 = 0 THEN '' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END || ' |'"
_HEAD = "'| line | part | qty |' || chr(10) || '|---|---|---|' || chr(10) || "
MDTAB_SPARK = f"SELECT l_orderkey AS doc_id, {_HEAD} array_join(transform(array_sort(collect_list(struct(l_linenumber, l_partkey, l_suppkey, l_quantity, {CELL} AS c))), x -> x.c), chr(10)) AS md FROM lineitem GROUP BY l_orderkey"
MDTAB_DUCK = f"SELECT l_orderkey AS doc_id, {_HEAD} string_agg({CELL}, chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS md FROM lineitem GROUP BY l_orderkey"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame; no temporary view stays behind."""
    sql = MDTAB_SPARK if name == "v_mdtab" else VIEWS[name]
    used = [t for t in TABLES if f"FROM {t}" in sql]
    for t in used:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def duck(name: str) -> str:
    return MDTAB_DUCK if name == "v_mdtab" else VIEWS[name]
