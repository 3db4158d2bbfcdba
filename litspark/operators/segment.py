"""Segmentation of OCR'd Markdown papers: lines, blocks, categories, sections, hierarchy.

All windows share one partitioning by document, so a corpus is shuffled once for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CATEGORIES, CORE, count_tokens, list_rule_category, rule_category, strip, unassigned_percent

CORE_ARRAY = lambda: F.array(*[F.lit(c) for c in CORE])


def lines(docs: DataFrame, key: str = "doc_id", text: str = "md") -> DataFrame:
    """A row (key, i, raw, s) per line, i from 0, s stripped; a null text has none. The rows come dealt by
    document, as the windows over them need it: so only ``raw`` moves, and ``s`` is made behind the shuffle."""
    split = F.split(F.regexp_replace(F.col(text), r"\r\n?", "\n"), "\n", -1)
    rows = docs.select(key, F.posexplode_outer(split).alias("i", "raw")).where("raw IS NOT NULL").repartition(F.col(key))
    return rows.withColumn("s", strip("raw"))


def line_kinds(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds ``kind``, ``table_start`` and ``heads`` (headings up to the line) to :func:`lines`.

    A table of HTML runs to the first line with its end mark, or to the end of the document: whether
    one is open is what the last line with either mark said, which makes the state a window.
    """
    order = Window.partitionBy(key).orderBy("i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = F.col("s")
    skip = (s == "") | s.rlike("^={10,}$|^-{10,}$")
    pages = s.rlike(r"(?i)\*\*Total Pages:\*\*\s*\d+")
    opens = s.rlike(r"(?i)^<table\b[^>]*>") & ~pages
    mark = F.when(F.col("raw").rlike("(?i)</table>"), 0).when(opens, 1)
    kind = (
        F.when(F.coalesce(F.last(F.col("mark"), ignorenulls=True).over(before), F.lit(0)) == 1, "html_body").when(skip, "skip").when(pages, "pages")
        .when(s.rlike(r"(?i)^##\s+Page\s+\d+"), "page_marker").when(opens, "html_start").when(s.startswith("|"), "pipe").when(s.rlike(r"^#{1,6}\s+"), "heading").otherwise("text")
    )
    out = rows.withColumn("mark", mark).withColumn("kind", kind)
    start = (F.col("kind") == "html_start") | ((F.col("kind") == "pipe") & (F.coalesce(F.lag("kind").over(order), F.lit("")) != "pipe"))
    return out.withColumn("table_start", start).withColumn("heads", F.sum((F.col("kind") == "heading").cast("int")).over(order)).drop("mark")


def tables(kinds: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, table_no, line_start, content) of every table, numbered from 1."""
    order = Window.partitionBy(key).orderBy("i")
    rows = kinds.where(F.col("kind").isin("html_start", "html_body", "pipe")).withColumn("table_no", F.sum(F.col("table_start").cast("int")).over(order))
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "raw"))), lambda x: x["raw"]), "\n")
    return rows.groupBy(key, "table_no").agg((F.min("i") + 1).alias("line_start"), content.alias("content"))


def page_meta(kinds: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, declared_total_pages, parsed_page_markers); the last declaration holds."""
    n = F.regexp_extract("s", r"(?i)\*\*Total Pages:\*\*\s*(\d+)", 1).cast("int")
    return kinds.groupBy(key).agg(
        F.max_by(F.when(F.col("kind") == "pages", n), F.when(F.col("kind") == "pages", F.col("i"))).alias("declared_total_pages"),
        F.count_if(F.col("kind") == "page_marker").cast("int").alias("parsed_page_markers"),
    )


def blocks(kinds: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, line_start, heading, heading_level, content): headings with the lines below them.

    Lines before the first heading are the block Document_Root, level 0, from line 1; a table before
    any block leaves no mark.
    """
    order = Window.partitionBy(key).orderBy("i")
    text = F.col("kind") == "text"
    rows = kinds.withColumn("table_no", F.sum(F.col("table_start").cast("int")).over(order)).withColumn("rooted", F.max((text & (F.col("heads") == 0)).cast("int")).over(order))
    is_open = (F.col("heads") > 0) | (F.col("rooted") == 1)
    line = F.when(text, F.col("raw")).when(F.col("table_start") & is_open, F.concat(F.lit("[TABLE: table_"), F.col("table_no").cast("string"), F.lit("]")))
    head = F.col("kind") == "heading"
    rows = rows.withColumn("line", line).where(head | F.col("line").isNotNull())
    body = F.filter(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"].isNotNull())
    out = rows.groupBy(key, "heads").agg(
        F.max(F.when(head, F.col("i") + 1)).alias("at"), F.max(F.when(head, F.col("s"))).alias("h"), strip(F.array_join(F.transform(body, lambda x: x["line"]), "\n")).alias("content")
    )
    return out.select(
        key,
        F.coalesce("at", F.lit(1)).alias("line_start"),
        F.coalesce(strip(F.regexp_extract("h", r"^#{1,6}\s+(.*)", 1)), F.lit("Document_Root")).alias("heading"),
        F.coalesce(F.length(F.regexp_extract("h", r"^(#{1,6})\s", 1)), F.lit(0)).alias("heading_level"),
        "content",
    )


def classify(found: DataFrame, key: str = "doc_id", mapping: DataFrame | None = None) -> DataFrame:
    """Adds ``category`` and ``strategy`` to blocks.

    Headings are classed by rule. Of documents that miss a core part, ``mapping`` (key, heading,
    category) is laid over, if given; where parts are still missing, blocks without a category are
    classed by heading and the first 400 characters of their content.
    """
    whole = Window.partitionBy(key)
    first = F.row_number().over(whole.orderBy("line_start")) == 1
    rule = rule_category("heading")
    rule = F.when((rule == "Other") & (first | (F.col("heading") == "Document_Root")), "Title").otherwise(rule)
    missing = lambda c: F.size(F.array_except(CORE_ARRAY(), F.collect_set(c).over(whole))) > 0
    out = found.withColumn("rule", rule).withColumn("short", missing("rule"))
    out = out.withColumn("strategy", F.lit("rule_based"))
    if mapping is not None:
        out = out.join(mapping.select(key, "heading", F.col("category").alias("mapped")), [key, "heading"], "left")
        out = out.withColumn("rule", F.when(F.col("short"), F.coalesce("mapped", "rule")).otherwise(F.col("rule")))
        out = out.withColumn("strategy", F.when(F.col("short"), "llm_assisted").otherwise(F.col("strategy"))).withColumn("short", missing("rule")).drop("mapped")
    wide = rule_category(F.concat(F.col("heading"), F.lit(" "), F.left("content", F.lit(400))))
    return out.withColumn("category", F.when(F.col("short") & (F.col("rule") == "Other"), wide).otherwise(F.col("rule"))).withColumn(
        "strategy", F.when(F.col("short"), "keyword_fallback").otherwise(F.col("strategy"))
    ).drop("rule", "short")


def segment(docs: DataFrame, key: str = "doc_id", text: str = "md", mapping: DataFrame | None = None) -> DataFrame:
    """Blocks of every document with their categories."""
    return classify(blocks(line_kinds(lines(docs, key, text), key), key), key, mapping)


def section_text(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, category, content): a category's blocks in order, each under its heading."""
    one = strip(F.concat(F.lit("### "), F.col("heading"), F.lit("\n"), F.col("content")))
    rows = found.where((F.col("content") != "") | (F.col("heading") != ""))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_start", one.alias("x")))), lambda x: x["x"])
    return rows.groupBy(key, "category").agg(F.array_join(parts, "\n\n").alias("content"))


def section_summary(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Which parts a document has, of the core ones too, and whether these are complete."""
    seen = F.array_sort(F.collect_set("category"))
    return found.groupBy(key).agg(seen.alias("sections_detected"), F.first("strategy").alias("strategy"), F.count("*").alias("block_count")).select(
        key, "strategy", "block_count", "sections_detected",
        F.array_sort(F.array_intersect("sections_detected", CORE_ARRAY())).alias("required_sections_found"),
        (F.size(F.array_except(CORE_ARRAY(), "sections_detected")) == 0).alias("required_sections_complete"),
    )


def part_document_frequency(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, n_docs) for all parts, with zeros."""
    spark = found.sparkSession
    n = found.select(key, F.col("category").alias("part")).distinct().groupBy("part").agg(F.count("*").alias("n"))
    parts = spark.createDataFrame([(c,) for c in CATEGORIES], "part string")
    return parts.join(n, "part", "left").select("part", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_docs"))


def methods_parents(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, line_start, heading, heading_level, parent_line) of the Methods blocks: the parent is the
    nearest one before of a smaller level. A level's last block is a window, so no join is needed."""
    before = Window.partitionBy(key).orderBy("line_start").rowsBetween(Window.unboundedPreceding, -1)
    last = [F.max(F.when(F.col("heading_level") == n, F.col("line_start"))).over(before) for n in range(6)]
    rows = found.where("category = 'Methods'").select(key, "line_start", "heading", "heading_level", F.array(*last).alias("last"))
    lower = F.array_max(F.transform("last", lambda x, n: F.when(n < F.col("heading_level"), x)))
    return rows.select(key, "line_start", "heading", "heading_level", lower.alias("parent_line"))


def document_structure(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, heading, pos, content) of headings with content: of repeated ones the last content, at
    the place of the first."""
    rows = found.where("content <> ''")
    return rows.groupBy(key, "heading").agg(F.min("line_start").alias("pos"), F.max_by("content", "line_start").alias("content"))


def validate_sections(structure: DataFrame, key: str = "doc_id") -> DataFrame:
    """Whether any heading speaks of methods, and of results."""
    has = lambda w: F.max(F.lower("heading").contains(w))
    out = structure.groupBy(key).agg(has("method").alias("has_methods"), has("result").alias("has_results"))
    missing = F.array_compact(F.array(F.when(~F.col("has_methods"), "Methods"), F.when(~F.col("has_results"), "Results")))
    return out.select(key, "has_methods", "has_results", missing.alias("missing_sections"))


def classify_heading_list(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, line_start, heading, list_category) by the second rule set; the first heading that is not
    blank is the title."""
    filled = strip("heading") != ""
    first = F.min(F.when(filled, F.col("line_start"))).over(Window.partitionBy(key))
    return found.select(key, "line_start", "heading", F.when(F.col("line_start") == first, "Title").otherwise(list_rule_category("heading")).alias("list_category"))


def map_sections(titles: DataFrame, classification: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, heading, category): the first category, in their order, whose list has the heading.

    ``classification`` is (key, category, headings), headings an array or, as models also answer, a
    text split at commas. Blank headings are left out, unknown ones have no category.
    """
    kind = classification.schema["headings"].dataType.simpleString()
    names = F.col("headings") if kind.startswith("array") else F.filter(F.transform(F.split("headings", ","), strip), lambda h: h != "")
    rank = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("category"))
    known = classification.select(key, rank.alias("rank"), "category", F.explode(names).alias("heading"))
    # titles and answers meet in an aggregation by document and heading, which keeps their dealing by document
    both = titles.select(key, "heading", F.lit(True).alias("title"), F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("category"))
    both = both.unionByName(known.select(key, "heading", F.lit(None).cast("boolean").alias("title"), F.col("rank").cast("int").alias("rank"), "category"))
    out = both.where(strip("heading") != "").groupBy(key, "heading").agg(F.min_by("category", "rank").alias("category"), F.max("title").alias("title"))
    return out.where("title").select(key, "heading", "category")


def reorganize(structure: DataFrame, mapping: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row per document: texts of the five core parts and of the rest, their words and characters,
    the document's, and the words in no core part."""
    nothing = lambda t: F.lit(None).cast(t)
    given = mapping.select(key, "heading", "category", nothing("int").alias("pos"), nothing("string").alias("content"))
    rows = structure.select(key, "heading", nothing("string").alias("category"), F.col("pos").cast("int").alias("pos"), "content").unionByName(given)
    rows = rows.groupBy(key, "heading").agg(F.min("category").alias("category"), F.max(F.struct("pos", "content")).alias("x")).where("x.pos IS NOT NULL")
    part = F.when(F.col("category").isin(*CORE), F.col("category")).otherwise("Unassigned")
    rows = rows.select(key, "x.pos", "x.content", part.alias("part"))
    joined = lambda cond, sep: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("pos", "content")))), lambda x: F.concat(x["content"], F.lit(sep))), "")
    names = [*CORE, "Unassigned"]
    out = rows.groupBy(key).agg(
        F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[joined(F.col("part") == n, "\n\n") for n in names])).alias("parts"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "content"))), lambda x: x["content"]), "\n\n").alias("whole"),
    )
    words = F.transform_values("parts", lambda _, v: count_tokens(v))
    out = out.select(key, "parts", words.alias("num_words"), F.transform_values("parts", lambda _, v: F.length(v)).alias("num_chars"), count_tokens("whole").alias("total_words"), F.length("whole").alias("total_chars"))
    core = F.aggregate(CORE_ARRAY(), F.lit(0), lambda acc, n: acc + F.element_at(F.col("num_words"), n))
    return out.withColumn("uncounted_words", F.col("total_words") - core)


def validate_reorganization(done: DataFrame, key: str = "doc_id") -> DataFrame:
    has = lambda n: strip(F.col("parts")[n]) != ""
    out = done.select(key, has("Methods").alias("has_methods"), has("Results").alias("has_results"), unassigned_percent(F.col("num_words")["Unassigned"], F.col("total_words")).alias("unassigned_percent"))
    missing = F.array_compact(F.array(F.when(~F.col("has_methods"), "Methods"), F.when(~F.col("has_results"), "Results")))
    return out.withColumn("missing_content", missing).withColumn("mostly_unassigned", F.coalesce(F.col("unassigned_percent") > 30, F.lit(False)))
