"""Markdown tables: finding them with their context, their structure, cells, filters and snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound, strip

# Labels of tables.
LABELS = ("brain_activation", "demographic", "statistical", "methodological", "other")


def table_runs(rows: DataFrame, key: str = "doc_id", strict: bool = False, context: int = 5) -> DataFrame:
    """Tables in lines (key, i, raw, s): (key, table_index, line_start, table_text, before_context,
    after_context, full_context).

    A table begins at a line that starts and ends with a pipe (``strict``: two pipes at least) and
    goes on over lines that start with one (``strict``: begin and end so) or are blank. So it is what
    a maximal run of such lines has from its first beginning on; trailing blanks stay.
    """
    order = Window.partitionBy(key).orderBy("i")
    full = F.col("s").rlike(r"^\|.*\|$") if strict else (F.col("s").startswith("|") & F.col("s").endswith("|"))
    member = (F.col("s") == "") | (full if strict else F.col("s").startswith("|"))
    marked = rows.withColumn("full", full).withColumn("member", member)
    change = (F.col("member") != F.coalesce(F.lag("member").over(order), F.lit(False))).cast("int")
    marked = marked.withColumn("run", F.sum(change).over(order))
    marked = marked.withColumn("start", F.when(F.col("member"), F.min(F.when(F.col("full"), F.col("i"))).over(Window.partitionBy(key, "run"))))
    marked = marked.withColumn("start", F.when(F.col("i") >= F.col("start"), F.col("start")))
    # each line has its neighbours beside it, so a table needs no line but its own
    near = lambda lo, hi: F.array_join(F.collect_list("raw").over(order.rowsBetween(lo, hi)), "\n")
    marked = marked.withColumn("above", near(-context, -1)).withColumn("below", near(1, context)).where("start IS NOT NULL")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "raw"))), lambda x: x["raw"]), "\n")
    found = marked.groupBy(key, "start").agg(text.alias("table_text"), F.min_by("above", "i").alias("before_context"), F.max_by("below", "i").alias("after_context"))
    index = F.row_number().over(Window.partitionBy(key).orderBy("start")) - 1
    out = found.select(key, index.alias("table_index"), (F.col("start") + 1).alias("line_start"), "table_text", "before_context", "after_context")
    mark = F.concat(F.lit("\n[TABLE "), (F.col("table_index") + 1).cast("string"), F.lit("]\n"))
    return out.withColumn("full_context", F.concat(F.col("before_context"), mark, F.col("after_context")))


def tables_by_pattern(text: Column) -> Column:
    """Tables by one pattern: pipe rows, a rule, pipe rows."""
    return F.regexp_extract_all(text, F.lit(r"((?:\|.*\|\n)+\|?[\s-]+\|.*\n(?:\|.*\|\n)+)"), F.lit(1))


def cells(line: Column) -> Column:
    return F.filter(F.transform(F.split(line, r"\|", -1), strip), lambda c: c != "")


def structure(text: Column) -> Column:
    """Struct (num_rows, num_columns, has_header, header_row, data_rows).

    The rule is the first line of dashes, colons and blanks only; the header stands above it, or is the
    first line. Blank cells are dropped, and with them any row that then is not as long as the header.
    """

    def table(filled: Column, rule: Column) -> Column:
        has_header = rule > 0
        rest = F.slice(filled, F.when(rule >= 0, rule + 2).otherwise(2), F.greatest(F.size(filled), F.lit(1)))
        rows = F.transform(F.filter(rest, lambda s: s.contains("|")), cells)
        parts = lambda header, data: F.struct(
            F.size(data).alias("num_rows"), F.size(header).alias("num_columns"), has_header.alias("has_header"), F.when(F.size(filled) > 0, header).alias("header_row"), data.alias("data_rows")
        )
        head = cells(F.coalesce(F.get(filled, F.when(has_header, rule - 1).otherwise(0)), F.lit("")))
        return bound(head, lambda header: bound(F.filter(rows, lambda r: F.size(r) == F.size(header)), lambda data: parts(header, data)))

    def rule_of(filled: Column) -> Column:
        is_rule = F.transform(filled, lambda s: strip(F.replace(s, F.lit("|"), F.lit(""))).rlike(r"^[:\-\s]+$"))
        return (F.array_position(is_rule, True) - 1).cast("int")

    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), strip), lambda s: s != "")
    return bound(lines, lambda filled: bound(rule_of(filled), lambda rule: table(filled, rule)))


def cells_long(found: DataFrame, keys: list[str], struct: str = "structure") -> DataFrame:
    """A row per cell, for tables of any columns: keys, row_no, col_no, column, value."""
    # one array of cells, so that a structure that is computed just before is so once
    cell = lambda s, i: lambda v, j: F.struct(i.alias("row_no"), j.alias("col_no"), F.get(s["header_row"], j).alias("column"), v.alias("value"))
    every = bound(F.col(struct), lambda s: F.flatten(F.transform(s["data_rows"], lambda r, i: F.transform(r, cell(s, i)))))
    return found.select(*keys, F.explode_outer(every).alias("cell")).where("cell IS NOT NULL").select(*keys, "cell.*")


def filter_by_keywords(found: DataFrame, keywords: list[str]) -> DataFrame:
    hit = F.lit(False)
    for k in keywords:
        hit = hit | F.lower("table_text").contains(k.lower()) | F.lower("full_context").contains(k.lower())
    return found.where(hit)


def filled_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda s: strip(s) != "")


def snippet(text: Column, most: int = 10, edge: int = 5) -> Column:
    """The filled lines, of long tables only those at both ends around dots."""
    x = filled_lines(text)
    short = F.concat(F.slice(x, 1, edge), F.array(F.lit("...")), F.slice(x, -edge, edge))
    return F.array_join(F.when(F.size(x) > most, short).otherwise(x), "\n")


def chunks(text: Column, size: int = 10) -> Column:
    x = filled_lines(text)
    at = F.sequence(F.lit(0), F.size(x) - 1, F.lit(size))
    return F.when(F.size(x) > 0, F.transform(at, lambda i: F.array_join(F.slice(x, i + 1, F.lit(size)), "\n"))).otherwise(F.array().cast("array<string>"))


def to_html(text: Column) -> Column:
    """HTML of a pipe table: rules and blank cells left out, the first line as a header."""
    rows = F.split(strip(text), "\n", -1)

    def row(line: Column, i: Column) -> Column:
        s = strip(line)
        inner = F.regexp_replace(F.regexp_replace(s, r"^\|", ""), r"\|$", "")
        each = F.transform(F.split(inner, r"\|", -1), strip)
        rule = F.forall(each, lambda c: (c == "") | c.rlike("^:?-+:?$"))
        tag = F.when(i == 0, "th").otherwise("td")
        body = F.transform(F.filter(each, lambda c: c != ""), lambda c: F.concat(F.lit("    <"), tag, F.lit(">"), c, F.lit("</"), tag, F.lit(">")))
        return F.when((s != "") & ~rule, F.concat(F.array(F.lit("  <tr>")), body, F.array(F.lit("  </tr>"))))

    made = F.flatten(F.array_compact(F.transform(rows, row)))
    return F.array_join(F.concat(F.array(F.lit("<table>")), made, F.array(F.lit("</table>"))), "\n")


def pipe_columns(text: Column) -> Column:
    """Pipes less one on the first line that starts with one."""
    first = F.get(F.filter(F.split(strip(text), "\n", -1), lambda s: strip(s).startswith("|")), F.lit(0))
    return F.coalesce(F.greatest(F.length(first) - F.length(F.replace(first, F.lit("|"), F.lit(""))) - 1, F.lit(0)), F.lit(0))


def pipe_rows(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n", -1), lambda s: strip(s).startswith("|")))


def structured_tables(docs: DataFrame, key: str = "doc_id", items: str = "tables", text: str = "md", context: int = 5) -> DataFrame:
    """Tables listed in structured content (id, content, line_start), with context from the source."""
    rows = docs.select(key, F.split(F.col(text), "\n", -1).alias("all"), F.posexplode(F.coalesce(F.col(items), F.array().cast("array<struct<id:string,content:string,line_start:int>>"))).alias("table_index", "item"))
    start = F.greatest(F.col("item.line_start") - 1, F.lit(0))
    known = F.col("all").isNotNull() & (F.col("item.line_start") > 0)
    first = F.greatest(start - context, F.lit(0))
    height = F.size(filled_lines(F.col("item.content")))
    before = F.when(known, F.array_join(F.slice("all", first + 1, start - first), "\n")).otherwise("")
    after = F.when(known, F.array_join(F.slice("all", start + height + 1, context), "\n")).otherwise("")
    return rows.select(
        key, "table_index", F.coalesce("item.id", F.concat(F.lit("table_"), (F.col("table_index") + 1).cast("string"))).alias("table_id"), F.when(F.col("item.line_start") > 0, F.col("item.line_start")).alias("line_start"),
        F.col("item.content").alias("table_text"), structure(F.col("item.content")).alias("structure"), before.alias("before_context"), after.alias("after_context"),
    )


def category_counts(found: DataFrame, label: str = "category") -> DataFrame:
    """(category, n) for all labels; unknown ones are 'other'."""
    spark = found.sparkSession
    known = F.when(F.col(label).isin(*LABELS), F.col(label)).otherwise("other")
    n = found.groupBy(known.alias("category")).agg(F.count("*").alias("n"))
    return spark.createDataFrame([(c,) for c in LABELS], "category string").join(n, "category", "left").select("category", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def candidate_tables(found: DataFrame, key: str = "doc_id", label: str = "category") -> DataFrame:
    """Of each document the tables labelled brain_activation or, where there are none, all."""
    some = F.max((F.col(label) == "brain_activation").cast("int")).over(Window.partitionBy(key))
    return found.withColumn("some", some).where((F.col("some") == 0) | (F.col(label) == "brain_activation")).drop("some")


# Names that columns of coordinate tables go by, as lower case.
COORDINATE_COLUMNS = {
    "region": ("brain_region", "region"),
    "hemisphere": ("hemisphere", "h"),
    "ba": ("ba",),
    "x": ("x",),
    "y": ("y",),
    "z": ("z",),
    "statistic": ("statistic_value", "t", "t_score", "z_score"),
    "p": ("p", "p_value", "threshold"),
    "cluster_size": ("cluster_size", "voxels"),
    "space": ("brain_space",),
    "task": ("task_name",),
}


def canonical_rows(rows: Column) -> Column:
    """Extension: a coordinate table's rows (maps of column to value) as structs of fixed fields;
    numbers that do not parse are null, with the text kept beside p."""
    numbers = ("x", "y", "z", "statistic", "cluster_size", "ba")

    def one(row: Column) -> Column:
        low = F.transform_keys(row, lambda k, _: F.when(k == "Z", F.lit("z")).otherwise(F.lower(k)))
        fields = []
        for name, aliases in COORDINATE_COLUMNS.items():
            value = F.coalesce(*[F.try_element_at(low, F.lit(a)) for a in aliases])
            fields.append(value.try_cast("double").alias(name) if name in numbers else value.alias(name))
            if name == "p":
                fields.append(value.try_cast("double").alias("p_number"))
        return F.struct(*fields)

    return F.transform(rows, one)


def zipped_tables(docs: DataFrame, key: str = "doc_id", contents: str = "tables", before: str = "infos", after: str = "annotations") -> DataFrame:
    """A row per table of three parallel lists, as many as the shortest has: id, content, contexts, rows
    and columns."""
    n = F.least(F.size(contents), F.size(before), F.size(after))
    zipped = F.slice(F.arrays_zip(F.col(contents).alias("t"), F.col(before).alias("b"), F.col(after).alias("a")), F.lit(1), F.greatest(n, F.lit(0)))
    rows = docs.select(key, F.posexplode(zipped).alias("i", "x"))
    return rows.select(
        key, F.concat(F.lit("table_"), (F.col("i") + 1).cast("string")).alias("table_id"), F.col("x.t").alias("table_content"), F.col("x.b").alias("preceding_context"), F.col("x.a").alias("following_context"),
        pipe_rows(F.col("x.t")).alias("num_rows"), pipe_columns(F.col("x.t")).alias("num_columns"),
    )
