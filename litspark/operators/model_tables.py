"""Tables through models: labels, coordinate assessment, and rows from answers in CSV.

A model is an adapter (see ``litspark.adapters``); what it costs runs only on rows that need it, and
results should be written out right behind it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..adapters import call
from ..functions.text import bound, clean_csv_text, strip
from .tables import LABELS, candidate_tables, chunks, filled_lines, snippet

Make = Callable[[], Callable[[dict], str | None]]
#: Filled lines up to which a table is judged whole.
WHOLE = 10


def label(answer: Column) -> Column:
    """The label in a JSON answer; what is unknown, missing or malformed is 'other'."""
    said = F.lower(strip(F.try_variant_get(F.try_parse_json(answer), "$.category", "string")))
    return F.when(said.isin(*LABELS), said).otherwise("other")


def categorize(tables: DataFrame, judge: Make, keys: tuple[str, ...] = ("doc_id", "table_index")) -> DataFrame:
    """Adds ``category``. A first pass judges a snippet; tables longer than ``WHOLE`` lines that then
    want it are scanned in chunks, in which only coordinate tables are looked for."""
    rows = tables.withColumn("n_lines", F.size(filled_lines(F.col("table_text"))))
    asked = rows.where("n_lines > 0").select(*keys, "n_lines", "table_text", snippet(F.col("table_text")).alias("snippet"), F.col("full_context").alias("context"))
    first = call(asked, judge, ["snippet", "context"])
    full = F.coalesce(F.try_variant_get(F.try_parse_json("answer"), "$.need_full_scan", "boolean"), F.lit(False))
    first = first.select(*keys, "table_text", "context", label(F.col("answer")).alias("category"), (full & (F.col("n_lines") > WHOLE)).alias("full"))
    scan = first.where(F.col("full") & (F.col("category") != "brain_activation")).select(*keys, "context", F.posexplode(chunks(F.col("table_text"))).alias("at", "snippet"))
    scan = scan.withColumn("context", F.when(F.col("at") == 0, F.col("context")).otherwise(""))
    found = call(scan, judge, ["snippet", "context"]).where(label(F.col("answer")) == "brain_activation").select(*keys).distinct().withColumn("hit", F.lit(True))
    labelled = first.join(found, list(keys), "left").select(*keys, F.when(F.col("hit"), "brain_activation").otherwise(F.col("category")).alias("category"))
    return tables.join(labelled, list(keys), "left").withColumn("category", F.coalesce("category", F.lit("other")))


def assess(tables: DataFrame, judge: Make) -> DataFrame:
    """Adds ``contains_coordinates`` (the answer says exactly 'Yes') and ``task`` ('Unknown' if empty)."""
    v = F.try_parse_json("answer")
    out = call(tables, judge, ["table_text", "full_context"])
    task = F.nullif(F.try_variant_get(v, "$.Task_name", "string"), F.lit(""))
    yes = F.coalesce(F.try_variant_get(v, "$.contains_coordinates", "string") == "Yes", F.lit(False))
    return out.withColumn("contains_coordinates", yes).withColumn("task", F.coalesce(task, F.lit("Unknown"))).drop("answer")


def csv_rows(answer: Column) -> Column:
    """Struct (columns, rows, ragged): a CSV answer's rows as maps; ``ragged`` counts lines of another
    length than the header, which are left out."""
    lines = F.filter(F.split(clean_csv_text(answer), "\n", -1), lambda s: strip(s) != "")
    # commas outside of quotes; quotes around a field go
    fields = lambda s: F.transform(F.split(s, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1), lambda c: F.replace(F.regexp_replace(strip(c), r'^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))

    def table(parsed: Column) -> Column:
        head = F.coalesce(F.get(parsed, F.lit(0)), F.array().cast("array<string>"))
        body = F.slice(parsed, F.lit(2), F.greatest(F.size(parsed), F.lit(1)))
        good = F.filter(body, lambda r: F.size(r) == F.size(head))
        # repeated names get their place, so every column stays
        names = F.transform(head, lambda c, i: F.when(F.array_position(head, c) <= i, F.concat(c, F.lit("."), i.cast("string"))).otherwise(c))
        return bound(names, lambda n: F.struct(n.alias("columns"), F.transform(good, lambda r: F.map_from_arrays(n, r)).alias("rows"), (F.size(body) - F.size(good)).alias("ragged")))

    return bound(F.transform(lines, fields), table)


def parse(tables: DataFrame, model: Make, all_or_nothing: bool = False) -> DataFrame:
    """Adds ``parsed`` (see :func:`csv_rows`) and ``error``. With ``all_or_nothing`` a ragged answer
    leaves no rows, as a strict CSV reader would."""
    out = call(tables, model, ["table_text", "full_context", "task"])
    out = out.withColumn("parsed", csv_rows(F.coalesce("answer", F.lit("")))).drop("answer")
    empty = F.size("parsed.rows") == 0
    if all_or_nothing:
        empty = empty | (F.col("parsed.ragged") > 0)
        none = F.array().cast(out.schema["parsed"].dataType["rows"].dataType)
        out = out.withColumn("parsed", F.when(F.col("parsed.ragged") > 0, F.col("parsed").withField("rows", none)).otherwise(F.col("parsed")))
    return out.withColumn("error", F.coalesce("error", F.when(empty, "no rows")))


def activation_tables(tables: DataFrame, judge: Make, assessor: Make, parser: Make, key: str = "doc_id") -> DataFrame:
    """Coordinate tables of each document: labelled ones or, where there are none, all; those with
    coordinates, parsed. A table whose answer has no rows stays, with its error."""
    some = candidate_tables(categorize(tables, judge), key)
    found = assess(some, assessor).where("contains_coordinates").drop("error")
    return parse(found, parser)
