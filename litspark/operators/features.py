"""Task features through a model: three questions, answers as 0 and 1, merged and closed upwards."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..adapters import call
from ..functions.text import strip
from ..shared import running
from .ontology import closure, merge_features, normalize_flag, schema_leaves

KINDS = ("representational", "processing", "design")
#: Characters of the methods that a question shows.
CONTEXT = 2000


def paper_ids(papers: DataFrame, order: str) -> DataFrame:
    """Papers without an id are named by their place."""
    rows = running(papers, order, paper_place=F.lit(1))
    return rows.withColumn("task_id", F.coalesce("task_id", F.concat(F.lit("paper_"), F.col("paper_place").cast("string")))).drop("paper_place")


def ask(papers: DataFrame, make: Callable[[], Callable[[dict], str | None]], kind: str) -> DataFrame:
    """(task_id, feature, value) of one question's leaves. A blank task or context is not asked about;
    there, and where the model fails, all are absent."""
    leaves = schema_leaves(kind)
    rows = papers.select("task_id", "task_name", F.left(F.coalesce("methods", F.lit("")), F.lit(CONTEXT)).alias("context")).withColumn("kind", F.lit(kind)).withColumn("leaves", F.lit(json.dumps(leaves)))
    full = (F.coalesce("task_name", F.lit("")) != "") & (strip("context") != "")
    said = call(rows.where(full), make, ["task_name", "context", "kind", "leaves"]).select("task_id", "answer")
    values = F.from_json("answer", "map<string,string>")
    names = F.explode(F.array(*[F.lit(n) for n in leaves])).alias("feature")
    every = papers.select("task_id").join(said.select("task_id", values.alias("values")), "task_id", "left").select("task_id", "values", names)
    return every.select("task_id", "feature", normalize_flag(F.try_element_at("values", F.col("feature"))).alias("value"))


def extract_features(papers: DataFrame, make: Callable[[], Callable[[dict], str | None]]) -> DataFrame:
    """(task_id, feature, value) of all nodes of the ontology, for papers (task_id, task_name, methods)."""
    return closure(merge_features(*[ask(papers, make, k) for k in KINDS]))
