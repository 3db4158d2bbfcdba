"""Abstract screening: resume, judging through an adapter, decisions, training records, the funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys that review criteria must have.
REQUIRED_KEYS = ("review_name", "research_field", "research_topic_statement", "methodology", "participant_scope", "disease_and_case_report_policy", "publication_filters", "decision_policy")
# The instruction of a training record, and its labels.
INSTRUCTION = "You are a literature screener. Judge whether the study fits the review scope and return JSON with include/confidence/reason/labels."
TARGET = {"target_model": "Qwen3-3B", "recommended_finetune_framework": "PEFT", "task": "abstract_screening"}


def flatten_criteria(criteria: dict) -> dict:
    """Criteria as a flat payload; raises ValueError naming what is missing."""
    missing = [k for k in REQUIRED_KEYS if k not in criteria]
    if missing:
        raise ValueError(f"criteria lack {', '.join(missing)}")
    out = {k: v for k, v in criteria.items() if k != "methodology"}
    how = criteria["methodology"] or {}
    return out | {"methodology_include": list(how.get("include") or []), "methodology_exclude": list(how.get("exclude") or [])}


def unprocessed(rows: DataFrame, done: DataFrame, key: str = "pmid") -> DataFrame:
    """Rows whose key has no decision yet; before any paid call."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def with_abstract(rows: DataFrame, provided: DataFrame | None = None, key: str = "pmid") -> DataFrame:
    """``abstract`` as given or, where blank, as provided; null if neither has one."""
    own = F.nullif("abstract", F.lit(""))
    if provided is None:
        return rows.withColumn("abstract", own)
    more = provided.select(key, F.col("abstract").alias("provided"))
    return rows.join(more, key, "left").withColumn("abstract", F.coalesce(own, F.nullif("provided", F.lit("")))).drop("provided")


def decisions(answers: DataFrame, key: str = "pmid", answer: str = "answer") -> DataFrame:
    """(key, include, confidence, reason, labels) from answers in JSON.

    Any value but false, 0, null and empty ones includes, the text "false" too. What is missing or
    malformed is false, 0, '' and {}.
    """
    v = F.try_parse_json(F.col(answer))
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    kind = F.schema_of_variant(F.try_variant_get(v, "$.include", "variant"))
    said = get("$.include", "string")
    include = F.when(said.isNull(), False).when(kind == "BOOLEAN", said == "true").when(kind == "STRING", said != "").when(said.try_cast("double").isNotNull(), said.try_cast("double") != 0)
    include = include.otherwise(~said.isin("[]", "{}"))
    return answers.select(
        key, F.coalesce(include, F.lit(False)).alias("include"), F.coalesce(get("$.confidence", "double"), F.lit(0.0)).alias("confidence"),
        F.coalesce(get("$.reason", "string"), F.lit("")).alias("reason"), F.coalesce(get("$.labels", "map<string,string>"), F.create_map().cast("map<string,string>")).alias("labels"),
    )


def failed_decision(reason: Column) -> list[Column]:
    """Columns of a decision that a failed call or a missing abstract leaves."""
    return [F.lit(False).alias("include"), F.lit(0.0).alias("confidence"), reason.alias("reason"), F.create_map().cast("map<string,string>").alias("labels")]


def confident(rows: DataFrame, least: float) -> DataFrame:
    """Extension: decisions to include only above a confidence; the criteria's threshold is otherwise
    for the model to read, not enforced."""
    return rows.withColumn("include", F.col("include") & (F.col("confidence") >= least))


def training_records(rows: DataFrame, criteria: Column, key: str = "pmid") -> DataFrame:
    """(instruction, input, output, metadata) of judged rows."""
    return rows.select(
        F.lit(INSTRUCTION).alias("instruction"),
        F.struct(criteria.alias("criteria"), "abstract").alias("input"),
        F.struct("include", "confidence", "reason", "labels").alias("output"),
        F.struct(F.col(key).alias("pmid"), *[F.lit(v).alias(k) for k, v in TARGET.items()]).alias("metadata"),
    )


def prompts(rows: DataFrame, criteria: Column, key: str = "pmid") -> DataFrame:
    """(key, prompt): the payload that a judge is sent."""
    payload = F.to_json(F.struct(criteria.alias("criteria"), F.struct(F.col(key).alias("pmid"), "title", "abstract").alias("record")))
    return rows.select(key, F.concat(F.lit("Judge the record against the criteria and answer in JSON.\n"), payload).alias("prompt"))


def funnel(rows: DataFrame) -> DataFrame:
    """Counters over (abstract, include, download_status, ocr_status); a record without an abstract
    counts in the total only."""
    have = F.col("abstract").isNotNull()
    kept = have & F.coalesce("include", F.lit(False))
    got = kept & (F.coalesce("download_status", F.lit("")) == "success")
    return rows.agg(
        F.count("*").alias("total"), F.count_if(have).alias("abstract_available"), F.count_if(kept).alias("included"), F.count_if(have & ~kept).alias("excluded"),
        F.count_if(got).alias("downloaded"), F.count_if(got & (F.lower(F.coalesce("ocr_status", F.lit(""))) == "success")).alias("ocr_success"),
    )


def summary(rows: DataFrame) -> DataFrame:
    """Total, included, excluded, and downloads that succeeded and left a file."""
    return rows.agg(
        F.count("*").alias("total"), F.count_if("include").alias("included"), F.count_if(~F.col("include")).alias("excluded"),
        F.count_if((F.col("download_status") == "success") & (F.coalesce("pdf_path", F.lit("")) != "")).alias("downloaded"),
    )


def criteria_frame(spark: SparkSession, criteria: dict) -> DataFrame:
    """The criteria as one row with a JSON column."""
    import json

    return spark.createDataFrame([(json.dumps(flatten_criteria(criteria), ensure_ascii=False),)], "criteria string")
