"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

All stages: a null text is an empty one (line dedup makes it so); rows that repeat an id are documents of
their own, told apart by their texts; texts are taken whole, however long; an empty table stays empty;
columns beside those of documents pass through, whatever their names (mixing adds ``mix_copy`` and
``mix_order`` and replaces columns so named).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litspark.llm.common import drop_staged, prepare, stage, staged_mark, table
from litspark.llm.decontaminate import drop_contaminated
from litspark.llm.line_dedup import dedup_lines
from litspark.llm.minhash import drop_near_duplicates
from litspark.llm.mixing import mix
from litspark.llm.quality import fit_quality, score_quality

#: Documents that score below this go.
QUALITY = 0.5
#: A line found in so many documents goes from all.
LINE_DOCUMENTS = 10


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled rows, does not reject."""
    prepare(spark)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    score = max(docs.columns, key=len) + "_score"  # no column of theirs
    return score_quality(docs, model, out=score).where(F.col(score) >= QUALITY).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share; ``n_chars``, if there, follows the text.

    Exact copies count as one document here, as near-dedup comes behind: else a group of
    ``LINE_DOCUMENTS`` copies would lose all its text before one of them could stay.
    """
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    text = inner[names.index("text")]
    out = dedup_lines(docs.toDF(*inner), text=text, min_docs=LINE_DOCUMENTS, by_text=True).select(*inner)
    if "n_chars" in names:
        out = out.withColumn(inner[names.index("n_chars")], F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.toDF(*names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on five-word shingles at a similarity of 0.8.
    Documents without words are no copies of one another and stay."""
    return drop_near_duplicates(docs, k=5, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without four fifths of any benchmark item's five-word shingles."""
    prepare(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to source shares of n^0.5, in a global random order."""
    return mix(docs, alpha=0.5, epoch=1.0, seed="mix")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

#: The trees of the first stage are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = table(spark, sf_dir, "documents"), staged_mark()
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
        drop_staged(spark, mark, docs)
    return docs
