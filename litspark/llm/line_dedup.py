"""Line dedup: lines found in many documents go from all of them.

Normalised lines are exploded as hashes, documents are counted per hash, and the texts are put
together again from the positions that stay. Only hashes and positions are shuffled for the
counting; a document's text moves once, to meet its positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound
from .common import drop_staged, lower_ascii, stage, staged_mark, text_hash

#: What a line's key loses at both ends: space, and tab to carriage return.
BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return bound(F.btrim(line, F.lit(BLANK)), lower_ascii)


def dedup_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1, by_text: bool = False) -> DataFrame:
    """``docs`` with ``text`` rid of frequent lines, plus ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line stripped and A-Z lower-cased. Keys of at least ``min_chars`` code
    points found in at least ``min_docs`` documents lose all their lines everywhere. Each row is a
    document of its own, repeated ids and texts included; with ``by_text``, rows of one text count once, so
    that a group of exact copies alone makes no line frequent. A null or empty text is one empty line,
    kept as an empty text; texts of any length are handled whole; an empty table gives an empty
    result. Columns of ``docs`` named like the added ones are replaced, others pass through.
    """
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    named = {c: f"c{i}" for i, c in enumerate(rest)}
    base = docs.select(*[F.col(f"`{c}`").alias(named[c]) for c in rest])
    col = named[text]
    hashed = base.select(
        text_hash(col).alias("th"),
        F.transform(F.split(F.coalesce(col, F.lit("")), "\n", -1), lambda x: line_key(x)).alias("keys"),
    ).select(
        "th", F.transform("keys", lambda k: F.when(F.length(k) >= min_chars, F.unhex(F.md5(k.cast("binary"))))).alias("hashes")
    )
    # outer, as no array is empty: else Spark computes them once more to filter empty ones
    mark = staged_mark()
    counts = hashed.select(*["th"] * by_text, F.explode_outer(F.array_distinct("hashes")).alias("h")).where("h is not null")
    counts = counts.distinct() if by_text else counts
    frequent = stage(counts.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("h"), "lines")
    drops = hashed.select("th", F.posexplode_outer("hashes").alias("pos", "h")).where("h is not null")
    # written first: the join below then has a plain shuffle on both sides, which AQE splits at a
    # text that many rows share
    drops = stage(drops.join(frequent, "h", "left_semi").groupBy("th").agg(F.collect_set("pos").alias("drop")), "drops")
    drop_staged(docs.sparkSession, mark, drops)
    lines = F.split(F.coalesce(F.col(col), F.lit("")), "\n", -1)
    joined = base.withColumn("th", text_hash(col)).join(drops, "th", "left").withColumn("lines", lines)
    kept = F.when(F.col("drop").isNull(), F.coalesce(F.col(col), F.lit(""))).otherwise(
        F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop")), lambda i: F.element_at("lines", i + 1)
            ),
            "\n",
        )
    )
    out = [kept.alias(text) if c == text else F.col(named[c]).alias(c) for c in rest]
    return joined.select(
        *out, F.size("lines").cast("bigint").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("bigint").alias("n_dropped")
    )
