"""Mixing sources to target weights by Poisson replication.

A document's number of copies is the inverse of a Poisson distribution at a uniform number that
its hash gives; the mean is its source's target repetition rate. Copies are exploded and then
shuffled over the whole table by another hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound
from .common import stage

#: 13 hex digits, 52 bits: every value is exact in a double.
DIGITS = 13


#: A mean up to which the distribution is inverted as one; greater ones are sums of several.
CHUNK = 64.0
#: Copies that one row is exploded to at once.
RUN = 1 << 14


def uniform(seed: Column | str, key: Column) -> Column:
    """In [0, 1), from the md5 of seed and key."""
    named = F.concat(F.lit(seed) if isinstance(seed, str) else seed, F.lit(":"), key)
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, DIGITS), 16, 10).cast("bigint") / F.lit(float(16**DIGITS))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1) and so on, for a rate of at most CHUNK, to where double precision ends."""
    most = int(CHUNK + 12 * CHUNK**0.5 + 30)
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * rate / k
        return F.struct(term.alias("term"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + term)).alias("cdf"))

    return F.array_distinct(F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step, lambda acc: acc["cdf"]))


def poisson_parts(rate: Column) -> Column:
    return F.greatest(F.ceil(rate / CHUNK), F.lit(1)).cast("int")


def poisson_count(seed: str, key: Column, parts: Column, cdf: Column) -> Column:
    """The inverse at a hashed uniform number: how many terms of the distribution it is not below. A
    number of a great mean is the sum of ``parts`` numbers of equal parts of it, a seed each."""
    below = lambda u: bound(u, lambda v: F.size(F.filter(cdf, lambda c: v >= c)))
    more = F.aggregate(F.sequence(F.lit(1), parts - 1), F.lit(0), lambda acc, j: acc + below(uniform(F.concat(F.lit(f"{seed}#"), j.cast("string")), key)))
    return below(uniform(seed, key)) + F.when(parts > 1, more).otherwise(0)


def source_rates(docs: DataFrame, source: str = "source", weights: Mapping[str, float] | None = None, alpha: float = 0.5, epoch: float = 1.0) -> DataFrame:
    """A row (source, rate) per source: rate = epoch * N * weight / n.

    ``weights`` are target shares; without them a source's share is its row count to the power
    ``alpha``. Shares are normalised over the sources that occur; a source without a given weight
    has none, so rate 0.
    """
    n = docs.groupBy(F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("mix_source")).agg(F.count("*").alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        share = F.lit(0.0)
        for k, v in weights.items():
            share = F.when(F.col("mix_source") == k, F.lit(float(v))).otherwise(share)
    n = n.withColumn("share", share)
    all_n, all_share = n.agg(F.sum("n")).scalar(), n.agg(F.sum("share")).scalar()
    rate = F.lit(epoch) * all_n * F.col("share") / F.nullif(all_share, F.lit(0.0)) / F.col("n")
    return n.select("mix_source", F.round(F.coalesce(rate, F.lit(0.0)), 9).alias("mix_rate"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", weights: Mapping[str, float] | None = None, alpha: float = 0.5,
        epoch: float = 1.0, seed: str = "mix", shuffle: bool = True) -> DataFrame:
    """Every document repeated by its count, in a global random order.

    Adds ``mix_copy`` (from 0) and ``mix_order`` (16 hex digits; rows are dealt and sorted by it, so
    partitions and files are in random order throughout). Rows with the same key get the same
    count; a null key counts as empty, a null source as ''. An empty table gives an empty result.
    Columns of those names are replaced; all others pass through. Rates are not capped: a rare source
    with a great weight is repeated as often as that takes.
    """
    names = [c for c in docs.columns if c not in ("mix_copy", "mix_order")]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])
    key, source = (f"c{names.index(c)}" for c in (key, source))
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])  # whatever they are called, they pass
    # written first: where the sources are few, the planner sees it in time to spare the documents
    # a shuffle by source, of which one may have a third
    rates = source_rates(docs, source, weights, alpha, epoch).withColumn("mix_parts", poisson_parts(F.col("mix_rate")))
    rates = stage(rates.select("mix_source", "mix_parts", poisson_cdf(F.col("mix_rate") / F.col("mix_parts")).alias("mix_cdf")), "rates")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    keyed = docs.withColumn("mix_source", F.coalesce(F.col(f"`{source}`"), F.lit("")))
    n = poisson_count(seed, name, F.col("mix_parts"), F.col("mix_cdf"))
    # in two steps, so that no row holds more than a share of its document's copies; no copies, no row
    firsts = bound(n, lambda v: F.when(v > 0, F.transform(F.sequence(F.lit(0), F.floor((v - 1) / RUN).cast("int")), lambda j: F.struct((j * RUN).alias("lo"), (F.least(v, (j + 1) * RUN) - 1).alias("hi")))))
    rows = keyed.join(rates, "mix_source").withColumn("mix_run", F.explode_outer(firsts)).where("mix_run IS NOT NULL")
    rows = rows.withColumn("mix_copy", F.explode(F.sequence("mix_run.lo", "mix_run.hi")))
    order = F.substring(F.md5(F.concat(F.lit(f"{seed}-order:"), name, F.lit(":"), F.col("mix_copy").cast("string")).cast("binary")), 1, 16)
    rows = rows.withColumn("mix_order", order).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "mix_copy", "mix_order")
    if not shuffle:
        return rows
    return rows.repartition(F.col("mix_order")).sortWithinPartitions("mix_order")
