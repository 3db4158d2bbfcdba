"""Tables written to the folder that all executors share, so that they are computed once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Only where it is unset and all of Spark is in this
    process (tests), a temporary one; on a cluster other machines couldn't see that."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = getattr(spark, "_litspark_dir", None) or tempfile.mkdtemp(prefix="litspark-")
        spark._litspark_dir = found
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/litspark/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written out and read back: whatever reads them, they are computed this once. The files
    stay in the shared folder, for as long as results are read from them."""
    path = new_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def running(rows: DataFrame, order: str, **sums: Column) -> DataFrame:
    """``rows`` with running sums in the order of ``order`` over the whole table, by name: an expression each.

    The table is dealt in ranges, one a task; each has its own running sums, to which those of the ranges
    before, a row each, are added. No task has more than a range.
    """
    given = rows.select(F.struct("*").alias("row"), F.col(order).alias("place"), *[x.alias(f"own_{n}") for n, x in sums.items()])
    ranges = written(given.repartitionByRange(F.col("place")).withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("part").agg(*[F.sum(f"own_{n}").alias(f"all_{n}") for n in sums])  # as many rows as ranges
    starts = totals.select("part", *[F.coalesce(F.sum(f"all_{n}").over(before), F.lit(0)).alias(f"from_{n}") for n in sums])
    own = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    out = ranges.withColumns({f"to_{n}": F.sum(f"own_{n}").over(own) for n in sums}).join(starts, "part")
    return out.select("row", *[(F.col(f"to_{n}") + F.col(f"from_{n}")).alias(n) for n in sums]).select("row.*", *sums)


def numbered(rows: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """``rows`` with their number among those of one ``key``, in the order of ``order``; none without a key.

    As in :func:`running`, a key's rows are numbered by ranges, so that a key of very many rows is no single
    task's; what a key has in the ranges before, a row for each range, is added.
    """
    given = rows.select(F.struct("*").alias("row"), F.col(key).alias("its_key"), F.col(order).alias("place"))
    ranges = written(given.repartitionByRange(F.col("place")).withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("its_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    n = ranges.where("its_key IS NOT NULL").groupBy("its_key", "part").agg(F.count("*").alias("n"))
    starts = n.select("its_key", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("its_key", "part").orderBy("place"))
    out = ranges.withColumn("own", own).join(starts, ["its_key", "part"], "left")
    return out.select("row.*", (F.col("own") + F.col("start")).alias(name))
