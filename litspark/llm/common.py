"""Helpers shared by the training-data operators: staged tables, row keys, components."""

from __future__ import annotations

import threading
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import new_path, shared_dir
from ..shipping import send_package

#: Rows handed to a Python worker at once; documents can be long, so fewer than Spark's default.
ARROW_ROWS = 500

DOC_COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def prepare(spark: SparkSession, rows: int = ARROW_ROWS, bloom: bool = True) -> None:
    """Small Arrow batches, so that a worker's memory does not follow the longest documents; and
    this package for the executors' Python, wherever they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    # Spark's own Bloom filter before the shuffle, from smaller tables on; its size is bounded by
    # spark.sql.optimizer.runtime.bloomFilter.maxNumBits, and without it the join does all the work.
    # Each passes through the driver, once more with every stage that uses it: where all rows meet, none
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "32MB" if bloom else str(2**63 - 1))
    send_package(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at files that outlive any executor, and gives the planner a true size to
    decide on a broadcast. What the written plan shuffled is no longer referenced afterwards. Tasks
    are those of the plan, whose sizes AQE chooses behind a shuffle.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    staged().append((path, None))
    out = spark.read.schema(df.schema).parquet(path)
    out._litspark_path = path
    return out


_mine = threading.local()


def staged() -> list[tuple[str, str | None]]:
    """Paths (and table names) of what this thread has staged and not dropped: an operator runs in one
    thread, so that others' tables are not in its list."""
    if not hasattr(_mine, "tables"):
        _mine.tables = []
    return _mine.tables


def staged_mark() -> int:
    """To be given to :func:`drop_staged` later."""
    return len(staged())


def drop_staged(spark: SparkSession, mark: int, *keep: DataFrame) -> None:
    """Delete what was staged since ``mark``, but for the tables ``keep``. For an operator's end, when
    only these are still to be read."""
    kept, tables = {df._litspark_path for df in keep}, staged()
    for path, table in tables[mark:]:
        if path in kept:
            continue
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        _delete(spark, path)
    tables[mark:] = [(p, t) for p, t in tables[mark:] if p in kept]


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def selective(df: DataFrame, key: str) -> DataFrame:
    """Marks the few keys of a staged table as worth a runtime Bloom filter: Spark builds one only
    from a side that has a comparison on it. This one is true of every bigint."""
    return df.where(F.col(key) >= F.lit(-(2**63)))


def unstage(spark: SparkSession, df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    _delete(spark, df._litspark_path)
    staged()[:] = [x for x in staged() if x[0] != df._litspark_path]


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished jobs before the next heavy step."""
    spark.sparkContext._jvm.System.gc()


def stage_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As :func:`stage`, hashed by ``key``: later joins on it move only their other side."""
    spark = df.sparkSession
    n = partitions(spark)
    table = f"litspark_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/litspark/{table}"
    df.repartition(n, key).write.bucketBy(n, key).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(table)
    staged().append((path, table))
    return spark.table(table)


def hash_sample(rows: DataFrame, key: str, most: int, seed: str) -> DataFrame:
    """At most ``most`` rows, by hash of ``key``: the same ones however the table is partitioned.

    A threshold on the hash leaves a few times as many for the sort, whose size so does not follow the
    table's.
    """
    n = rows.count()
    if n > 8 * most:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(f"{seed} share"), key), F.lit(1 << 40)) < int((1 << 40) * 2.0 * most / n))
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_hash(text: Column | str) -> Column:
    """128 bits of the text; equal texts share every result, so this can stand for a row."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")))


def lower_ascii(c: Column) -> Column:
    """A-Z only; texts that are ASCII throughout take the quick way."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def crc_mod(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the undirected ``edges``: a row (node, component) for every node
    that has an edge, component being the smallest node reachable.

    Each round hooks every root to the smallest label around its tree and halves the paths, so
    rounds grow with the logarithm of the nodes; they go on until no label changes. Labels are written to
    the shared folder each round; nothing but a count comes to the driver.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = stage(pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    label = stage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("component")), "labels")
    while True:
        old = label
        lu = label.select(F.col("node").alias("u"), F.col("component").alias("lu"))
        lv = label.select(F.col("node").alias("v"), F.col("component").alias("lv"))
        # the smallest label next to each tree, offered to its root, and to the node itself
        near = both.join(lv, "v").groupBy("u").agg(F.min("lv").alias("lv")).join(lu, "u")
        offers = near.select(F.col("lu").alias("node"), "lv").unionAll(near.select(F.col("u").alias("node"), "lv"))
        hooked = label.unionAll(offers.select("node", F.col("lv").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
        hooked = stage(hooked, "labels")
        up = hooked.select(F.col("node").alias("component"), F.col("component").alias("above"))
        label = stage(hooked.join(up, "component").select("node", F.col("above").alias("component")), "labels")
        changed = label.join(old.select("node", F.col("component").alias("was")), "node").where("component <> was").limit(1).count()
        unstage(spark, hooked)
        unstage(spark, old)
        if not changed:
            return label


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
