"""Unitigs of a directed graph: its maximal nonbranching paths, by joins with doubled pointers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, union_all


def path_edges(edges: DataFrame) -> DataFrame:
    """Of distinct edges (a, b, step), those that are the only one out of a and the only one into b."""
    out = edges.groupBy("a").agg(F.count("*").alias("n")).where("n = 1").select("a")
    into = edges.groupBy("b").agg(F.count("*").alias("n")).where("n = 1").select("b")
    return edges.where("a <> b").join(out, "a", "left_semi").join(into, "b", "left_semi")


def unitigs(edges: DataFrame) -> DataFrame:
    """(node, unitig, off, rank) for every node of the path edges (a, b, step): the path's first node,
    the sum of the steps from there, and their number.

    A node has at most one edge in and one out. Each round every open pointer takes over the one at
    its end, so rounds grow with the logarithm of the longest path. In each round the open node
    nearest to a path's head is settled; where none is, all that are open lie on cycles, which are
    cut in front of their least node.
    """
    edges = stage(edges.select("a", "b", F.col("step").cast("bigint").alias("step")), "path_edges")
    zero = F.lit(0).cast("bigint")
    none = F.lit(None).cast("bigint").alias("least")
    heads = edges.select(F.col("a").alias("node")).join(edges.select(F.col("b").alias("node")), "node", "left_anti")
    settled = [stage(heads.select("node", F.col("node").alias("to"), zero.alias("off"), zero.alias("rank")), "heads")]
    # least: the least node from the own one to the one before the pointer's end
    opened = edges.select(F.col("b").alias("node"), F.col("a").alias("to"), F.col("step").alias("off"), F.lit(1).cast("bigint").alias("rank"), F.col("b").alias("least"))
    left = opened.count()
    while left:
        every = union_all([s.select("*", none, F.lit(True).alias("end")) for s in settled] + [opened.withColumn("end", F.lit(False))])
        beyond = every.select(F.col("node").alias("to"), F.col("to").alias("its_to"), F.col("off").alias("its_off"), F.col("rank").alias("its_rank"), F.col("least").alias("its_least"), "end")
        moved = opened.join(beyond, "to").select(
            "node", F.col("its_to").alias("to"), (F.col("off") + F.col("its_off")).alias("off"), (F.col("rank") + F.col("its_rank")).alias("rank"),
            F.least("least", "its_least").alias("least"), "end", (F.col("its_least") < F.col("least")).alias("lower"),
        )
        moved = stage(moved, "pointers")
        settled.append(moved.where("end").select("node", "to", "off", "rank"))
        opened, before = moved.where("NOT end").select("node", "to", "off", "rank", "least"), left
        left = opened.count()
        if left == before and not moved.where("lower").limit(1).count():
            cycles = edges.join(opened.where("node <> least").select(F.col("node").alias("b")), "b", "left_semi")
            return union_all([named(s) for s in settled] + [unitigs(cycles)])
    return union_all([named(s) for s in settled])


def named(settled: DataFrame) -> DataFrame:
    return settled.select("node", F.col("to").alias("unitig"), "off", "rank")
