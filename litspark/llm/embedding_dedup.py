"""Embedding near-dedup: an exact metric range join on the sphere.

Pivots partition the unit vectors: each is at home in the cell of its nearest pivot. By the
triangle inequality the way between two vectors of cells p and q is no shorter than their angles
to the great sphere halfway between the pivots together; so of two vectors within the angle t, one
is within t/2 of it. Vectors that near to a boundary are replicated into the cell behind it, and
cells join independently. A pair that meets in both cells counts in the lower one.

A cell's home vectors come in blocks of a bounded size, each a task's group, and the cell's other
vectors stream past a block; so neither a hot cell nor its visitors are held in memory. A group
sends sums of links and a spanning set of them, not all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, drop_staged, prepare, stage, staged_mark

#: Home vectors of a group, at least and at most; vectors to a pivot.
BLOCK, MOST_BLOCK, PER_PIVOT = 4096, 32768, 4000
#: A vector meets all pivots, so beyond PER_PIVOT times this many vectors their number grows with the
#: square root of the vectors' instead: the work of finding cells stays below that of joining them.
PIVOTS = 256


def unit(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors. Scaled by a power of two first, so no square is too great or too small for a double."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def usable(vectors: DataFrame, key: str, vector: str, kind: str) -> DataFrame:
    """(vec, dim, raw bytes) of rows that can link: with a key, finite components and a length."""
    kinds = T.StructType([T.StructField("vec", T.LongType()), T.StructField("dim", T.IntegerType()), T.StructField("raw", T.BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, v in enumerate(b.column("v")):
                if not v.is_valid or v.values.null_count or not len(v.values):
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(kind)
                if np.isfinite(x).all() and x.any():
                    rows.append((i, len(x), x.tobytes()))
            i, dim, raw = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("vec").take(pa.array(i, pa.int64())), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())], ["vec", "dim", "raw"])

    rows = vectors.select(F.col(f"`{key}`").cast("bigint").alias("vec"), F.col(f"`{vector}`").alias("v")).where("vec IS NOT NULL AND v IS NOT NULL")
    return rows.mapInArrow(work, kinds)


def visits(x: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell, and as packed bits the cells whose boundary is within half the angle (home included)."""
    sims = x @ pivots.T
    home = sims.argmax(1)
    apart = np.sqrt(np.maximum(((pivots[:, None] - pivots[None]) ** 2).sum(2), 1e-30))
    margin = (sims[np.arange(len(x)), home][:, None] - sims) / apart[home]
    near = margin <= reach + 1e-9
    near[np.arange(len(x)), home] = True
    return home.astype(np.int32), near


class Group:
    """A block of home vectors, past which the other vectors of the cell stream."""

    def __init__(self, cell: int, rows: dict[str, np.ndarray], x: np.ndarray, threshold: float):
        self.cell, self.rows, self.x, self.x32, self.threshold = cell, rows, x, x.astype(np.float32), threshold
        self.label = np.arange(len(x))
        self.links = np.zeros(len(x), np.int64)

    def join(self, rows: dict[str, np.ndarray], x: np.ndarray) -> tuple[list, list]:
        """Links of ``rows`` with the block; (id, links) of visitors and (id, id) edges."""
        own, sums, edges = self.rows, [], []
        for lo in range(0, len(x), 256):
            part = {k: v[lo : lo + 256] for k, v in rows.items()}
            y = x[lo : lo + 256]
            i, j = np.nonzero(y.astype(np.float32) @ self.x32.T >= np.float32(self.threshold - 1e-4))
            close = [np.zeros(0)] + [np.einsum("ij,ij->i", y[i[a : a + 65536]], self.x[j[a : a + 65536]]) for a in range(0, len(i), 65536)]
            ok = np.concatenate(close) >= self.threshold
            ok &= part["id"][i] != own["id"][j]
            visitor = part["home"][i] != self.cell
            at = part["home"][i]
            back = (own["cells"][j, at >> 3] >> (7 - (at & 7))) & 1  # it also visits the visitor's home
            ok &= ~visitor | (back == 0) | (self.cell < part["home"][i])
            i, j, visitor = i[ok], j[ok], visitor[ok]
            if not len(i):
                continue
            np.add.at(self.links, j, part["copies"][i])
            got = np.bincount(i[visitor], own["copies"][j[visitor]], len(y)).astype(np.int64)
            sums += [(part["id"][r], got[r]) for r in np.flatnonzero(got)]
            cut = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            for a, b in zip(cut, np.r_[cut[1:], len(i)], strict=True):
                labels = np.unique(self.label[j[a:b]])
                if len(labels) > 1:
                    self.label[np.isin(self.label, labels)] = labels[0]
                edges.append((part["id"][i[a]], own["id"][labels[0]]))
        return sums, edges

    def finish(self) -> tuple[list, list]:
        ids = self.rows["id"]
        on = np.flatnonzero(self.label != np.arange(len(ids)))
        return [(ids[r], self.links[r]) for r in np.flatnonzero(self.links)], [(ids[r], ids[self.label[r]]) for r in on]


def join_cells(rows: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(id, links, a, b): link sums and edges, from rows sorted by (grp, role), role 0 the block."""

    def out(sums: list, edges: list) -> pa.RecordBatch:
        n = len(sums) + len(edges)
        x = np.array([*sums, *edges], np.int64).reshape(n, 2)
        is_sum = np.arange(n) < len(sums)
        return pa.RecordBatch.from_arrays([pa.array(is_sum), pa.array(x[:, 0]), pa.array(x[:, 1])], ["is_sum", "a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, held = None, None, []

        def built() -> Group:
            rows = {k: np.concatenate([h[0][k] for h in held]) for k in held[0][0]}
            return Group(int(now[1]), rows, np.concatenate([h[1] for h in held]), threshold)

        for b in batches:
            cols = {k: b.column(k).to_numpy() for k in ("grp", "cell", "role", "id", "home", "copies")}
            cols["cells"] = np.frombuffer(b"".join(b.column("cells").to_pylist()), np.uint8).reshape(len(b), -1)
            x = unit(b.column("raw").to_pylist(), kind) if len(b) else np.zeros((0, 1))
            cut = np.flatnonzero(np.r_[True, (cols["grp"][1:] != cols["grp"][:-1]) | (cols["role"][1:] != cols["role"][:-1])]) if len(b) else []
            for lo, hi in zip(cut, [*cut[1:], len(b)], strict=True):
                part = {k: cols[k][lo:hi] for k in ("id", "home", "cells", "copies")}
                at = (cols["grp"][lo], cols["cell"][lo])
                if now is None or at[0] != now[0]:
                    if now is not None and held:
                        group = group or built()
                        yield out(*group.finish())
                    now, group, held = at, None, []
                if cols["role"][lo] == 0:
                    held.append((part, x[lo:hi]))
                elif held:
                    group = group or built()
                    yield out(*group.join(part, x[lo:hi]))
        if held:
            yield out(*(group or built()).finish())

    return rows.mapInArrow(work, "is_sum boolean, a long, b long")


def vectors_at_once(spark: SparkSession) -> int:
    """Tasks that the cluster runs side by side."""
    return max(1, spark.sparkContext.defaultParallelism)


def link_vectors(classes: DataFrame, kind: str, threshold: float) -> DataFrame:
    """Sums and edges among ``classes`` (id, raw, copies) of one dimension."""
    n = classes.count()
    k = max(1, n // PER_PIVOT)
    k = k if k <= PIVOTS else math.isqrt(k * PIVOTS)
    pivots = unit([bytes(r.raw) for r in classes.orderBy(F.xxhash64(F.lit("pivot"), "id")).select("raw").limit(k).collect()], kind)
    reach = math.sqrt((1 - threshold) / 2)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                home, near = visits(unit(b.column("raw").to_pylist(), kind), pivots, reach)
                cut = np.cumsum(near.sum(1))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, cut].astype(np.int32)), pa.array(np.nonzero(near)[1].astype(np.int32)))
                bits = pa.array([x.tobytes() for x in np.packbits(near, axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home), bits, lists], [*b.schema.names, "home", "cells", "visits"])

    placed = stage(classes.mapInArrow(work, "id long, raw binary, copies long, home int, cells binary, visits array<int>"), "placed")
    sizes = {r.home: r.n for r in placed.groupBy("home").agg(F.count("*").alias("n")).collect()}  # a row per pivot
    # every visitor goes to each block of its cell, so few and large ones spare copies; but enough for all cores
    block = min(MOST_BLOCK, max(BLOCK, n // (4 * vectors_at_once(classes.sparkSession))))
    blocks = [max(1, -(-sizes.get(p, 0) // block)) for p in range(k)]
    spread = F.element_at(F.array(*[F.lit(b) for b in blocks]), F.col("cell") + 1)
    own = F.pmod(F.xxhash64(F.lit("block"), "id"), spread).cast("int")
    rows = placed.withColumn("cell", F.explode("visits"))
    rows = rows.withColumn("own", F.when(F.col("home") == F.col("cell"), own).otherwise(-1)).withColumn("block", F.explode(F.sequence(F.lit(0), spread - 1)))
    every = rows.select((F.col("cell") * 1_000_000 + F.col("block")).cast("bigint").alias("grp"), "cell", F.lit(1).alias("role"), "id", "home", "cells", "copies", "raw")
    at_home = rows.where("own = block").select((F.col("cell") * 1_000_000 + F.col("block")).cast("bigint").alias("grp"), "cell", F.lit(0).alias("role"), "id", "home", "cells", "copies", "raw")
    dealt = every.unionAll(at_home).repartition(F.col("grp")).sortWithinPartitions("grp", "role")
    return join_cells(dealt, kind, threshold)


def link_embeddings(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """A row per vector: ``key``, ``n_links``, ``component_id``, ``kept``.

    Pairs with a cosine of at least ``threshold`` (above 0), in double precision, are linked, all of
    them and no others, however great or small their components. Vectors that are null, empty or zero, hold null or non-finite components, or
    have no key link with nothing; vectors of different lengths do not link with one another. Rows
    that repeat a key are vectors of their own. Equal vectors are joined once and counted as often
    as they occur. ``component_id`` is the smallest key reachable, ``kept`` whether that is the own.
    An empty table gives no rows; other columns do not matter.
    """
    spark = vectors.sparkSession
    prepare(spark, 2000)
    element = vectors.schema[vector].dataType.elementType
    kind = "f4" if isinstance(element, T.FloatType) else "f8"
    mark = staged_mark()
    good = stage(usable(vectors, key, vector, kind), "vectors")
    classes = good.groupBy("raw", "dim").agg(F.count("*").alias("copies"), F.min("vec").alias("rep"))
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    sums, edges = [], []
    for (dim,) in classes.select("dim").distinct().collect():  # as many as there are model sizes
        found = stage(link_vectors(classes.where(F.col("dim") == dim).select("id", "raw", "copies"), kind, threshold), "cells")
        sums.append(found.where("is_sum").select(F.col("a").alias("id"), F.col("b").alias("links")))
        edges.append(found.where("NOT is_sum").select("a", "b"))
    if not sums:
        drop_staged(spark, mark)
        return vectors.select(F.col(f"`{key}`").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col(f"`{key}`").cast("bigint").alias("component_id"), F.lit(True).alias("kept"))
    all_sums, all_edges = sums[0], edges[0]
    for s, e in zip(sums[1:], edges[1:], strict=True):
        all_sums, all_edges = all_sums.unionAll(s), all_edges.unionAll(e)
    labels = components(all_edges, "a", "b")
    reps = classes.select(F.col("id").alias("node"), "rep").join(labels, "node")
    least = reps.groupBy("component").agg(F.min("rep").alias("least"))
    named = reps.join(least, "component").select(F.col("node").alias("id"), "least")
    n = all_sums.groupBy("id").agg(F.sum("links").alias("links"))
    facts = classes.join(n, "id", "left").join(named, "id", "left")
    facts = stage(facts.select("raw", "dim", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "rep").alias("component_id")), "facts")
    drop_staged(spark, mark, good, facts)
    known = good.join(facts, ["raw", "dim"]).select(F.col("vec").alias(key), "n_links", "component_id")
    # the rest: rows that cannot link; a repeated key may have both kinds, so they are found by place
    rest = vectors.select(F.col(f"`{key}`").cast("bigint").alias(key), F.col(f"`{vector}`").alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    fine = F.col(key).isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda c: F.coalesce(c != 0, F.lit(False)))
    rest = rest.where(~F.coalesce(fine, F.lit(False))).select(key, F.lit(0).cast("bigint").alias("n_links"), F.col(key).alias("component_id"))
    return known.unionByName(rest).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
