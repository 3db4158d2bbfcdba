"""Substring dedup by de Bruijn compaction.

The graph is the sparse, minimiser-space one (a row per word for every token k-mer of the corpus would be
many times the input): its nodes are the token k-mers that windows of 50 words choose, at least one
in every window, and its edges lead from each to the next one in a text. Edges and nodes of one
document alone are dropped.

1. A k-mer is nonbranching if all its bundles (the words of the windows that choose it) are equal. Where
   such a one has a single repeated edge to the next, and that a single one into it, the edge is a
   path's; joins with doubled pointers give each node its unitig and its place there.
2. A document's places on one unitig and one diagonal, with a source on one diagonal, are a span: a
   row with its own and its source's coordinates, however many nodes long.
3. Spans are verified: the words at the source's coordinates are read again and digested, and the
   document's own words must have that digest.
4. At branching k-mers the bundles are expanded into their windows, and a join verifies each by the
   digest of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import drop_staged, stage, staged_mark, text_hash
from .unitigs import path_edges, unitigs
from .windows import LEAST_ID, MARKS, Words, binaries, candidates, covered, distinct_texts, joined, marks_of, of_text, runs, setup, window_rows

WINDOW, GRAM = 50, 12


#: Words of a text from which its ranges are digested together.
ZONE = 1 << 17


def graph(places: DataFrame, variants: DataFrame) -> DataFrame:
    """Edges (a, b, step) between recurring k-mers that are found in several documents. A k-mer that
    follows itself has an edge to itself."""
    edges = places.where("next IS NOT NULL").groupBy(F.col("h").alias("a"), F.col("next").alias("b"), "step")
    edges = edges.agg(F.min("m").alias("low"), F.max("m").alias("high")).where("low < high").select("a", "b", "step")
    loops = variants.where("loops > 1").select(F.col("h").alias("a"), F.col("h").alias("b"), F.lit(0).alias("step"))
    return edges.unionByName(loops).distinct()


def compact(places: DataFrame, variants: DataFrame) -> DataFrame:
    """The nonbranching k-mers (h, unitig, off, rank) with their source (g, from_k, from_pos)."""
    plain = variants.where("nv = 1").select("h", F.col("m").alias("g"), F.col("at.k").alias("from_k"), F.col("at.pos").alias("from_pos"))
    edges = path_edges(stage(graph(places, variants), "edges"))
    edges = edges.join(plain.select(F.col("h").alias("a")), "a", "left_semi").join(plain.select(F.col("h").alias("b")), "b", "left_semi")
    paths = unitigs(edges).withColumnRenamed("node", "h")
    nodes = plain.join(paths, "h", "left")
    return nodes.select("h", "g", "from_k", "from_pos", F.coalesce("unitig", "h").alias("unitig"), *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("off", "rank")))


def spans(places: DataFrame, nodes: DataFrame, window: int) -> DataFrame:
    """(k, m, lo, size, times, g, from_k, from_lo): stretches of documents along a unitig that stand in
    one stretch of an earlier document, in words."""
    met = places.join(nodes, "h").where("g < m")
    met = met.withColumn("own", F.col("pos") - F.col("off")).withColumn("theirs", F.col("from_pos") - F.col("off"))
    path = ["k", "m", "unitig", "own", "from_k", "g", "theirs"]
    met = met.withColumn("island", F.col("rank") - F.row_number().over(Window.partitionBy(*path).orderBy("rank")))
    found = met.groupBy(*path, "island").agg(F.min(F.col("pos") - F.col("far")).alias("lo"), F.max(F.col("pos") - F.col("near") + window).alias("hi"), F.max("times").alias("times"))
    lo = F.col("lo").cast("int")
    return found.select("k", "m", lo.alias("lo"), (F.col("hi") - F.col("lo")).cast("int").alias("size"), "times", "g", "from_k", (lo - F.col("own") + F.col("theirs")).cast("int").alias("from_lo"))


def proofs(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(from_k, g, from_lo, size, proof): digests of the words at the sources' coordinates."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in K.text_slices(b.column("x")):
                starts, ends, wo = K.words(buf, off)
                body, at = joined(buf, starts, ends)
                for d in range(j - i):
                    lo, size = (b.column("at")[i + d].values.field(c).to_numpy() for c in ("lo", "size"))
                    first = wo[d] + lo
                    keys = [pa.repeat(b.column(c)[i + d], len(lo)) for c in ("k", "m")]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array(lo), pa.array(size), binaries(K.digests(body, at[first], at[first + size]))], ["from_k", "g", "from_lo", "size", "proof"])

    ranges = found.select(F.col("from_k").alias("k"), F.col("g").alias("m"), F.col("from_lo").alias("lo"), "size").distinct()
    lists = ranges.groupBy("k", "m", F.floor(F.col("lo") / ZONE).alias("zone")).agg(F.collect_list(F.struct("lo", "size")).alias("at"))
    rows = of_text(texts.select("k", "m", "x"), lists, "inner", "m").select("k", "m", "x", "at")
    return rows.mapInArrow(work, "from_k long, g long, from_lo int, size int, proof binary")


def verdicts(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(k, m, at): for every text with windows that recur in another, what is known of its stretches."""
    places, variants = candidates(texts, Words, window, gram, across=True)
    variants = stage(variants, "nodes")
    found = stage(spans(places, stage(compact(places, variants), "unitigs"), window), "spans")
    proven = found.join(stage(proofs(texts, found), "proofs"), ["from_k", "g", "from_lo", "size"])
    proven = proven.select("k", "m", F.col("lo").alias("pos"), F.lit(0).alias("far"), (F.lit(window) - F.col("size")).alias("near"), "times", "g", F.lit(None).cast("array<struct<lo:int,hi:int,g:bigint>>").alias("some"), "proof")
    branching = variants.where("nv > 1")
    rows = stage(window_rows(texts, branching, Words, window), "windows")
    least = rows.groupBy("h", "o", "w").agg(F.min("m").alias("g"), F.max("m").alias("most")).where("g < most").select("h", "o", "w", "g")
    lower = rows.join(stage(least, "least"), ["h", "o", "w"]).where("g < m").groupBy("h", "seg").agg(runs().alias("some"))
    judged = branching.select("h", "seg", F.col("m").alias("g")).join(stage(lower, "lower"), ["h", "seg"], "left")
    single = places.join(stage(judged, "judged"), ["h", "seg"]).where("g < m OR some IS NOT NULL")
    single = single.select("k", "m", "pos", "far", "near", "times", "g", "some", F.lit(None).cast("binary").alias("proof"))
    return marks_of(proven.unionByName(single))


RESULT = "th binary, m long, kept_text string, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:bigint,length:bigint>>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def proven(marks: pa.StructArray, body: np.ndarray, at: np.ndarray, window: int) -> pa.StructArray:
    """The marks without those whose source's words are not the own ones."""
    proof = marks.field("proof")
    on = np.flatnonzero(proof.is_valid().to_numpy(zero_copy_only=False))
    if not len(on):
        return marks
    lo, near = (marks.field(c).to_numpy()[on] for c in ("pos", "near"))
    own = K.digests(body, at[lo], at[lo - near + window])
    ok = np.ones(len(marks), bool)
    ok[on] = [x == y for x, y in zip(own, proof.take(pa.array(on)).to_pylist(), strict=True)]
    return marks if ok.all() else marks.filter(pa.array(ok))


def cut(rows: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """Results for rows (th, m, x, at)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_gone, sha, spans, texts = [], [], [], [], []
            for i, j, buf, off in K.text_slices(b.column("x")):
                starts, ends, wo = K.words(buf, off)
                kept = np.ones(len(starts), bool)
                found = [d for d in range(j - i) if b.column("at")[i + d].is_valid]
                body, place = joined(buf, starts, ends) if found else (None, None)
                for d in found:
                    at = b.column("at")[i + d]
                    if len(at.values):
                        marks = proven(at.values, body, place[wo[d] : wo[d + 1] + 1], window)
                        kept[wo[d] : wo[d + 1]] = ~covered(marks, int(wo[d + 1] - wo[d]), window, b.column("m")[i + d].as_py())
                out, ends_at = joined(buf, starts[kept], ends[kept])
                oo = ends_at[np.concatenate([[0], np.cumsum(kept)])[wo]]
                for d in range(j - i):
                    gone = ~kept[wo[d] : wo[d + 1]]
                    edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))) if gone.any() else np.zeros(0, int)
                    body = out[oo[d] : max(oo[d], oo[d + 1] - 1)].tobytes()
                    n_words.append(len(gone))
                    n_gone.append(int(gone.sum()))
                    sha.append(hashlib.sha256(body).hexdigest())
                    spans.append([{"start": int(x), "length": int(y - x)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
                    texts.append(body.decode() if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("th"), b.column("m"), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, SPANS)],
                ["th", "m", "kept_text", "n_words", "n_removed", "kept_sha256", "spans"],
            )

    return rows.mapInArrow(work, RESULT)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, keep_text: bool = True) -> DataFrame:
    """A row per document: ``key``, ``kept_text``, ``n_words``, ``n_removed``, ``kept_sha256``, ``spans``.

    A word goes if a window of ``window`` consecutive words covers it whose words also start in a
    document with a smaller key; windows are judged on the input. Words are runs of other than space
    and tab to carriage return, unchanged; kept words are joined by one space. ``spans`` are the removed
    runs (start, length) in words. Null texts have no words. Rows with equal keys do not count
    against one another; a row without a key loses nothing and is no source. Rows of an equal text and
    a larger key lose all windows' words. An empty table gives no rows; other columns do not matter.
    Without ``keep_text`` the texts themselves are left out (null). A text is worked on whole; a long one
    of a short period costs no more than another.
    """
    setup(docs)
    mark = staged_mark()
    own = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("x"))
    keyed = own.where("key IS NOT NULL")
    texts = distinct_texts(keyed, "key", "x")
    marks = verdicts(texts, window, gram)
    found = stage(cut(of_text(texts, marks, "left", "m").select("th", "m", "x", "at"), window, keep_text), "results")
    drop_staged(docs.sparkSession, mark, found)
    rows = keyed.select("key", text_hash("x").alias("th")).join(found, "th")
    whole = (F.col("key") > F.col("m")) & (F.col("n_words") >= window)
    all_words = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("length")))
    rows = rows.select(
        F.col("key").alias(key),
        F.when(whole, F.when(F.lit(keep_text), "")).otherwise(F.col("kept_text")).alias("kept_text"),
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(whole, all_words).otherwise(F.col("spans")).alias("spans"),
    )
    free = own.where("key IS NULL").select(F.lit(b"").alias("th"), F.lit(LEAST_ID).alias("m"), F.coalesce("x", F.lit("")).alias("x"), F.lit(None).cast(f"array<{MARKS}>").alias("at"))
    free = cut(free, window, keep_text).select(F.lit(None).cast("bigint").alias(key), "kept_text", "n_words", "n_removed", "kept_sha256", "spans")
    return rows.unionByName(free)
