"""Suffix-array dedup: bytes of long strings that occur anywhere else go.

Anchors deal the corpus into shards such that all places of a repeated string meet in one: the
anchor's. A shard's texts are the different bundles of its anchors; its suffix array is built by
induced sorting, and permuted common prefixes of the full length tell which strings are equal.
Anchors with one bundle need no array: it recurs whole. An anchor with very many different
bundles is dealt once more, by longer anchors inside them, until its shards are small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import drop_staged, stage, staged_mark, text_hash, union_all
from .suffix_array import permuted_prefixes, suffix_array
from .windows import Bytes, binaries, bundles, candidates, covered, distinct_texts, marks_of, of_text, setup, spots_of

WINDOW, GRAM = 200, 40
#: Bytes of a shard's text, and bundles of an anchor, beyond which they are dealt by a longer one.
SHARD, MOST_BUNDLES = 1 << 19, 6000
#: In UTF-8 no byte has this value.
BREAK = 0xFF


def bundle_bytes(texts: DataFrame, variants: DataFrame, window: int) -> DataFrame:
    """(h, seg, n, nv, lead, body): the bytes of each bundle, ``lead`` of them before its anchor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in K.text_slices(b.column("x")):
                doc, at = spots_of(b.column("at"), i, j)
                pos = at["pos"] + off[doc]
                lo, hi = pos - at["far"], pos - at["near"] + window
                body = binaries([buf[x:y].tobytes() for x, y in zip(lo, hi, strict=True)])
                yield pa.record_batch({"h": pa.array(at["h"]), "seg": binaries(at["seg"].tolist()), "n": pa.array(at["n"]), "nv": pa.array(at["nv"]), "lead": pa.array((pos - lo).astype(np.int32)), "body": body})

    return bundles(texts, variants, ["n", "nv"], (work, "h long, seg binary, n long, nv long, lead int, body binary"))


def repeated_in(h: np.ndarray, n: np.ndarray, lead: np.ndarray, bodies: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(bundle, o) of the strings, o bytes before the anchor, that another bundle of the anchor has too."""
    size = np.array([len(x) for x in bodies]) + 1
    end = np.cumsum(size)
    text = np.frombuffer(bytes([BREAK]).join(bodies) + bytes([BREAK]), np.uint8)
    sa = suffix_array(text)
    of = np.repeat(np.arange(len(bodies), dtype=np.int32), size)
    long = end[of] - 1 - np.arange(len(text)) >= window  # positions that a whole string begins at
    same = permuted_prefixes(text, sa, window, long)[sa] >= window
    of, fits = of[sa], long[sa]
    kind = np.cumsum(~same, dtype=np.int64)  # suffixes that begin with the same string are neighbours
    offset = lead[of] - (sa - (end - size)[of])
    ok = np.flatnonzero(fits & (offset >= 0))
    _, anchor = np.unique(h, return_inverse=True)
    key = (kind[ok] * (int(anchor.max()) + 1) + anchor[of[ok]]) * window + offset[ok]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    ok = ok[count[back] > 1]
    return of[ok], offset[ok]


SOME = "h long, seg binary, some array<struct<lo:int,hi:int,g:bigint>>"


def shard_verdicts(rows: DataFrame, window: int) -> DataFrame:
    """(h, seg, some) from bundles that come sorted by anchor."""

    def flush(t: pa.Table) -> pa.RecordBatch:
        h, n, lead = (t[c].to_numpy() for c in ("h", "n", "lead"))
        bundle, o = repeated_in(h, n, lead, t["body"].to_pylist(), window)
        order = np.lexsort((o, bundle))
        bundle, o = bundle[order], o[order]
        new = np.flatnonzero(np.r_[True, (bundle[1:] != bundle[:-1]) | (o[1:] != o[:-1] + 1)]) if len(o) else np.zeros(0, np.int64)
        last = np.append(new[1:], len(o)) - 1 if len(o) else new
        cut = np.searchsorted(bundle[new], np.arange(len(h) + 1)).astype(np.int32)
        edges = [pa.array(o[new].astype(np.int32)), pa.array(o[last].astype(np.int32)), pa.array(np.zeros(len(new), np.int64))]
        some = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays(edges, ["lo", "hi", "g"]))
        return pa.RecordBatch.from_arrays([pa.array(h), t["seg"].combine_chunks(), some], ["h", "seg", "some"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            h = b.column("h").to_numpy()
            if not len(h):
                continue
            if size > SHARD:
                last = held[-1].column("h")[len(held[-1]) - 1].as_py()
                first = int(np.argmax(h != last)) if (h != last).any() else len(h)
                if first < len(h):
                    yield flush(pa.Table.from_batches([*held, b.slice(0, first)]))
                    held, size, b = [], 0, b.slice(first)
            held.append(b)
            size += pc.sum(pc.binary_length(b.column("body"))).as_py()
        if held:
            yield flush(pa.Table.from_batches(held))

    return rows.mapInArrow(work, SOME)


def deeper(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Bundles dealt by a longer anchor inside them: (of, own, shift) and a bundle's columns.

    A window of a bundle (``of``, ``own``: its anchor and digest) chooses the least of its own
    ``gram``-byte strings. A window o bytes before the new anchor is ``shift`` + o before the old one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lead, n, of = (b.column(c).to_numpy() for c in ("lead", "n", "h"))
            for i, _, buf, off in K.text_slices(b.column("body")):
                s = Bytes(buf, off)
                pos, h, lo, hi, doc = K.anchors(s.sums, off, s.powers, window, gram, s.order(gram))
                if not len(pos):
                    continue
                row = i + doc
                h = K.mix(of[row].view(np.uint64) * K.U(0x9E3779B97F4A7C15) + h).view(np.int64)
                seg = [bytes([x & 255, x >> 8 & 255]) + d for x, d in zip((pos - lo).tolist(), s.digests(lo, hi + window), strict=True)]
                body = binaries([buf[x:y].tobytes() for x, y in zip(lo.tolist(), (hi + window).tolist(), strict=True)])
                shift = lead[row] - (pos - off[doc])
                yield pa.record_batch({"of": pa.array(of[row]), "own": b.column("seg").take(pa.array(row)), "shift": pa.array(shift.astype(np.int32)), "h": pa.array(h), "seg": binaries(seg), "n": pa.array(n[row]), "lead": pa.array((pos - lo).astype(np.int32)), "body": body})

    return rows.mapInArrow(work, "of long, own binary, shift int, h long, seg binary, n long, lead int, body binary")


def with_sizes(rows: DataFrame) -> DataFrame:
    return rows.join(stage(rows.groupBy("h").agg(F.count("*").alias("nv")), "sizes"), "h")


def judge(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(h, seg, some) of bundles with nv, the number of their anchor's, above 1."""
    dealt = rows.where(F.col("nv") <= MOST_BUNDLES).drop("nv").repartition(F.col("h")).sortWithinPartitions("h")
    found = [shard_verdicts(dealt, window).where(F.size("some") > 0)]
    many = rows.where(F.col("nv") > MOST_BUNDLES)
    # (the last deal is by whole strings: an anchor's bundles are then equal)
    if gram < window and many.limit(1).count():
        longer = min(window, gram + max(1, window // 5))
        inside = stage(deeper(many.drop("nv"), window, longer), "inside")
        each = stage(inside.groupBy("h", "seg").agg(F.sum("n").alias("n"), F.first("lead").alias("lead"), F.first("body").alias("body")), "inside_bundles")
        each = stage(with_sizes(each), "inside_sized")
        whole = F.array(F.struct((F.col("lead") - F.length("body") + window).alias("lo"), F.col("lead").alias("hi"), F.lit(0).cast("bigint").alias("g")))
        some = each.where("n > 1").select("h", "seg", whole.alias("some")).unionByName(judge(each.where("nv > 1"), window, longer))
        parts = inside.select("of", "own", "shift", "h", "seg").join(stage(some, "inside_some"), ["h", "seg"])
        parts = parts.select(F.col("of").alias("h"), F.col("own").alias("seg"), F.explode(F.transform("some", lambda r: F.struct((r["lo"] + F.col("shift")).alias("lo"), (r["hi"] + F.col("shift")).alias("hi"), r["g"].alias("g")))).alias("r"))
        found.append(parts.groupBy("h", "seg").agg(F.collect_list("r").alias("some")))
    return union_all(found)


def verdicts(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(k, m, at): what is known of each text's anchors; a g of 0 says its strings recur, 2 they don't."""
    places, variants = candidates(texts, Bytes, window, gram, across=False)
    variants = stage(variants, "bundles")
    differing = variants.where("nv > 1")
    many = differing.where(F.col("nv") > MOST_BUNDLES).limit(1).count()
    bodies = bundle_bytes(texts, differing, window)
    some = judge(stage(bodies, "bodies") if many else bodies, window, gram)
    g = F.when((F.col("nv") == 1) | (F.col("n") > 1), 0).otherwise(2).cast("bigint")
    out = variants.select("h", "seg", g.alias("g")).join(stage(some, "some"), ["h", "seg"], "left").where("g = 0 OR some IS NOT NULL")
    return marks_of(places.join(stage(out, "verdicts"), ["h", "seg"]))


def cut(rows: DataFrame, window: int, keep_bytes: bool) -> DataFrame:
    """Results for rows (th, n, x, at); a text that occurs n > 1 times goes whole, if long enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, j, buf, off in K.text_slices(b.column("x")):
                for d in range(j - i):
                    own, at = buf[off[d] : off[d + 1]], b.column("at")[i + d]
                    if b.column("n")[i + d].as_py() > 1 and len(own) >= window:
                        gone = np.ones(len(own), bool)
                    else:
                        gone = covered(at.values if at.is_valid else None, len(own), window, 1)
                    edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))) if gone.any() else np.zeros(0, int)
                    body = own[~gone].tobytes() if len(edge) else own.tobytes()
                    spans = [{"start": int(x), "length": int(y - x)} for x, y in zip(edge[::2], edge[1::2], strict=True)]
                    out.append((body if keep_bytes else None, len(own), int(gone.sum()), hashlib.sha256(body).hexdigest(), spans))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([b.column("th"), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], ["th", "kept", "n_bytes", "n_removed", "kept_sha256", "spans"])

    return rows.mapInArrow(work, "th binary, kept binary, n_bytes long, n_removed long, kept_sha256 string, spans array<struct<start:bigint,length:bigint>>")


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, keep_bytes: bool = True) -> DataFrame:
    """A row per document: ``key``, ``kept`` (binary), ``n_bytes``, ``n_removed``, ``kept_sha256``, ``spans``.

    Of each whole text as UTF-8, every byte goes that a string of ``window`` bytes covers which also
    starts anywhere else, in another document or the same one, overlapping or not; all places lose
    theirs, and strings are judged on the input. ``spans`` are the maximal removed runs (start,
    length). Null texts are empty; rows are documents of their own whatever their keys, so repeated
    rows lose all they have from ``window`` bytes on. An empty table gives no rows; other columns do
    not matter. Without ``keep_bytes`` the bytes themselves are left out (null). A text is worked on whole,
    a megabyte at a time; a long text of a short period costs no more than another, as its equal
    neighbouring anchors are one row. Strings count as equal by the suffix array; whole bundles by 128-bit
    digests of their bytes.
    """
    setup(docs)
    mark = staged_mark()
    own = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("x"))
    numbered = own if "int" in own.schema["key"].dataType.simpleString() else own.withColumn("key", F.xxhash64("key"))
    texts = distinct_texts(numbered, "key", "x")
    marks = verdicts(texts, window, gram)
    found = stage(cut(of_text(texts, marks, "left", "m").select("th", "n", "x", "at"), window, keep_bytes), "results")
    drop_staged(docs.sparkSession, mark, found)
    return own.select("key", text_hash("x").alias("th")).join(found, "th").select(F.col("key").alias(key), "kept", "n_bytes", "n_removed", "kept_sha256", "spans")
