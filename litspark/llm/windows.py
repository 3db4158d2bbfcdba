"""Repeated windows of a corpus, exactly, from winnowed anchors.

Every window of W symbols chooses an anchor, a k-gram of it, by its own symbols alone, so all places
where a window occurs have the same anchor at the same offset. Anchors that occur once are
dropped. The neighbouring windows that choose an anchor at a place make up its bundle. Equal bundles
(by a 128-bit digest of their bytes) are one variant; an anchor with one variant needs no further
look, and only variants of the others are read from the texts again.

In a text of a short period each place is like the one before; such a run is one row, with the number
of ``times``. So a text has a row for every few dozen symbols at most, and the lists that are gathered
for a text are bounded by its own length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import prepare, release, selective, stage, stage_bucketed, text_hash, unstage

LEAST_ID = -(2**63)


class Bytes:
    """The bytes of a slice as symbols; ``off`` are the documents' offsets."""

    powers = K.P_BYTE

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off = buf, off
        self.sums = K.byte_sums(buf)

    def order(self, k: int) -> np.ndarray | None:
        return K.byte_order(self.buf, k)

    def digests(self, lo: np.ndarray, hi: np.ndarray) -> list[bytes]:
        return K.digests(self.buf, lo, hi)


class Words:
    """The words of a slice as symbols."""

    powers = K.P_WORD

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.starts, self.ends, self.off = K.words(buf, off)
        self.buf = buf
        self.sums = K.prefix(K.word_hashes(buf, self.starts, self.ends))

    def order(self, k: int) -> np.ndarray | None:
        return None

    def digests(self, lo: np.ndarray, hi: np.ndarray) -> list[bytes]:
        """Of words ``lo`` to ``hi``, each with a space behind it."""
        if "joined" not in self.__dict__:
            self.joined, self.at = joined(self.buf, self.starts, self.ends)
        return K.digests(self.joined, self.at[lo], self.at[hi])


Symbols = type[Bytes] | type[Words]


def joined(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, each with a space behind it, and where each begins (and the last one's end)."""
    size = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.append(buf, np.uint8(0x20))[np.repeat(starts - at[:-1], size) + np.arange(at[-1])]
    out[at[1:] - 1] = 0x20
    return out, at


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def of_text(texts: DataFrame, facts: DataFrame, how: str, *also: str) -> DataFrame:
    """``texts`` with the ``facts`` of equal k and columns ``also``, as a 64-bit k alone could be that of two.

    Those are compared as a range, which the planner does not take for join keys: so the join stays
    on the one column that texts are bucketed by, and they do not move.
    """
    named = facts.select(*[F.col(c).alias(f"its_{c}" if c in ("k", *also) else c) for c in facts.columns])
    on = F.col("k") == F.col("its_k")
    for c in also:
        on &= F.col(c).between(F.col(f"its_{c}"), F.col(f"its_{c}"))
    return texts.join(named, on, how).drop("its_k", *(f"its_{c}" for c in also))


def distinct_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row (k, th, m, n, x) per different text, bucketed by k: m is its least key (null keys as the
    least long), n its number of rows."""
    spark = docs.sparkSession
    rows = docs.select(
        text_hash(F.col(f"`{text}`")).alias("th"), F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(LEAST_ID)).alias("m"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("x")
    )
    per = rows.groupBy("th", "m").agg(F.count("*").alias("c")).groupBy("th").agg(F.min("m").alias("m"), F.sum("c").alias("n"), F.min_by("c", "m").alias("same"))
    facts = stage(per.withColumn("k", F.xxhash64("th", "m")), "facts")
    every = stage_bucketed(rows.withColumn("k", F.xxhash64("th", "m")), "texts", "k")
    release(spark)
    texts = of_text(every, facts.select("k", "th", "m", "n"), "inner", "th", "m")
    if facts.where("same > 1").limit(1).count():  # rows that repeat both key and text
        texts = texts.dropDuplicates(["k", "th", "m"])
    return texts.select("k", "th", "m", "n", "x")


def pieces(symbols: Symbols, buf: np.ndarray, off: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A long document's bytes in pieces that share all but one byte of a window, so each window is in
    one piece. An anchor at a border has a bundle in both. Words are few enough to take at once."""
    if symbols is not Bytes or len(buf) <= 4 * K.PIECE:
        yield 0, buf, off
        return
    for at in range(0, len(buf) - window + 1, K.PIECE):
        part = buf[at : at + K.PIECE + window - 1]
        yield at, part, np.array([0, len(part)])


ANCHORS = "h long, seg binary, k long, m long, pos int, far int, near int, times int, next long, step int"


def anchor_rows(texts: DataFrame, symbols: Symbols, window: int, gram: int) -> DataFrame:
    """Every anchor (h, seg, k, m, pos, far, near, times, next, step) with its bundle's digest.

    The bundle's windows start ``far`` to ``near`` symbols before it; it stands ``times`` times,
    far - near + 1 symbols apart. ``next`` is the anchor that follows, ``step`` symbols behind the last
    (null at a text's end).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, _, buf, off in K.text_slices(b.column("x")):
                for at, part, bounds in pieces(symbols, buf, off, window):
                    s = symbols(part, bounds)
                    pos, h, lo, hi, doc = K.anchors(s.sums, s.off, s.powers, window, gram, s.order(gram))
                    if not len(pos):
                        continue
                    far, near = pos - lo, pos - hi
                    own = K.span_hash(s.sums, lo, hi + window, s.powers)
                    new = np.r_[True, (h[1:] != h[:-1]) | (own[1:] != own[:-1]) | (far[1:] != far[:-1]) | (near[1:] != near[:-1]) | (doc[1:] != doc[:-1])]
                    first = np.flatnonzero(new)
                    times = np.diff(np.append(first, len(pos)))
                    last = first + times - 1
                    after = np.minimum(last + 1, len(pos) - 1)
                    ends = (after == last) | (doc[after] != doc[last])
                    follow = pa.array(h[after].view(np.int64), mask=ends), pa.array((pos[after] - pos[last]).astype(np.int32), mask=ends)
                    pos, h, lo, hi, far, near, doc = (x[first] for x in (pos, h, lo, hi, far, near, doc))
                    seg = np.frombuffer(b"".join(s.digests(lo, hi + window)), np.uint64).reshape(-1, 2).copy()
                    seg[:, 0] ^= K.mix((far.astype(np.uint64) << K.U(32)) | near.astype(np.uint64))
                    row = pa.array(i + doc)
                    numbers = (pa.array(x.astype(np.int32)) for x in (at + pos - s.off[doc], far, near, times))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), binaries([x.tobytes() for x in seg]), b.column("k").take(row), b.column("m").take(row), *numbers, *follow],
                        ["h", "seg", "k", "m", "pos", "far", "near", "times", "next", "step"],
                    )

    return texts.mapInArrow(work, ANCHORS)


def candidates(texts: DataFrame, symbols: Symbols, window: int, gram: int, across: bool) -> tuple[DataFrame, DataFrame]:
    """Places of anchors that recur, and their variants (h, seg, n, m, most, at, nv); ``at`` is the place
    of the least m.

    With ``across``, anchors must recur in texts of different m; else the columns that only the
    graph needs are left out.
    """
    rows = anchor_rows(texts, symbols, window, gram)
    places = stage(rows if across else rows.drop("next", "step"), "anchors")
    if across:
        again = places.groupBy("h").agg(F.min("m").alias("a"), F.max("m").alias("b")).where("a < b").select("h")
    else:
        again = places.groupBy("h").agg(F.sum("times").alias("n")).where("n > 1").select("h")
    found = stage(places.join(selective(stage(again, "recurring"), "h"), "h", "left_semi"), "places")
    unstage(places.sparkSession, places)
    release(places.sparkSession)
    variants = found.groupBy("h", "seg").agg(F.sum("times").alias("n"), F.min("m").alias("m"), F.max("m").alias("most"), F.max("times").alias("loops"), F.min(F.struct("m", "k", "pos", "far", "near")).alias("at"))
    variants = stage(variants, "variants")
    sizes = stage(variants.groupBy("h").agg(F.count("*").alias("nv")), "sizes")
    return found, variants.join(sizes, "h")


def bundles(texts: DataFrame, variants: DataFrame, facts: list[str], work) -> DataFrame:
    """``work`` over the texts that variants were first found in: rows (x, at), ``at`` the list of pos,
    far, near, h, seg and ``facts``, one for every few dozen symbols of the text at most."""
    spots = variants.select("at.k", "at.m", F.struct("at.pos", "at.far", "at.near", "h", "seg", *facts).alias("at")).groupBy("k", "m").agg(F.collect_list("at").alias("at"))
    return of_text(texts.select("k", "m", "x"), spots, "inner", "m").select("x", "at").mapInArrow(*work)


def spots_of(column: pa.Array, i: int, j: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Document in the slice, and the fields, of the structs listed in rows i to j."""
    part = column.slice(i, j - i)
    size = pc.list_value_length(part).to_numpy()
    flat = part.flatten()
    return np.repeat(np.arange(j - i), size), {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}


def window_rows(texts: DataFrame, variants: DataFrame, symbols: Symbols, window: int) -> DataFrame:
    """(h, seg, o, w, n, m): each window of each variant, by digest; it starts o before the anchor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in K.text_slices(b.column("x")):
                sym = symbols(buf, off)
                doc, at = spots_of(b.column("at"), i, j)
                pos = at["pos"] + sym.off[doc]
                for lo in range(0, len(pos), 1 << 11):
                    far, near = (at[x][lo : lo + (1 << 11)].astype(np.int64) for x in ("far", "near"))
                    each = far - near + 1
                    r = lo + np.repeat(np.arange(len(each)), each)
                    o = np.repeat(far, each) - (np.arange(len(r)) - np.repeat(np.cumsum(each) - each, each))
                    s = pos[r] - o
                    own = {"h": pa.array(at["h"][r]), "seg": binaries(at["seg"][r].tolist()), "o": pa.array(o.astype(np.int32)), "w": binaries(sym.digests(s, s + window))}
                    yield pa.record_batch(own | {x: pa.array(at[x][r]) for x in ("n", "m")})

    return bundles(texts, variants, ["n", "m"], (work, "h long, seg binary, o int, w binary, n long, m long"))


def runs(o: str = "o", g: str = "g") -> Column:
    """An aggregate: the windows' (o, g) as runs (lo, hi, g) of neighbours with one g."""
    rows = F.array_sort(F.collect_list(F.struct(o, g)))

    def edge(other: int) -> Callable[[Column], Column]:
        def of(x: Column) -> Column:
            first = F.filter(x, lambda e, i: F.coalesce(F.get(x, i + other)["o"] != e["o"] + other, F.lit(True)) | F.coalesce(F.get(x, i + other)["g"] != e["g"], F.lit(True)))
            return first

        return of

    ends = F.arrays_zip(edge(-1)(rows).alias("a"), edge(1)(rows).alias("b"))
    return F.transform(ends, lambda e: F.struct(e["a"]["o"].alias("lo"), e["b"]["o"].alias("hi"), e["a"]["g"].alias("g")))


MARKS = "struct<pos:int,far:int,near:int,times:int,g:bigint,some:array<struct<lo:int,hi:int,g:bigint>>,proof:binary>"


def marks_of(rows: DataFrame) -> DataFrame:
    """(k, m, at): a text's marks, from rows with its k and m and the fields of MARKS."""
    names = [f for f in ("pos", "far", "near", "times", "g", "some", "proof") if f in rows.columns]
    return stage(rows.groupBy("k", "m").agg(F.collect_list(F.struct(*names)).alias("at")), "marks")


def covered(marks: pa.StructArray | None, n: int, window: int, m: int) -> np.ndarray:
    """Which of a text's n symbols lie in a window known to start in a text of a key below m.

    A mark holds for the whole bundle of the anchor at ``pos``, all of its times, if its ``g`` is below
    m, and for the runs of windows in ``some`` whose own g is.
    """
    change = np.zeros(n + 1, np.int64)
    if marks is None or not len(marks) or n < window:
        return np.zeros(n, bool)
    pos, far, near, times, g = (marks.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("pos", "far", "near", "times", "g"))
    step = far - near + 1
    whole = g < m
    np.add.at(change, (pos - far)[whole], 1)
    np.add.at(change, (pos + (times - 1) * step - near)[whole] + window, -1)
    some = marks.field("some").fill_null([])
    flat = some.flatten()
    if len(flat):
        of = np.repeat(np.arange(len(pos)), pc.list_value_length(some).to_numpy())
        of, hi, lo = (x[flat.field("g").to_numpy() < m] for x in (of, flat.field("hi").to_numpy(), flat.field("lo").to_numpy()))
        each = times[of]  # once for every time that the bundle stands there
        turn = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        of, hi, lo = (np.repeat(x, each) for x in (of, hi, lo))
        at = pos[of] + turn * step[of]
        np.add.at(change, at - hi, 1)
        np.add.at(change, at - lo + window, -1)
    return np.cumsum(change)[:n] > 0


def setup(docs: DataFrame) -> None:
    prepare(docs.sparkSession)
