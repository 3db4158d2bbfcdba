"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents long, so similarity of whole sets says nothing; containment does.
Items are partitioned by their number of shingles, each partition an index of its own. An item's
sketch is the least hashes of its shingles (all of them in the smallest partitions); of an item
contained in a document to the threshold, that share of the sketch must be found among the
document's shingles, less what sampling allows for. A document with fewer shingles than a partition's
items need is not looked up there. Documents that find enough are verified by exact containment of the
item's whole shingle set, word by word.

Documents are read once and not shuffled. Items are taken in blocks of a bounded size.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import union_all

SHINGLE = 5
THRESHOLD = 0.8


@dataclass
class Block:
    """Items of one size partition: whole shingle sets and sketches, as values with offsets."""

    rows: np.ndarray  # index of the item in the list of ids
    sets: list[np.ndarray]
    need: np.ndarray  # sketch hashes to be found
    sketch: np.ndarray  # sorted hashes of all sketches
    owner: np.ndarray  # whose each is
    least: int  # shingles of a document that can contain one


def needed(size: int, sketch: int, threshold: float, deviations: float = 5.0) -> int:
    """Sketch hashes that a document must hold. Where the sketch is the whole set, exactly the
    threshold's share; else that share less ``deviations`` standard deviations of the sampling."""
    if size <= sketch:
        return max(1, math.ceil(threshold * size - 1e-9))
    sd = math.sqrt(sketch * threshold * (1 - threshold) * (size - sketch) / max(size - 1, 1))
    return max(1, math.floor(threshold * sketch - deviations * sd))


def size_partition(size: int) -> int:
    """Powers of two."""
    return max(1, size).bit_length()


def sketch_size(partition: int, least: int = 32) -> int:
    """More hashes for larger items, whose sketches sample more thinly."""
    return least + 4 * max(0, partition - 6)


def index(texts: list[str | None], k: int = SHINGLE, threshold: float = THRESHOLD) -> list[Block]:
    column = pa.array([t or "" for t in texts], pa.string())
    parts: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, _, buf, off in K.text_slices(column):
        starts, ends, wo = K.words(buf, off, K.NOT_ALNUM)
        h, so = K.shingles(K.word_hashes(buf, starts, ends, fold=True), wo, k)
        for d in range(len(off) - 1):
            s = np.unique(h[so[d] : so[d + 1]])
            if len(s):
                parts.setdefault(size_partition(len(s)), []).append((i + d, s))
    out = []
    for p, items in sorted(parts.items()):
        size, sets = sketch_size(p), [s for _, s in items]
        sketch = np.concatenate([s[:size] for s in sets])
        owner = np.repeat(np.arange(len(sets)), [min(size, len(s)) for s in sets])
        order = np.argsort(sketch, kind="stable")
        need = np.array([needed(len(s), size, threshold) for s in sets])
        out.append(Block(np.array([i for i, _ in items]), sets, need, sketch[order], owner[order], math.ceil(threshold * min(map(len, sets)) - 1e-9)))
    return out


def search(block: Block, h: np.ndarray, so: np.ndarray, at: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
    """(document, item) for the documents of a slice; ``at`` are the places of shingles worth a look."""
    doc = np.searchsorted(so, at, "right") - 1
    large = np.diff(so)[doc] >= block.least
    at, doc = at[large], doc[large]
    left = np.searchsorted(block.sketch, h[at], "left")
    count = np.searchsorted(block.sketch, h[at], "right") - left
    doc, left, count = doc[count > 0], left[count > 0], count[count > 0]
    if not len(doc):
        return
    slot = np.repeat(left, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    # a hash counts once, however often the document has it
    pairs = np.unique(np.stack([np.repeat(doc, count), slot]), axis=1)
    keys, n = np.unique(pairs[0] * len(block.need) + block.owner[pairs[1]], return_counts=True)
    d, item = np.divmod(keys, len(block.need))
    last, own = -1, None
    for d, item in zip(*(x[n >= block.need[item]] for x in (d, item)), strict=True):
        if d != last:
            last, own = d, np.unique(h[so[d] : so[d + 1]])
        s = block.sets[item]
        if int((own[np.minimum(np.searchsorted(own, s), len(own) - 1)] == s).sum()) >= threshold * len(s) - 1e-9:
            yield int(d), int(item)


def shingle_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves, of one text's words."""
    words = [K.FOLD[buf[x:y]].tobytes() for x, y in zip(starts.tolist(), ends.tolist(), strict=True)]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def blocks(items: DataFrame, item_text: str, item_key: str | None, most: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of the items, at most ``most`` characters of text at a time (or one item). There
    is one block at least."""
    ids, texts, size = [], [], 0
    key = F.lit(None).cast("string") if item_key is None else F.col(f"`{item_key}`")
    for r in items.select(key.alias("i"), F.col(f"`{item_text}`").alias("x")).toLocalIterator():
        if ids and size + len(r.x or "") > most:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r.i)
        texts.append(r.x)
        size += len(r.x or "")
    yield ids, texts


#: Searchers of this worker by the block they are for: a block's index is made where it is used, once.
_made: dict = {}


def searcher(name: str, texts: list, k: int, threshold: float):
    """A function from a text column to (row, item, item's shingles, shingles shared)."""
    if name in _made:
        return _made[name]
    parts = index(texts, k, threshold)
    every = np.concatenate([p.sketch for p in parts]) if parts else np.zeros(0, np.uint64)
    near = np.zeros(1 << max(16, min(24, 4 + len(every).bit_length())), bool)  # a bit for the low bits of every hash
    near[(every & K.U(len(near) - 1)).astype(np.int64)] = True
    items: dict[int, set] = {}

    def words_of(item: int) -> set:
        if item not in items:
            buf = np.frombuffer((texts[item] or "").encode(), np.uint8)
            starts, ends, _ = K.words(buf, np.array([0, len(buf)]), K.NOT_ALNUM)
            items[item] = shingle_words(buf, starts, ends, k)
        return items[item]

    def find(column: pa.Array) -> list[tuple[int, int, int, int]]:
        found = []
        for i, _, buf, off in K.text_slices(column):
            starts, ends, wo = K.words(buf, off, K.NOT_ALNUM)
            h, so = K.shingles(K.word_hashes(buf, starts, ends, fold=True), wo, k)
            at = np.flatnonzero(near[(h & K.U(len(near) - 1)).astype(np.int64)])
            hits = sorted((d, int(p.rows[item])) for p in parts for d, item in search(p, h, so, at, threshold)) if len(at) else []
            last, own = -1, set()
            for d, item in hits:  # few; verified on the words
                if d != last:
                    last, own = d, shingle_words(buf, starts[wo[d] : wo[d + 1]], ends[wo[d] : wo[d + 1]], k)
                want = words_of(item)
                shared = len(want & own)
                if shared >= threshold * len(want) - 1e-9:
                    found.append((i + d, item, len(want), shared))
        return found

    _made.clear()  # one at a time
    _made[name] = find
    return find


def find_contamination(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id",
                       k: int = SHINGLE, threshold: float = THRESHOLD, block_chars: int = 8 << 20) -> DataFrame:
    """A row (key, item_key, ``item_shingles``, ``shared``, ``containment``) for every document and
    item with at least ``threshold`` of the item's distinct k-word shingles in the document.

    Words are runs of ASCII letters and digits (A-Z as a-z) and all non-ASCII characters. A text
    of fewer than k words has its whole sequence as its one shingle; null and empty texts have none
    and match nothing. Rows are documents and items of their own, so repeated ones each match.
    Tables without rows give no rows. Other columns do not matter; if both keys have one name, the
    item's is called ``item_`` and that name. Texts of any length are taken whole. Items come to the driver
    as text, in blocks of at most ``block_chars`` (a longer item is a block of its own); their index
    is made by the workers, and each block is one pass over the documents.
    """
    kinds = [docs.schema[key].dataType, items.schema[item_key].dataType]
    schema = T.StructType([T.StructField("d", kinds[0]), T.StructField("i", T.LongType()), T.StructField("n", T.LongType()), T.StructField("s", T.LongType())])
    rows = docs.select(F.col(f"`{key}`").alias("d"), F.col(f"`{text}`").alias("x"))

    item_name = f"item_{item_key}" if item_key == key else item_key

    def one(ids: list, texts: list) -> DataFrame:
        name = uuid.uuid4().hex

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = searcher(name, texts, k, threshold)
            for b in batches:
                if found := find(b.column("x")):
                    cols = list(zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([b.column("d").take(pa.array(cols[0])), *(pa.array(np.array(c, np.int64)) for c in cols[1:])], ["d", "i", "n", "s"])

        named = docs.sparkSession.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("i", T.LongType()), T.StructField("id", kinds[1])]))
        return rows.mapInArrow(work, schema).join(F.broadcast(named), "i").select(  # as many names as the block has items
            F.col("d").alias(key), F.col("id").alias(item_name), F.col("n").alias("item_shingles"), F.col("s").alias("shared"), (F.col("s") / F.col("n")).alias("containment")
        )

    return union_all([one(*b) for b in blocks(items, item_text, item_key, block_chars)])


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", k: int = SHINGLE, threshold: float = THRESHOLD, block_chars: int = 8 << 20) -> DataFrame:
    """``docs`` without the rows that :func:`find_contamination` finds; no shuffle, all columns stay."""
    for _, texts in blocks(items, item_text, None, block_chars):
        name = uuid.uuid4().hex

        def work(batches: Iterator[pa.RecordBatch], name=name, texts=texts) -> Iterator[pa.RecordBatch]:
            find = searcher(name, texts, k, threshold)
            for b in batches:
                clean = np.ones(len(b), bool)
                clean[[f[0] for f in find(b.column("scanned_text"))]] = False
                kept = b.filter(pa.array(clean))
                yield kept.select(kept.schema.names[:-1])

        names = [f"c{i}" for i in range(len(docs.columns))]
        rows = docs.toDF(*names).withColumn("scanned_text", F.col(names[docs.columns.index(text)]))
        schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, docs.schema, strict=True)])
        docs = rows.mapInArrow(work, schema).toDF(*docs.columns)
    return docs
