"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the bytes of whole texts. Trees are grown level by level on binned values and
flattened into arrays; scoring walks all trees of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import hash_sample

_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", b".,", b";:?'\"-()", b"!", b"*#", b"$%&@", b"|<>{}[]\\/_=+~^`")
CLASS = np.full(256, len(_CLASSES), np.uint8)  # other control bytes
for _i, _x in enumerate(_CLASSES):
    CLASS[list(_x)] = _i
CLASS[128:] = len(_CLASSES) + 1
N_CLASS = len(_CLASSES) + 2

STATISTICS = [f"share_{i}" for i in range(N_CLASS)] + ["log_bytes", "log_words", "log_lines", "word_length", "word_length_sd", "same_as_last", "distinct", "odd_end", "capitals", "words_per_line", "same_lines", "most_repeats"]


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each document of a slice; an empty one has zeros."""
    docs, size = len(off) - 1, np.diff(off)
    kind = CLASS[buf]
    if docs == 1:
        counts = np.bincount(kind, minlength=N_CLASS)[None].astype(np.float64)
    else:
        counts = np.bincount(np.repeat(np.arange(docs) * N_CLASS, size) + kind, minlength=docs * N_CLASS).reshape(docs, N_CLASS).astype(np.float64)
    starts, ends, wo = K.words(buf, off)
    wh = K.word_hashes(buf, starts, ends)
    n_words, of = np.diff(wo), np.repeat(np.arange(docs), np.diff(wo))
    per = np.maximum(n_words, 1)
    length = (ends - starts).astype(np.float64)
    mean = np.bincount(of, length, docs) / per
    sd = np.sqrt(np.maximum(np.bincount(of, length**2, docs) / per - mean**2, 0))
    same = np.zeros(len(wh), bool)
    same[1:] = (wh[1:] == wh[:-1]) & (of[1:] == of[:-1])
    bits = K.U(max(1, int(docs).bit_length()))
    keys = np.sort((of.astype(np.uint64) << (K.U(64) - bits)) | (wh >> bits))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    distinct = np.bincount((keys[new] >> (K.U(64) - bits)).astype(np.int64), minlength=docs) / per
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(keys)))
    most = np.zeros(docs)
    np.maximum.at(most, (keys[at] >> (K.U(64) - bits)).astype(np.int64), runs)
    odd = np.isin(kind[ends - 1], (8, 9, 10, 11)) if len(ends) else np.zeros(0, bool)
    up = (kind[starts] == 1) & (kind[np.minimum(starts + 1, max(len(buf) - 1, 0))] == 1) & (ends - starts > 1) if len(starts) else np.zeros(0, bool)
    lines = counts[:, 4] + 1
    # a line's hash, of all its bytes
    breaks = np.flatnonzero(buf == 10)
    ls = np.sort(np.concatenate([off[:-1], breaks + 1]))
    le = np.minimum(np.append(ls[1:], len(buf)), len(buf))
    ld = np.clip(np.searchsorted(off, ls, "right") - 1, 0, docs - 1)
    full = le - ls > 1
    lh = K.word_hashes(buf, ls[full], le[full])
    lk = np.sort((ld[full].astype(np.uint64) << (K.U(64) - bits)) | (lh >> bits))
    again = np.zeros(len(lk), bool)
    again[1:] = lk[1:] == lk[:-1]
    same_lines = np.bincount((lk[again] >> (K.U(64) - bits)).astype(np.int64), minlength=docs) / lines
    share = counts / np.maximum(size, 1)[:, None]
    count = lambda x: np.bincount(of, x, docs) / per
    return np.column_stack([share, np.log1p(size), np.log1p(n_words), np.log(lines), mean, sd, count(same), distinct, count(odd), count(up), n_words / lines, same_lines, most / per])


@dataclass
class Trees:
    """Flattened trees: node 0 of each is its root; a leaf points to itself."""

    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray
    child: np.ndarray  # of the left child; the right one follows it
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = self.child[trees, node] + go
        return 1 / (1 + np.exp(-np.clip(self.base + self.value[trees, node].sum(1), -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 2.0, least: float = 3.0) -> Trees:
    """Log-loss boosting on histograms. One class alone, or no rows, gives a constant."""
    n, f = x.shape
    p = (y.sum() + 1) / (n + 2) if n else 0.5
    base = float(np.log(p / (1 - p)))
    nodes = 2 ** (depth + 1) + 1
    out = Trees(*(np.zeros((trees, nodes), t) for t in (np.int64, float, np.int64, float)), base, depth)
    out.threshold[:] = np.inf
    out.child[:] = np.arange(nodes)
    if not n or y.min() == y.max():
        return out
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])  # bin b: x <= cut b
    flat = binned + np.arange(f) * bins
    z = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        used = 1
        live = [0]
        for _ in range(depth):
            slot = np.full(nodes, -1)
            slot[live] = np.arange(len(live))
            s = slot[node]
            on = np.flatnonzero(s >= 0)
            index = (s[on, None] * (f * bins) + flat[on]).ravel()
            hist = [np.bincount(index, np.repeat(v[on], f), len(live) * f * bins).reshape(len(live), f, bins) for v in (g, h)]
            gl, hl = np.cumsum(hist[0], 2), np.cumsum(hist[1], 2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (ht - hl < least)] = -1
            for j, c in enumerate(cuts):
                gain[:, j, len(c) :] = -1
            best = gain.reshape(len(live), -1).argmax(1)
            after = []
            for i, at in enumerate(live):
                j, b = divmod(int(best[i]), bins)
                if gain[i, j, b] <= 1e-6:
                    continue
                out.feature[t, at], out.threshold[t, at], out.child[t, at] = j, cuts[j][b], used
                mine = node == at
                node[mine] = used + (binned[mine, j] > b)
                after += [used, used + 1]
                used += 2
            live = after
            if not live:
                break
        sums = np.bincount(node, g, nodes), np.bincount(node, h, nodes)
        out.value[t] = -rate * sums[0] / (sums[1] + ridge)
        z += out.value[t][node]
    return out


def label_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, text: str, key: str, most: int) -> DataFrame:
    """(text, y) of the labelled rows under ``train``: at most ``most`` of them, by hash of the id.

    The sample's size is the bound that lets it be broadcast. Of rows that repeat an id, one counts.
    """
    rows = labels.where(train).where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("double").alias("y"))
    rows = hash_sample(rows.groupBy("k").agg(F.max("y").alias("y")), "k", most, "sample")
    return docs.select(F.col(key).alias("k"), F.col(text).alias("x")).join(F.broadcast(rows), "k").groupBy("k", "y").agg(F.min("x").alias("x")).select("k", "x", "y")


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column | None = None, text: str = "text", key: str = "doc_id", label: str = "quality", most: int = 20_000) -> Trees:
    """Fit on at most ``most`` labelled rows, whose statistics (not texts) come to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in K.text_slices(b.column("x")):
                x = statistics(buf, off)
                yield pa.record_batch({"k": b.column("k")[i:j].cast(pa.string()), "y": b.column("y")[i:j], "x": pa.array(list(x), pa.list_(pa.float64()))})

    sample = label_sample(docs, labels, label, F.lit(True) if train is None else train, text, key, most)
    found = sample.mapInArrow(work, "k string, y double, x array<double>").toArrow().sort_by([("k", "ascending"), ("y", "ascending")])
    x = np.array(found["x"].to_pylist(), float).reshape(-1, len(STATISTICS))
    return boost(x, found["y"].to_numpy().astype(float))


def score_rows(docs: DataFrame, scorer, text: str, keep: list[str], out: str) -> DataFrame:
    """``keep`` columns of ``docs`` and the double ``out`` = scorer(bytes, offsets) of ``text``."""
    keep = [c for c in keep if c != out]
    fields = [docs.schema[c] for c in keep]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("scored_text"))
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)] + [T.StructField("score", T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("scored_text")
            score = [scorer(buf, off) for _, _, buf, off in K.text_slices(column)]
            arrays = [b.column(f"c{i}") for i in range(len(keep))]
            names = [f"c{i}" for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.concatenate(score) if score else np.zeros(0), pa.float64())], [*names, "score"])

    return rows.mapInArrow(work, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("score").alias(out))


def score_quality(docs: DataFrame, model: Trees, text: str = "text", keep: list[str] | None = None, out: str = "quality_score") -> DataFrame:
    """``keep`` columns (all, by default) and ``out``, between 0 and 1, higher where label 1 is
    likelier. Every row is scored on its whole text alone: null and empty texts alike as texts of no
    words, repeated rows each. A column named ``out`` is replaced. No rows give no rows."""
    return score_rows(docs, lambda buf, off: model.score(statistics(buf, off)), text, docs.columns if keep is None else keep, out)
