"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

A linear classifier learns from confirmed toxic texts and unlabelled ones. Its risk is
prior * E_P[loss+] + max(0, E_U[loss-] - prior * E_P[loss-]); where the second part falls below
zero, that part is ascended instead, which keeps the fit from explaining unlabelled toxic texts
away. Features are hashed words and word beginnings, present or not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import drop_staged, hash_sample, stage, staged_mark
from .quality import score_rows

BITS = 20
#: Word beginnings, in bytes, that are features beside whole words.
BEGINNINGS = (4, 5, 6)


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature) of every word and beginning in a slice, repeats included; words of each."""
    starts, ends, wo = K.words(buf, off, K.NOT_LETTER)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(wo))
    docs, feats = [doc], [K.word_hashes(buf, starts, ends, fold=True) >> K.U(64 - BITS)]
    for k in BEGINNINGS:
        longer = ends - starts > k
        docs.append(doc[longer])
        feats.append(K.word_hashes(buf, starts[longer], starts[longer] + k, fold=True) * K.U(2 * k + 1) >> K.U(64 - BITS))
    return np.concatenate(docs), np.concatenate(feats).astype(np.int64), np.diff(wo)


def level(feat: np.ndarray, i: int) -> np.ndarray:
    """The feature that stands for ``feat`` reaching level i."""
    return (feat * 2654435761 + i * 40503) & ((1 << BITS) - 1) if i else feat


#: A feature counts as present, as found so many times, and as so great a share of the words.
TIMES, SHARES = (2, 4, 8), (1 / 256, 1 / 64)
LEVELS = range(1 + len(TIMES) + len(SHARES))


def present(doc: np.ndarray, feat: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) for every level reached, by document."""
    keys, times = np.unique(doc * (1 << BITS) + feat, return_counts=True)
    doc, feat = keys >> BITS, keys & ((1 << BITS) - 1)
    reached = [np.ones(len(keys), bool)] + [times >= n for n in TIMES] + [(times >= 2) & (times >= x * n_words[doc]) for x in SHARES]
    doc, feat = np.concatenate([doc[x] for x in reached]), np.concatenate([level(feat[x], i) for i, x in enumerate(reached)])
    keys = np.unique(doc * (1 << BITS) + feat)
    return keys >> BITS, keys & ((1 << BITS) - 1)


@dataclass
class Linear:
    feature: np.ndarray  # sorted
    weight: np.ndarray
    bias: float

    def score(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        table = self.__dict__.get("table")
        if table is None:
            table = np.zeros(1 << BITS)
            table[self.feature] = self.weight
            every = np.arange(1 << BITS)
            self.__dict__["table"], self.__dict__["useful"] = table, np.any([table[level(every, i)] != 0 for i in LEVELS], axis=0)
        doc, feat, n_words = features(buf, off)
        hit = np.flatnonzero(self.__dict__["useful"][feat])
        doc, feat = present(doc[hit], feat[hit], n_words)
        z = self.bias + np.bincount(doc, table[feat], len(off) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "useful")}


def counted(docs: np.ndarray, feats: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Texts with each feature, of the others and of the positive ones."""
    df = np.zeros((2, 1 << BITS), np.int64)
    for lo in range(0, len(feats), 1 << 21):  # in parts, for the memory that counting takes
        own, f = positive[docs[lo : lo + (1 << 21)]], feats[lo : lo + (1 << 21)]
        for side in (0, 1):
            df[side] += np.bincount(f[own == side], minlength=1 << BITS)
    return df


def choose(df: np.ndarray, texts: tuple[int, int], prior: float, most: int, least: int = 2) -> np.ndarray:
    """Features commoner in the positive texts than the prior-corrected share in the others says.

    The excess is measured in the spread that the others' share alone would give, so that ``least``
    bounds the support and no larger number of texts does.
    """
    n = np.maximum(1, np.array(texts))
    p, u = df[1] / n[1], df[0] / n[0]
    neg = np.maximum(u - prior * p, 0) / (1 - prior)  # the others' own share
    lift = (p - neg) / np.sqrt(np.maximum(neg, 1 / n[0]) * (1 / n[0] + 1 / n[1]))
    found = np.flatnonzero((df[1] >= least) & (lift > 6) & (p > 3 * neg))
    return np.sort(found[np.argsort(-lift[found], kind="stable")[:most]])


def select(docs: np.ndarray, feats: np.ndarray, positive: np.ndarray, prior: float, most: int, least: int = 2) -> np.ndarray:
    return choose(counted(docs, feats, positive), ((~positive).sum(), positive.sum()), prior, most, least)


def risk(z: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The two parts of the risk at the scores ``z``, with their gradients: that of the positive texts as
    positive, and the corrected one of the others as negative."""
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    soft = np.logaddexp(0, z)  # the loss as a negative; z less, as a positive
    first = prior * (soft - z)[positive].sum() / n_p
    rest = soft[~positive].sum() / n_u - prior * soft[positive].sum() / n_p
    return first, rest, np.where(positive, prior * (s - 1) / n_p, 0.0), np.where(positive, -prior * s / n_p, s / n_u)


def nnpu(doc: np.ndarray, feat: np.ndarray, positive: np.ndarray, prior: float, most: int = 8192, steps: int = 400, rate: float = 0.05, ridge: float | None = None, beta: float | None = None,
         chosen: np.ndarray | None = None) -> Linear:
    """Full-batch Adam on the non-negative risk with the logistic loss.

    The second part may fall to ``-beta`` before it is ascended (by default the prior): a share of
    toxic texts guessed a little high alone makes it negative, with no overfit to undo. The ridge is
    0.1 for one positive text, less by their number for more; it and the least support of a feature
    are the best of a few by cross-validation inside the training rows.
    """
    ridge = 0.1 / max(1, positive.sum()) if ridge is None else ridge
    beta = prior if beta is None else beta
    chosen = select(doc, feat, positive, prior, most) if chosen is None else chosen
    where = np.full(1 << BITS, -1)
    where[chosen] = np.arange(len(chosen))
    on = np.flatnonzero((where >= 0)[feat])
    row, col = doc[on], where[feat[on]]
    n, m = len(positive), len(chosen)
    w, b = np.zeros(m), float(np.log(prior / (1 - prior)))
    mom, var = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(row, w[col], n)
        _, rest, d, back = risk(z, positive, prior)
        d = d + back if rest >= -beta else -back
        g = np.append(np.bincount(col, d[row], m) + (ridge * w if rest >= -beta else 0), d.sum())
        mom, var = 0.9 * mom + 0.1 * g, 0.999 * var + 0.001 * g * g
        step = rate * (mom / (1 - 0.9**t)) / (np.sqrt(var / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Linear(chosen, w, float(b))


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column | None = None, text: str = "text", key: str = "doc_id", label: str = "toxic",
                 prior: float | None = None, most_positive: int = 4_000, most_unlabelled: int = 12_000) -> Linear:
    """Fit on at most ``most_positive`` confirmed toxic rows and ``most_unlabelled`` rows of any kind.

    Both samples are taken by hash of the id among rows under ``train`` (a condition on ``key``); of rows
    that repeat an id, one text counts. ``prior`` is the share of toxic texts; by default the labelled
    rows' own share. Without a confirmed row the model is the prior alone. The driver sees how many texts
    have each of the 2^20 features, and of the texts only the features that are chosen, however long
    they are.
    """
    spark = docs.sparkSession
    train = F.lit(True) if train is None else train
    known = labels.where(train).where(F.col(key).isNotNull() & F.col(label).isNotNull())
    if prior is None:
        share = known.agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"]
        prior = float(np.clip(share if share is not None else 0.1, 0.005, 0.9))
    toxic = hash_sample(known.where(F.col(label) == 1).select(F.col(key).alias("k")).distinct(), "k", most_positive, "toxic")
    free = hash_sample(docs.where(train & F.col(key).isNotNull()).select(F.col(key).alias("k")).distinct(), "k", most_unlabelled, "free")
    marks = toxic.select("k", F.lit(1).alias("p")).unionAll(free.select("k", F.lit(0).alias("p")))  # bounded by the two limits
    sample = docs.select(F.col(key).alias("k"), F.col(text).alias("x")).join(F.broadcast(marks), "k").groupBy("k", "p").agg(F.min("x").alias("x"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in K.text_slices(b.column("x")):
                doc, feat = present(*features(buf, off))
                cut = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                yield pa.record_batch({"k": b.column("k")[i:j].cast(pa.string()), "p": b.column("p")[i:j], "f": pa.ListArray.from_arrays(cut, pa.array(feat.astype(np.int32)))})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, feat = listed(b.column("f"))
            df = counted(doc, feat, b.column("p").to_numpy() == 1)
            on = np.flatnonzero(df.any(0))
            yield pa.record_batch({"f": on, "others": df[0][on], "positive": df[1][on]})

    mark = staged_mark()
    found = stage(sample.mapInArrow(work, "k string, p int, f array<int>"), "features")
    texts = {r.p: r["count"] for r in found.groupBy("p").count().collect()}
    if not texts.get(1):
        drop_staged(spark, mark)
        return Linear(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    sums = found.mapInArrow(count, "f long, others long, positive long").groupBy("f").agg(F.sum("others").alias("others"), F.sum("positive").alias("positive")).toArrow()
    df = np.zeros((2, 1 << BITS), np.int64)
    for side, name in enumerate(("others", "positive")):
        df[side][sums["f"].to_numpy()] = sums[name].to_numpy()
    chosen = choose(df, (texts.get(0, 0), texts[1]), prior, 8192)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, feat = listed(b.column("f"))
            on = np.isin(feat, chosen)
            cut = np.searchsorted(doc[on], np.arange(len(b) + 1)).astype(np.int32)
            yield pa.record_batch({"k": b.column("k"), "p": b.column("p"), "f": pa.ListArray.from_arrays(pa.array(cut), pa.array(feat[on].astype(np.int32)))})

    rows = found.mapInArrow(narrow, found.schema).toArrow().sort_by([("k", "ascending"), ("p", "ascending")])
    drop_staged(spark, mark)
    doc, feat = listed(rows["f"].combine_chunks())
    return nnpu(doc, feat, rows["p"].to_numpy() == 1, prior, chosen=chosen)


def listed(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of a column of feature lists."""
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = pc.list_value_length(lists).to_numpy()
    return np.repeat(np.arange(len(size), dtype=np.int32), size), lists.flatten().to_numpy()


def score_toxicity(docs: DataFrame, model: Linear, text: str = "text", keep: list[str] | None = None, out: str = "toxicity_score") -> DataFrame:
    """``keep`` columns (all, by default) and ``out``, between 0 and 1, higher where toxicity is
    likelier. Whole texts; null and empty ones score the model's constant; repeated rows each get
    theirs; a column named ``out`` is replaced; no rows give no rows."""
    return score_rows(docs, model.score, text, docs.columns if keep is None else keep, out)
