"""Documents of many megabytes."""

import random

import numpy as np

from litspark.llm import kernels as K
from litspark.llm import quality, toxicity
from litspark.llm.suffix_dedup import remove_repeated_bytes


def test_hashing_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    buf = rng.choice(np.frombuffer(b"abc  \n", np.uint8), 5000)
    off = np.array([0, len(buf)])
    s, e, _ = K.words(buf, off)
    whole = K.word_hashes(buf, s, e, fold=True)
    stats = quality.statistics(buf, off)
    monkeypatch.setattr(K, "PIECE", 64)
    assert np.array_equal(whole, K.word_hashes(buf, s, e, fold=True))
    assert np.array_equal(stats, quality.statistics(buf, off))


def test_bytes_of_a_long_document(spark, monkeypatch):
    rng = random.Random(0)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = text(300)
    long = text(999_999) + "X" + shared + "Y" + text(4_299_998) + "Z" + shared[:250] + "0" + text(10)
    rows = spark.createDataFrame([(1, long), (2, text(49) + "1" + shared + "2" + text(50))], "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.length) for s in r.spans] for r in remove_repeated_bytes(rows).collect()}
    assert got == {1: [(1_000_000, 300), (5_300_300, 250)], 2: [(50, 300)]}


def test_scores_of_a_long_document(spark):
    rows = spark.createDataFrame([(1, "word " * 2_000_000)], "doc_id long, text string")
    flat = quality.boost(np.zeros((0, len(quality.STATISTICS))), np.zeros(0))
    assert quality.score_quality(rows, flat).first().quality_score == 0.5
    none = toxicity.Linear(np.zeros(0, np.int64), np.zeros(0), -1.0)
    assert toxicity.score_toxicity(rows, none).first().toxicity_score < 0.5
