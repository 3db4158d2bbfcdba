"""Line, byte and word dedup against brute force, and their edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from litspark.llm import line_dedup, substring_dedup, suffix_array, suffix_dedup, unitigs, windows

SCHEMA = "doc_id long, text string, drop string, n_words long, th int, x string, k long, n long"


def frame(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "d", 7, 1, "x", 3, 9) for i, t in rows], SCHEMA)


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [text(70) for _ in range(4)]
    rows = []
    base = text(150)
    for i in range(60):
        kind = i % 6
        body = text(rng.randint(1, 120))
        if kind == 0:
            body += "\n" + rng.choice(shared) + " " + text(10)
        elif kind == 1:
            w = base.split(" ")
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
            body = " ".join(w)
        elif kind == 2:
            body = (text(3) + " ") * 40
        rows.append((i + 10, body))
    rows += [(5, rows[0][1]), (200, rows[1][1]), (201, base), (202, base), (7, base), (7, base), (300, None), (301, ""), (302, "  \n\t"), (303, "one"), (None, base), (None, shared[0]), (400, text(9000) + " " + shared[1])]
    rng.shuffle(rows)
    return rows


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def covered_bytes(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) > 0).sum())
        out.append((len(t), int(gone.sum()), spans, sha(kept)))
    return out


@pytest.mark.parametrize("most", [6000, 1])
def test_bytes(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_BUNDLES", most)
    monkeypatch.setattr(suffix_dedup, "SHARD", 3000)
    rows = corpus()
    got = suffix_dedup.remove_repeated_bytes(frame(spark, rows), window=60, gram=16).collect()
    ours = sorted((repr(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got)
    assert ours == sorted((repr(i), *x) for (i, _), x in zip(rows, covered_bytes(rows, 60), strict=True))
    assert all(sha(bytes(r.kept)) == r.kept_sha256 for r in got)


def test_words(spark):
    rows, window = corpus(), 12
    words = [(t or "").split() for _, t in rows]
    first = defaultdict(lambda: 10**9)
    for (i, _), w in zip(rows, words, strict=True):
        for p in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[p : p + window])
                first[g] = min(first[g], i)
    want = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        want.append((repr(i), len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    got = substring_dedup.remove_repeats(frame(spark, rows), window=window, gram=4).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(want)
    assert all(sha(r.kept_text) == r.kept_sha256 and sum(s.length for s in r.spans) == r.n_removed for r in got)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0


def test_all_null_texts(spark):
    rows = frame(spark, [(1, None), (1, None), (None, None)])
    assert {(r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeated_bytes(rows).collect()} == {(0, 0)}
    assert {(r.n_words, r.kept_sha256) for r in substring_dedup.remove_repeats(rows).collect()} == {(0, sha(""))}


def test_lines(spark):
    rows = [(i, f"Common \nown {i}\n\t COMMON\n\nÉ") for i in range(3)] + [(9, None), (10, ""), (11, "common"), (12, "é\nx"), (12, "é\nx"), (None, "a\nb")]
    got = line_dedup.dedup_lines(frame(spark, rows), min_docs=4).collect()
    assert {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got} == {
        *((i, f"own {i}\n\nÉ", 5, 2) for i in range(3)), (9, "", 1, 0), (10, "", 1, 0), (11, "", 1, 1), (12, "é\nx", 2, 0), (None, "a\nb", 2, 0)
    }
    assert got[0].asDict().keys() == {*(c.split()[0] for c in SCHEMA.split(", ")), "n_lines", "n_dropped"}


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for _ in range(300):
        x = rng.integers(0, rng.integers(1, 5), rng.integers(0, 50)).astype(np.uint8)
        sa = suffix_array.suffix_array(x)
        assert sa.tolist() == sorted(range(len(x)), key=lambda i: x[i:].tobytes())
        if len(x):
            common = suffix_array.permuted_prefixes(x, sa, 9)
            for a, b in zip(sa, sa[1:]):
                u, v = x[a:], x[b:]
                n = next((i for i, (p, q) in enumerate(zip(u, v)) if p != q), min(len(u), len(v)))
                assert common[b] == min(n, 9)


def test_long_runs_of_a_byte():
    x = np.frombuffer(b"a" * 400 + b"b" + b"a" * 399, np.uint8)
    assert suffix_array.suffix_array(x).tolist() == sorted(range(len(x)), key=lambda i: x[i:].tobytes())


def test_named_by_frame(spark):
    # the text column and the key may have other names
    rows = frame(spark, corpus()).select(F.col("doc_id").alias("id"), F.col("text").alias("body")).limit(5)
    assert substring_dedup.remove_repeats(rows, "id", "body").columns[0] == "id"


def test_unitigs_of_branching_and_cyclic_graphs(spark):
    path = [(i, i + 1) for i in range(40)]  # a path, from which 100 branches off at 20
    rows = [(a, b, 2) for a, b in path] + [(20, 100, 1), (100, 101, 1)] + [(200 + i, 200 + (i + 1) % 7, 1) for i in range(7)] + [(300, 300, 1), (300, 301, 1), (400, 401, 1), (401, 400, 1)]
    edges = unitigs.path_edges(spark.createDataFrame(rows, "a long, b long, step int"))
    got = {r.node: (r.unitig, r.off, r.rank) for r in unitigs.unitigs(edges).collect()}
    want = {i: (0, 2 * i, i) for i in range(21)} | {i: (21, 2 * (i - 21), i - 21) for i in range(21, 41)} | {100: (100, 0, 0), 101: (100, 1, 1)}
    want |= {200 + i: (200, i, i) for i in range(7)} | {400: (400, 0, 0), 401: (400, 1, 1)}
    assert got == want
    assert unitigs.unitigs(edges.where("false")).count() == 0


def test_spans_are_compacted_and_verified(spark):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    long = words(3000)
    rows = [(1, long), (2, words(40) + long[500:2500] + words(40)), (3, long[2000:] + words(9)), (4, words(30) + long[:700])]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    windows.setup(frame)
    texts = windows.distinct_texts(frame, "doc_id", "text")
    places, variants = windows.candidates(texts, windows.Words, 50, 12, across=True)
    found = substring_dedup.spans(places, substring_dedup.compact(places, variants.cache()), 50).collect()
    assert len(found) <= 12 and {r.g for r in found} == {1}  # a span for each stretch of the graph, not a row for each k-mer
    got = {r.doc_id: (r.n_removed, [(s.start, s.length) for s in r.spans]) for r in substring_dedup.remove_repeats(frame).collect()}
    assert got == {1: (0, []), 2: (2000, [(40, 2000)]), 3: (1000, [(0, 1000)]), 4: (700, [(30, 700)])}


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_regular_words_do_not_collide(spark):
    """Two different words that any polynomial modulo 2^64 hashes alike."""
    a = thue_morse(4096)
    b = a.translate(str.maketrans("ab", "ba"))
    tail = [f"t{i}" for i in range(49)]
    frame = spark.createDataFrame([(1, " ".join([a, *tail])), (2, " ".join([b, *tail]))], "doc_id long, text string")
    assert {r.n_removed for r in substring_dedup.remove_repeats(frame).collect()} == {0}


@pytest.mark.parametrize("unit", ["ab", "a", "abc ", "xy z"])
def test_long_texts_of_a_short_period(spark, unit):
    texts = [unit * (2_000_000 // len(unit)) + x for x in ("", "1", " end of it")]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeated_bytes(frame, keep_bytes=False).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == len(t) and len(t) - len(got) * 10 <= got[i][1] <= len(t)
    if " " in unit:
        words = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(frame, keep_text=False).collect()}
        assert words[0][1] == 0 and all(words[i][0] - words[i][1] <= 4 for i in (1, 2))
