"""Near-duplicate joins, containment and the embedding join against brute force."""

import math
import random

import numpy as np
import pytest

from litspark.llm import common, decontaminate, embedding_dedup, minhash


def components(n, links):
    label = list(range(n))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for a, b in links:
        label[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def shingles(text, k):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def texts(seed=5, hot=90):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    out = []
    base = text(160)
    for _ in range(hot):  # a large group, linked by way of its base
        w = base[:]
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    for _ in range(25):
        w = text(rng.randint(3, 90))
        out.append(" ".join(w))
        if rng.random() < 0.6:
            w[rng.randrange(len(w))] = "zz"
            out.append(" ".join(w).upper())
    out += [None, "", " \n", "one", "One", "two words", out[0], out[0], "É a b c d", "é a b c d"]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("wide", "block"), [(64, 1024), (8, 20)])
def test_components(spark, monkeypatch, wide, block):
    monkeypatch.setattr(minhash, "WIDE", wide)
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = texts()
    sets = [shingles(t, 4) for t in docs]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = components(len(docs), links)
    rows = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(docs)], "doc_id long, text string, n long, id long")
    got = {r.doc_id: r for r in minhash.near_duplicates(rows, k=4).collect()}
    assert [got[i].component_id for i in range(len(docs))] == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(sets[r.doc_id]) for r in got.values())


def test_longer_lists_meet_by_way_of_their_leader(spark, monkeypatch):
    """Copies of one text are all found by way of it; strangers that share half their words, and pairs
    among them, still meet block by block."""
    monkeypatch.setattr(minhash, "WIDE", 6)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    left = []
    real = minhash.deal_rest
    monkeypatch.setattr(minhash, "deal_rest", lambda lists, classes: left.append(lists) or real(lists, classes))
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base, half = [word() for _ in range(120)], [word() for _ in range(60)]
    copies = [" ".join(base)]
    for i in range(50):
        w = base[:]
        w[rng.randrange(len(w))] = f"x{i}"
        copies.append(" ".join(w))
    strangers = []
    for _ in range(40):
        w = half + [word() for _ in range(30)]
        strangers += [" ".join(w), " ".join([*w, "end"])] if rng.random() < 0.5 else [" ".join(w)]
    for docs, more in ((copies, False), (strangers + copies, True)):
        left.clear()
        sets = [shingles(t, 4) for t in docs]
        links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(rows, k=4).collect()}
        assert [got[i] for i in range(len(docs))] == components(len(docs), links)
        assert bool(left) == more


def test_rows_that_repeat_and_rows_without_a_key(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = spark.createDataFrame([(2, long), (2, long), (1, long + " x"), (None, long), (5, "other text of its own"), (5, "again quite another text")], "doc_id long, text string")
    got = sorted((repr(r.doc_id), r.component_id, r.kept) for r in minhash.near_duplicates(rows).collect())
    assert got == [("1", 1, True), ("2", 1, False), ("2", 1, False), ("5", 5, True), ("5", 5, True), ("None", None, True)]
    assert sorted(repr(r.doc_id) for r in minhash.drop_near_duplicates(rows).collect()) == ["1", "5", "5", "None"]
    assert minhash.near_duplicates(rows.where("false")).count() == 0


def test_a_repeated_key_costs_other_texts_nothing(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(1, t, 0, 1), (5, t + " x", 1, 1), (5, "another text of its own here", 2, 1), (6, t + " y", 3, 1), (6, t + " y", 3, 1)]
    rows += [(7, "a second group of words that is long enough " + x, 4, 1) for x in ("a b c d e f g h i j k l m n o p q", "a b c d e f g h i j k l m n o p r")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, same_words long, th long")
    out = minhash.drop_near_duplicates(frame, k=5, threshold=0.7)
    assert out.columns == frame.columns
    got = out.collect()
    assert sorted(r.doc_id for r in got) == [1, 5, 7] and {r.same_words for r in got if r.doc_id == 5} == {2}


def test_words_that_hash_alike_in_regular_ways_do_not_link(spark):
    a = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    frame = spark.createDataFrame([(i, " ".join([w, "one two three", w, "four five six", w])) for i, w in enumerate((a, b))], "doc_id long, text string")
    assert [r.component_id for r in minhash.near_duplicates(frame, k=4).orderBy("doc_id").collect()] == [0, 1]


def test_recall_just_above_the_threshold(spark):
    """Pairs of sets with similarities of 0.80 to 0.82, each a component of its own."""
    rng = random.Random(4)
    rows, pairs = [], 1500
    for p in range(pairs):
        n = rng.randrange(90, 180)
        words = [f"p{p}w{i}" for i in range(n)]
        shared = n - 3
        other = next(m for m in range(1, n) if shared / (shared + m) < 0.8) - 1  # as many more shingles as the threshold allows
        rows += [(2 * p, " ".join(words)), (2 * p + 1, " ".join(words + [f"p{p}x{i}" for i in range(other)]))]
        assert 0.8 <= shared / (shared + other) < 0.82
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()}
    assert sum(got[2 * p + 1] == 2 * p for p in range(pairs)) == pairs


def test_repeated_row_stays_once(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = spark.createDataFrame([(2, long, "a"), (2, long.upper(), "b"), (3, "x y", "c")], "doc_id long, text string, source string")
    out = minhash.drop_near_duplicates(rows)
    assert out.columns == rows.columns and sorted(r.doc_id for r in out.collect()) == [2, 3]


def test_no_bloom_filters_where_all_rows_meet(spark, monkeypatch):
    """Each is as large as a table of a million keys needs, and the driver holds it with every stage that uses it."""
    plans = {}

    def lower(session, *a, **k):  # as if every table were of the size from which they are allowed
        common.prepare(session, *a, **k)
        if session.conf.get(limit) == "32MB":
            session.conf.set(limit, "0")

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return common.stage(df, name)

    limit, broadcast = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(broadcast)
    monkeypatch.setattr(minhash, "prepare", lower)
    monkeypatch.setattr(minhash, "stage", kept)
    spark.conf.set(broadcast, "-1")
    try:
        words = [" ".join(f"w{i}" for i in range(n)) for n in (40, 41, 60, 90)]
        rows = spark.createDataFrame([(i, t) for i, t in enumerate([*words, words[3], ""])] + [(3, words[3])], "doc_id long, text string")
        out = minhash.drop_near_duplicates(rows)
        plans["out"] = out._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r.doc_id for r in out.collect()) == [0, 2, 3, 5]
    finally:
        spark.conf.set(broadcast, was)
        common.prepare(spark)
    after = list(plans)[list(plans).index("named") + 1 :]
    assert len(after) > 1 and not [name for name in after if "might_contain" in plans[name]]


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in common.components(path, "a", "b").collect()}
    assert {got[i] for i in range(201)} == {0} and got[501] == 500


def test_containment(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (5, 12, 30, 60, 200)] + ["too short", "", None]
    docs = []
    for i, item in enumerate(items[:5]):
        filler = [rng.choice(words) for _ in range(3000)]
        docs.append(" ".join([*filler[:1500], item.upper().replace(" ", " ,"), *filler[1500:]]))
        w = item.split()
        w[len(w) // 2] = "changed"
        docs.append(" ".join([*filler[:20], *w]))
        docs.append(" ".join([*filler[:20], *w[: len(w) // 2]]))
    docs += ["Too short!", None, "", docs[0]]
    want = set()
    for d, t in enumerate(docs):
        have = shingles("".join(c if c.isalnum() else " " for c in t or ""), 5)
        for i, item in enumerate(items):
            s = shingles(item, 5)
            if s and len(s & have) >= 0.8 * len(s):
                want.add((d, i, len(s), len(s & have)))
    frame = spark.createDataFrame([(d, t, 1) for d, t in enumerate(docs)], "doc_id long, text string, n long")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for size in (1 << 20, 100):
        got = decontaminate.find_contamination(frame, bench, block_chars=size).collect()
        assert {(r.doc_id, r.item_id, r.item_shingles, r.shared) for r in got} == want and len(got) == len(want)
    clean = decontaminate.drop_contaminated(frame, bench, block_chars=100)
    assert clean.columns == frame.columns and {r.doc_id for r in clean.collect()} == set(range(len(docs))) - {w[0] for w in want}
    assert decontaminate.find_contamination(frame, bench.where("false")).count() == 0
    assert decontaminate.find_contamination(frame.where("false"), bench).count() == 0


def test_containment_with_keys_of_one_name(spark):
    rows = spark.createDataFrame([(1, "a b c d e f g"), (2, None)], "id long, text string")
    got = decontaminate.find_contamination(rows, rows, key="id", item_key="id").collect()
    assert [(r.id, r.item_id, r.containment) for r in got] == [(1, 1, 1.0)]


def test_sketches_need_the_whole_share_of_small_items():
    assert decontaminate.needed(10, 32, 0.8) == 8
    assert 1 <= decontaminate.needed(1000, 60, 0.8) < 48


def test_great_and_small_vectors_link(spark):
    rows = [(1, [1e-200, 2e-200]), (2, [1e-200, 2e-200]), (3, [1e200, 2e200]), (4, [2e200, 4e200]), (5, [5e-324, 0.0]), (6, [1.0, 0.1]), (7, [-1e300, 1e300])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (1, 5), 6: (1, 5), 7: (0, 7)}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings(spark, monkeypatch, kind):
    monkeypatch.setattr(embedding_dedup, "PER_PIVOT", 25)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 8))
    x[60:120] = x[0] + rng.normal(size=(60, 8)) * 0.25
    x[120:140] = x[7] * 3
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [math.nan] + [1.0] * 7), (204, [None] + [1.0] * 7), (205, [math.inf] * 8), (206, rows[3][1][:4]), (207, rows[3][1][:4]), (None, rows[0][1])]
    frame = spark.createDataFrame([(*r, 1, "a") for r in rows], f"vec_id long, embedding array<{kind}>, id int, raw string")
    v = np.array([r[1] for r in rows[:150]])
    cos = v @ v.T / np.linalg.norm(v, axis=1)[:, None] / np.linalg.norm(v, axis=1)
    link = cos >= 0.9
    np.fill_diagonal(link, False)
    want = components(150, [tuple(p) for p in np.argwhere(link)])
    got = embedding_dedup.link_embeddings(frame).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    assert [by[i].n_links for i in range(150)] == link.sum(1).tolist()
    assert [by[i].component_id for i in range(150)] == want
    assert [(by[i].n_links, by[i].kept) for i in range(200, 206)] == [(0, True)] * 6
    assert (by[206].n_links, by[207].component_id) == (1, 206) and by[None].n_links == 0
    assert embedding_dedup.link_embeddings(frame.where("false")).count() == 0
    assert embedding_dedup.link_embeddings(frame.where("vec_id = 200")).first().kept
