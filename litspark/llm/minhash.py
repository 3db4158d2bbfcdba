"""MinHash near-dedup by an inverted join on signature coordinates.

1. Every text becomes its set of word shingles; equal sets are one class from here on.
2. A class is posted under (coordinate, value) of its MinHash signature: of the posted
   coordinates, the prefix with the rarest values, long enough that two classes that agree often
   enough must meet there.
3. In each posting list, pairs are compared on whole signatures and skipped unless this list is
   the first one in which both are posted. Those with enough matching coordinates are retained.
4. Retained pairs are confirmed on the full shingle sets; links give connected components.

A wide list does not send its pairs, whose number grows with the square of a group of copies. It
sends the classes that have a retained pair; a task compares the sets of a block of them exactly,
and a spanning set of the links comes back: all that components need. Blocks first meet by way of one class,
the list's leader, which is in each. Then the classes not yet in the leader's component meet all
blocks; those in it need not meet one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import components, drop_staged, prepare, release, selective, stage, stage_bucketed, staged_mark, text_hash

COORDINATES = 64
#: Posted coordinates, and how many of them two linked classes share at least: of 20 that agree with
#: a chance of 0.8 each, fewer than 6 do with a probability of 1.8e-7.
POSTED, POSTED_SHARED = 20, 6
#: Matching coordinates of a retained pair: of 64 that agree with a chance of 0.8, fewer do with 3.2e-7.
MATCHES = 34
#: Classes and shingles of a block; lists of more classes than WIDE are wide.
BLOCK, BLOCK_SHINGLES, WIDE = 1024, 1 << 20, 64

_rng = np.random.Generator(np.random.PCG64(7))
_MULTIPLY = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * K.U(2) + K.U(1)
_FLIP = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def signatures(h: np.ndarray, so: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document and coordinate, 32 bits to compare by, and 64 of the posted ones: lists of a 32-bit
    value would fill up with strangers in a large corpus. Documents without shingles have the
    largest values."""
    out = np.full((len(so) - 1, COORDINATES), 2**32 - 1, np.uint32)
    posted = np.full((len(so) - 1, POSTED), 2**64 - 1, np.uint64)
    full = np.flatnonzero(np.diff(so))
    if len(full):
        at = so[:-1][full]
        for c in range(COORDINATES):
            x = (h ^ _FLIP[c]) * _MULTIPLY[c]
            x ^= x >> K.U(32)
            x *= _MULTIPLY[c]
            least = np.minimum.reduceat(x, at)
            out[full, c] = least >> K.U(32)
            if c < POSTED:
                posted[full, c] = least
    return out, posted


def shingle_sets(column: pa.Array, k: int, gap: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Per slice: first row, shingles and offsets, and each row's sorted distinct shingles."""
    for i, _, buf, off in K.text_slices(column):
        starts, ends, wo = K.words(buf, off, gap)
        h, so = K.shingles(K.word_hashes(buf, starts, ends, fold=True), wo, k)
        yield i, h, so, [np.unique(h[so[d] : so[d + 1]]) for d in range(len(so) - 1)]


def set_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit sums that stand for each set."""
    n = np.array([len(s) for s in sets], np.int64)
    keys = [np.array([(K.mix(s * K.U(m)).sum(dtype=np.uint64) if len(s) else 0) for s in sets], np.uint64).view(np.int64) for m in (0x9FB21C651E98DF25, 0xE7037ED1A0B428DB)]
    return n, *keys


SKETCH = "d long, th binary, n long, k1 long, k2 long, sig binary, posts array<long>"


def sketch(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """A row per document: its key and text's digest, its set's size and keys, its signature."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, h, so, sets in shingle_sets(b.column("x"), k, K.SPACE):
                n, k1, k2 = set_keys(sets)
                sig, posts = signatures(h, so)
                posts = pa.FixedSizeListArray.from_arrays(pa.array(posts.view(np.int64).ravel()), POSTED).cast(pa.list_(pa.int64()))
                own = [b.column(c)[i : i + len(n)] for c in ("d", "th")]
                yield pa.RecordBatch.from_arrays([own[0].cast(pa.int64()), own[1], pa.array(n), pa.array(k1), pa.array(k2), pa.array([x.tobytes() for x in sig], pa.binary()), posts], ["d", "th", "n", "k1", "k2", "sig", "posts"])

    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("d"), text_hash(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").alias("x"))
    return rows.mapInArrow(work, SKETCH)


def pairs_in(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of neighbours in runs of the given sizes, as indices into the concatenated runs."""
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(sizes.sum()) - first
    b = np.repeat(np.arange(sizes.sum()), place)
    a = np.arange(place.sum()) - np.repeat(np.cumsum(place) - place, place) + first[b]
    return a, b


def compare(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, coordinate: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs, those retained: sizes allow the threshold, this list is the first that both are
    posted in, and enough coordinates match."""
    n, sig, posted = rows["n"], rows["sig"], rows["posted"]
    ok = np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) - 1e-9
    a, b, coordinate = a[ok], b[ok], coordinate[ok]
    keep_a, keep_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    bits = (1 << np.arange(POSTED, dtype=np.int64))[None]
    for i in range(0, len(a), 1 << 15):
        x, y = a[i : i + (1 << 15)], b[i : i + (1 << 15)]
        same = sig[x] == sig[y]
        both = (posted[x] & posted[y])[:, None] & bits
        first = (same[:, :POSTED] & (both != 0)).argmax(1) == coordinate[i : i + (1 << 15)]
        good = first & (same.sum(1) >= MATCHES)
        keep_a.append(x[good])
        keep_b.append(y[good])
    return np.concatenate(keep_a), np.concatenate(keep_b)


def by_cell(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows that come sorted by cell, as tables of whole cells of about ``most`` rows or one cell."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not len(b):
            continue
        cell = b.column("cell").to_numpy()
        if size > most:
            last = held[-1].column("cell")[len(held[-1]) - 1].as_py()
            first = int(np.argmax(cell != last)) if (cell != last).any() else len(cell)
            if first < len(cell):
                yield pa.Table.from_batches([*held, b.slice(0, first)]).combine_chunks()
                held, size, b = [], 0, b.slice(first)
        held.append(b)
        size += len(b)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def cells_of(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    return cut, np.diff(np.r_[cut, len(cell)])


def merge_lists(cells: DataFrame, threshold: float) -> DataFrame:
    """Of cells (cell, side, id, n, sig, posted, coordinate, wide), sorted by cell: the retained pairs
    (a, b) of narrow lists; of wide ones (cell, a = id, b = side) of classes with a retained pair."""

    def flush(t: pa.Table) -> Iterator[pa.RecordBatch]:
        get = lambda c: t[c].to_numpy()
        rows = {c: get(c) for c in ("id", "n", "posted")}
        rows["sig"] = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint32).reshape(-1, COORDINATES)
        cell, side, coordinate = get("cell"), get("side"), get("coordinate")
        wide = t["wide"].to_numpy()
        cut, sizes = cells_of(cell)
        narrow = ~wide[cut]
        if narrow.any():
            index = np.concatenate([np.arange(c, c + s) for c, s in zip(cut[narrow], sizes[narrow], strict=True)])
            own = sizes[narrow]
            weight = np.cumsum(own * (own - 1) // 2)
            at = np.cumsum(own) - own
            lo = 0
            while lo < len(own):  # as many lists at a time as a bound on their pairs allows
                hi = max(lo + 1, int(np.searchsorted(weight, (weight[lo - 1] if lo else 0) + (1 << 18), "right")))
                a, b = pairs_in(own[lo:hi])
                a, b = index[at[lo] + a], index[at[lo] + b]
                a, b = compare(rows, a, b, coordinate[a], threshold)
                if len(a):
                    x, y = rows["id"][a], rows["id"][b]
                    yield pa.record_batch({"cell": pa.nulls(len(a), pa.int64()), "a": np.minimum(x, y), "b": np.maximum(x, y)})
                lo = hi
        for c, s in zip(cut[~narrow], sizes[~narrow], strict=True):
            i = np.arange(c, c + s)
            x, y = (i, i) if side[c] == 2 else (i[side[i] == 0], i[side[i] == 1])
            live = np.zeros(len(cell), bool)
            for lo in range(0, len(x), 64):
                a, b = np.repeat(x[lo : lo + 64], len(y)), np.tile(y, len(x[lo : lo + 64]))
                if side[c] == 2:
                    a, b = a[a < b], b[a < b]
                a, b = compare(rows, a, b, coordinate[a], threshold)
                live[a] = live[b] = True
            on = np.flatnonzero(live)
            if len(on):
                yield pa.record_batch({"cell": cell[on], "a": rows["id"][on], "b": side[on].astype(np.int64)})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_cell(batches, 1 << 13):
            yield from flush(t)

    return cells.mapInArrow(work, "cell long, a long, b long")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products over the shingles that are in more than one set."""
    size = np.array([len(s) for s in sets])
    of = np.repeat(np.arange(len(sets)), size)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    useful = times > 1
    place = np.cumsum(useful) - 1
    on = useful[column]
    of, column = of[on], place[column[on]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(useful.sum()), 2048):
        i, j = np.searchsorted(column, (lo, lo + 2048))
        m = np.zeros((len(sets), min(2048, int(useful.sum()) - lo)), np.float32)
        m[of[i:j], column[i:j] - lo] = 1
        out += m @ m.T
    return out.astype(np.int64)


def link_cells(cells: DataFrame, threshold: float) -> DataFrame:
    """Spanning links (a, b) of cells (cell, side, id, shingles), sorted by cell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_cell(batches, 0):
            cut, sizes = cells_of(t["cell"].to_numpy())
            for c, s in zip(cut, sizes, strict=True):
                part = t.slice(c, s)
                ids = part["id"].to_numpy()
                sets = [np.frombuffer(x, np.uint64) for x in part["shingles"].to_pylist()]
                n = np.array([len(x) for x in sets])
                both = shared_counts(sets)
                linked = both >= threshold * (n[:, None] + n[None] - both) - 1e-9
                label = np.arange(len(ids))
                while True:  # least label over the links until none changes
                    least = np.where(linked, label[None], len(ids)).min(1)
                    least = np.minimum(label, least)
                    least = least[least]
                    if (least == label).all():
                        break
                    label = least
                on = np.flatnonzero(label != np.arange(len(ids)))
                x, y = ids[on], ids[label[on]]
                if len(on):
                    yield pa.record_batch({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    return cells.mapInArrow(work, "a long, b long")


def blocks(length, weight):
    return F.greatest(F.ceil(length / BLOCK), F.ceil(weight / BLOCK_SHINGLES), F.lit(1)).cast("int")


def block_of(n):
    return F.pmod(F.xxhash64(F.lit("block"), "id"), n).cast("int")


CELL = ("id", "n", "sig", "posted", "coordinate", "wide")


def deal(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Cells of the posting lists (.., len, weight, leader): lists of at most a block are one; a longer
    one has a cell for each of its blocks, and its leader is in them all."""
    rows = lists.join(classes.select("id", "sig"), "id").withColumn("wide", F.col("len") > WIDE)
    rows = rows.withColumn("nb", F.when(F.col("wide"), blocks(F.col("len"), F.col("weight"))).otherwise(1))
    rows = rows.withColumn("at", F.explode(F.when(F.col("id").eqNullSafe(F.col("leader")), F.sequence(F.lit(0), F.col("nb") - 1)).otherwise(F.array(block_of(F.col("nb"))))))
    return rows.select(F.xxhash64("key", "at").alias("cell"), F.lit(2).alias("side"), *CELL)


def deal_rest(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Cells of what is left of the longer lists (.., covered): every two blocks meet in a cell, but for
    two of covered classes, which all are in the leader's component already."""
    count = lambda c, x: F.sum(F.when(c, F.col(x) if x else 1).otherwise(0))
    on, off = F.col("covered"), ~F.col("covered")
    size = lists.groupBy("key").agg(count(off, None).alias("nu"), count(off, "n").alias("wu"), count(on, None).alias("nc"), count(on, "n").alias("wc")).where("nu > 0")
    rows = lists.join(size, "key").join(classes.select("id", "sig"), "id")
    rows = rows.withColumn("bu", blocks(F.col("nu"), F.col("wu"))).withColumn("bc", blocks(F.col("nc"), F.col("wc")))
    rows = rows.withColumn("own", F.when(on, F.col("bu") + block_of(F.col("bc"))).otherwise(block_of(F.col("bu"))))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("bu") - 1 + F.when(on, 0).otherwise(F.col("bc")))))
    lo, hi = F.least("own", "with"), F.greatest("own", "with")
    side = F.when(lo == hi, 2).when(F.col("own") == lo, 0).otherwise(1)
    return rows.withColumn("wide", F.lit(True)).select(F.xxhash64("key", lo, hi).alias("cell"), side.alias("side"), *CELL)


def member_sets(docs: DataFrame, key: str, text: str, k: int, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shingles) of the classes in ``ids``, bucketed by id; one text of each is read again."""
    spark = docs.sparkSession
    who = stage(classes.select("id", "rep", "k1", "k2").join(ids, "id", "left_semi"), "members")
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("rep"), F.col(f"`{text}`").alias("x")).join(selective(who, "rep"), "rep")

    def own_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, _, _, sets in shingle_sets(b.column("x"), k, K.SPACE):
                _, k1, k2 = set_keys(sets)
                want = [b.column(c)[i : i + len(sets)].to_numpy() for c in ("k1", "k2")]
                ok = np.flatnonzero((want[0] == k1) & (want[1] == k2))  # ids repeated with another text
                yield pa.record_batch({"id": b.column("id")[i : i + len(sets)].take(pa.array(ok)), "shingles": pa.array([sets[j].tobytes() for j in ok], pa.binary())})

    prepare(spark)
    sets = stage_bucketed(rows.mapInArrow(own_set, "id long, shingles binary"), "sets", "id")
    release(spark)
    return sets


def confirm(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose full shingle sets are as similar as the threshold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for i, (x, y) in enumerate(zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if both >= threshold * (len(x) + len(y) - both) - 1e-9:
                    ok.append(i)
            yield pa.record_batch({c: b.column(c).take(pa.array(ok, pa.int64())) for c in ("a", "b")})

    prepare(pairs.sparkSession)
    with_a = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    both = with_a.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    return both.mapInArrow(check, "a long, b long")


def grouped(docs: DataFrame, key: str, text: str, k: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(d, th, n, k1, k2) of every row, and (k1, k2, n, least, part) of every class of equal sets: the
    smallest key of its component, and a number for the component."""
    spark = docs.sparkSession
    prepare(spark)
    mark = staged_mark()
    rows = stage(sketch(docs, key, text, k), "sketches")
    classes = rows.where("n > 0 AND d IS NOT NULL").groupBy("k1", "k2", "n").agg(F.min("d").alias("rep"), F.first("sig").alias("sig"), F.first("posts").alias("posts"))
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

    posting = classes.select("id", "n", F.posexplode_outer("posts").alias("coordinate", "value"))
    posting = posting.select("id", "n", "coordinate", F.xxhash64("coordinate", "value").alias("key"))
    lists = stage(posting.groupBy("key").agg(F.count("*").alias("len")).where("len > 1"), "lengths")
    # a class's prefix: its posted coordinates but those of its longest lists, as few as linked
    # classes share at least, less one. Lists of one class are no loss and not counted
    met = posting.join(lists, "key").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("len", "key", "coordinate"))).alias("met"))
    met = met.withColumn("met_len", F.aggregate("met", F.lit(0).cast("bigint"), lambda acc, m: acc + m["len"]))
    met = met.withColumn("met", F.slice("met", F.lit(1), F.greatest(F.size("met") - (POSTED_SHARED - 1), F.lit(0))))
    met = met.withColumn("posted", F.aggregate("met", F.lit(0).cast("bigint"), lambda acc, m: acc + F.pow(F.lit(2.0), m["coordinate"]).cast("bigint")))
    prefix = stage(met.select("id", "n", "posted", "met_len", F.inline("met")).drop("len"), "postings")
    lengths = stage(prefix.groupBy("key").agg(F.count("*").alias("len"), F.sum("n").alias("weight")).where("len > 1"), "lengths")
    lists = prefix.join(lengths, "key")
    long = lists.where((F.col("len") > WIDE) & (blocks(F.col("len"), F.col("weight")) > 1))
    # the class in the longest lists is likeliest to be what a group's others are copies of
    leaders = stage(long.groupBy("key").agg(F.max_by("id", F.struct("met_len", F.xxhash64("id"))).alias("leader")), "leaders")

    def links_of(cells: DataFrame) -> DataFrame:
        prepare(spark, 4000)
        merged = stage(merge_lists(cells.repartition(F.col("cell")).sortWithinPartitions("cell"), threshold), "merged")
        pairs = merged.where("cell IS NULL").select("a", "b")
        wide = merged.where("cell IS NOT NULL").select("cell", F.col("a").alias("id"), F.col("b").alias("side"))
        ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).unionAll(wide.select("id")).distinct()
        sets = member_sets(docs, key, text, k, classes, ids)
        links = confirm(pairs, sets, threshold)
        dealt = wide.join(sets, "id").repartition(F.col("cell")).sortWithinPartitions("cell")
        return stage(links.unionAll(link_cells(dealt, threshold)), "links")

    links = links_of(deal(lists.join(leaders, "key", "left"), classes))
    labels = components(links, "a", "b")
    if leaders.limit(1).count():
        # classes already in the leader's component need not meet one another, all others meet all
        label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in"))
        led = leaders.join(label("leader"), "leader", "left").select("key", F.coalesce("leader_in", "leader").alias("leader_in"))
        rest = long.join(led, "key").join(label("id"), "id", "left").withColumn("covered", F.coalesce("id_in", "id") == F.col("leader_in"))
        rest = stage(rest.select("key", "id", "n", "posted", "coordinate", "covered"), "rest")
        if rest.where("NOT covered").limit(1).count():
            labels = components(links.unionAll(links_of(deal_rest(rest, classes))), "a", "b")
    reps = classes.select(F.col("id").alias("node"), "rep").join(labels, "node")
    least = reps.groupBy("component").agg(F.min("rep").alias("least"))
    named = reps.join(least, "component").select(F.col("node").alias("id"), "least", "component")
    named = classes.select("id", "k1", "k2", "n", "rep").join(named, "id", "left")
    named = stage(named.select("k1", "k2", "n", F.coalesce("least", "rep").alias("least"), F.coalesce("component", "id").alias("part")), "named")
    drop_staged(spark, mark, rows, named)
    return rows.select("d", "th", "n", "k1", "k2"), named


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, threshold: float = 0.8) -> DataFrame:
    """A row per document: ``key``, ``n_shingles``, ``component_id``, ``kept``, ``same_set``.

    Words are runs of other than space and tab to carriage return, A-Z as a-z. A document's set is
    its distinct k-word shingles; with fewer words the whole sequence; without words or text it is
    empty and linked with nothing. Documents with |A and B| >= threshold * |A or B| are linked;
    ``component_id`` is the smallest key reachable and ``kept`` whether that is the own one.
    ``same_set`` tells equal sets from others. Keys are integers; rows without one link with
    nothing and are kept; rows that repeat a key are rows of their own. An empty table gives no
    rows. Other columns do not matter; texts of any length are taken whole, their set in one task.

    A pair at the threshold exactly is missed by MinHash with a probability of about 5e-7 (the two
    bounds above), a closer one more rarely. Links that are reported are confirmed on the full sets, of
    shingles by 64-bit hashes modulo a prime: in a pair of sets of 10^4 any two hash alike with 10^-10.
    """
    rows, named = grouped(docs, key, text, k, threshold)
    out = rows.join(named.drop("part"), ["k1", "k2", "n"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("least", "d")).otherwise(F.col("d"))
    component = F.when(F.col("d").isNotNull(), component)
    return out.select(F.col("d").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("d").eqNullSafe(component).alias("kept"), F.struct("k1", "k2", "n").alias("same_set"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one row of each component of :func:`near_duplicates`: of the rows of the smallest
    key, the one whose text has the least digest (repeated rows: any one of them).

    Rows are told apart by key and text, so a key on rows of other texts costs these nothing. Rows without
    a key, or without words, all stay, as do all columns, whatever their names. An empty table stays
    empty.
    """
    spark = docs.sparkSession
    mark = staged_mark()
    rows, named = grouped(docs, key, text, k, threshold)
    # every row has its class in named: Bloom filters of the keys would drop none and fill the driver
    prepare(spark, bloom=False)
    found = rows.where("n > 0 AND d IS NOT NULL").join(named, ["k1", "k2", "n"])
    found = stage(found.select("d", "th", "least", "part"), "found")
    stay = found.where("d = least").groupBy("part").agg(F.min("th").alias("stay"))
    # as many (d, th) as there are documents too many, and those that more than one row has
    judged = found.join(stay, "part").groupBy("d", "th", F.expr("d <> least OR th <> stay").alias("gone")).agg(F.count("*").alias("rows"))
    judged = stage(judged.where("gone OR rows > 1").select("d", "th", "gone"), "judged")
    drop_staged(spark, mark, judged)
    gone, same = judged.where("gone").select("d", "th"), judged.where("NOT gone").select("d", "th")
    names = [f"c{i}" for i in range(len(docs.columns))]
    base = docs.toDF(*names)
    base = base.withColumn("d", F.col(names[docs.columns.index(key)]).cast("bigint")).withColumn("th", text_hash(names[docs.columns.index(text)]))
    kept = base.join(gone, ["d", "th"], "left_anti")
    if same.limit(1).count():
        once = kept.join(same, ["d", "th"], "left_semi").dropDuplicates(["d", "th"])
        kept = kept.join(same, ["d", "th"], "left_anti").unionByName(once)
    return kept.select(*names).toDF(*docs.columns)
