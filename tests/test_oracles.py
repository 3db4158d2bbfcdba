"""Every query of the library against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from litspark.plans import queries as library
from litspark.plans.views import TABLES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(library.SQL))
def test_query(spark, duck, name):
    df = library.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(repr(plain(tuple(r))) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    found = duck.execute(library.SQL[name])
    names = [x[0] for x in found.description]
    theirs = sorted(repr(plain(tuple(r[names.index(c)] for c in columns))) for r in found.fetchall())
    assert sorted(names) == columns
    assert ours == theirs


def test_whole_texts_are_read(spark, duck):
    rows = library.QUERIES["word_counts"](spark, DATA).collect()
    least = dict(duck.execute("SELECT doc_id, len(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) FROM documents").fetchall())
    assert len(rows) == len(least) and all(r.n_regex >= least[r.doc_id] - 1 for r in rows)


def test_screening_reads_whole_abstracts(spark, tmp_path):
    text = "a " * 500 + "fMRI of language"
    spark.createDataFrame([(3, text, "s"), (9, "a " * 500, "s")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("screen_decisions", "screen_with_model"):
        assert {r.pmid: r.include for r in library.QUERIES[name](spark, str(tmp_path)).collect()} == {"3": True, "9": False}, name
    assert {r.pmid: r.abstract for r in library.QUERIES["training_records"](spark, str(tmp_path)).collect()}["3"] == text
    assert library.QUERIES["screen_funnel"](spark, str(tmp_path)).first().included == 1
    assert library.QUERIES["screen_summary"](spark, str(tmp_path)).first().included == 1
