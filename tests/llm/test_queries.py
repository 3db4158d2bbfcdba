"""The registered queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from litspark.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    found = con.execute(queries.SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    assert ours == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())


@pytest.mark.parametrize(("name", "label"), [("op9_quality_classifier", "quality"), ("op4_toxicity", "toxic")])
def test_scores(spark, name, label):
    rows = queries.QUERIES[name](spark, DATA).collect()
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= (0.7 if label == "quality" else 0.5)) for r in rows)
