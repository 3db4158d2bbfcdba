"""The entry module, with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


def test_flagship(spark):
    if not Path("/root/testdata/sf0.001").exists():
        pytest.skip("no test tables")
    import __spark_entry__ as entry

    assert {r.part for r in entry.entry(spark).collect()} >= {"Title", "Methods", "Other"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "litspark", tmp_path / "litspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op1_') for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, m, found = out.stdout.split()
    assert int(n) == int(m) > 100 and found == "False"
