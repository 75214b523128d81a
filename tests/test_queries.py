"""The registered queries against their SQL, on the smallest sample."""

import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect, main
from tillhouse.workload.oracles import ORACLES
from tillhouse.workload.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent
FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no sample data")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    difference = compare(QUERIES[name](spark, FOLDER), connect(FOLDER).sql(ORACLES[name]))
    assert not difference, difference[:5]


def test_the_rest_works_without_the_corpus_libraries():
    """A library that only the corpus operators need, or the operators themselves, may be missing."""
    for name in ("ahocorasick", "corpus_pipeline", "tillhouse.llm"):
        code = f"import sys; sys.modules[{name!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
        run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
        assert run.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]


def test_queries_without_sql_are_passed_over(spark, monkeypatch, capsys):
    monkeypatch.setattr("__spark_entry__.queries", lambda: {"none": None, "total_revenue": QUERIES["total_revenue"]})
    monkeypatch.setattr("__spark_entry__.oracle_sql", lambda: {"total_revenue": ORACLES["total_revenue"]})
    assert main(FOLDER, []) == 0
    out = capsys.readouterr().out
    assert "none: no SQL" in out and "total_revenue: same" in out
