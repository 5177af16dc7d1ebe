"""Every registered query against its SQL equivalent on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest
from oracle_check import connect, difference, duck_rows, spark_rows

from scorewatch.plans.catalog import QUERIES
from scorewatch.plans.oracles import ORACLES

WITHOUT_SQL = {"file_listing", "auc_mllib"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, con, sf_dir, name):
    assert difference(spark_rows(QUERIES[name](spark, sf_dir)), duck_rows(con, ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:2] == ["model_name", "model_version"]
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("missing", ["scorewatch.llm", "scorewatch.llm.queries", "tokenizers", "corpus_pipeline"])
def test_entry_points_without_text_queries(missing):
    """Whatever the text queries lack, all others are registered and a warning says so."""
    code = f"import sys, warnings; sys.modules[{missing!r}] = None; warnings.simplefilter('error', SyntaxWarning); import __spark_entry__ as e; print(len(e.queries()))"
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert int(done.stdout.split()[-1]) >= len(QUERIES), done.stderr
    if missing != "tokenizers":
        assert int(done.stdout.split()[-1]) == len(QUERIES) and "text queries are not registered" in done.stderr
