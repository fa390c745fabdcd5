"""Every table query against its SQL on the small tables."""

import glob
import os

import pytest

from tabletide.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(small):
    duckdb = pytest.importorskip("duckdb")
    out = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        out.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, small, con, name):
    df = QUERIES[name](spark, small)
    found = con.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert set(columns) == set(df.columns)
    got = [tuple(r) for r in df.select([f"`{c}`" for c in columns]).collect()]
    assert sorted(got, key=str) == sorted(found.fetchall(), key=str) and got


def test_entry(spark, small):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_outside_needs_the_text_operators():
    """The rest imports and registers its queries where the subpackage and the pipeline are not there."""
    import subprocess
    import sys

    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("tabletide.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e, tabletide.cli, tabletide.plans.copy, tabletide.plans.storage, tabletide.streaming.tables, tabletide.functions.literals, tabletide.sources.rest
from tabletide.queries import QUERIES
assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
