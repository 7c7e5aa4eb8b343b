"""The registered queries against their SQL twins, and the entry point with and without the llm subpackage."""
import os
import subprocess
import sys

import duckdb
import pytest

from foliant.plans import registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def cells(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    flat = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    return sorted((tuple(flat(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, sf, db, name):
    df = registry.queries()[name](spark, sf)
    rows = df.collect()
    assert df.columns and len(set(df.columns)) == len(df.columns)
    if name in registry.oracles():
        theirs = db.sql(registry.oracles()[name])
        assert sorted(df.columns) == sorted(theirs.columns)
        assert cells(df.columns, rows) == cells(theirs.columns, theirs.fetchall())


def test_greedy_match_extends_the_index_pass(spark, sf):
    greedy = registry.queries()["slot_greedy_match"](spark, sf).where("kind = 'slot'")
    filled = greedy.where("present").count()
    assert filled >= registry.queries()["slot_index_match"](spark, sf).count()
    assert greedy.count() > filled


def test_greedy_match_has_every_line_item_as_a_slot(spark, sf):
    greedy = registry.queries()["slot_greedy_match"](spark, sf).where("kind = 'slot'")
    assert greedy.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_llm(tmp_path):
    """A copy without the subpackage and the pipeline imports and lists the other queries."""
    import shutil

    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/foliant", tmp_path / "foliant", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'doc_quality_score' in q and not any(n.startswith('op') for n in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
