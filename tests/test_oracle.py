"""Every registered query against its DuckDB twin at sf0.01: same columns,
same row count, same order-insensitive value hash."""

import os
import sys

import pytest

from locations import ROOT, SF_ORACLE

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

KEYS = sorted(entry.oracle_sql())

# Spark type -> DuckDB type of the same values.
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
             "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_ORACLE)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {entry.oracle_sql()[key]}").fetchall()}
    spark_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == duck_types
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_registered_runs(spark):
    for key, fn in entry.queries().items():
        if key not in entry.oracle_sql():
            assert fn(spark, "/root/testdata/sf0.001").count() > 0, key


def test_without_the_corpus_operators():
    """The rest works, and registers its own queries, when that subpackage is gone."""
    import subprocess

    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('sigflow.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(k.startswith('op') or k == 'pipeline' for k in e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "generation_mapping" in df.columns and "active_power_average" in df.columns
