"""Every registered query against its SQL oracle on the smallest given tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, canonical
from salesmart.plans.driver_oracle import ORACLES
from salesmart.plans.driver_queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="given tables not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def test_names_agree():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_a_missing_library_costs_the_training_queries_only():
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e;"
        "assert len(e.queries()) >= 100 and not any(n.startswith('op') and n[2].isdigit() for n in e.queries())"
    )
    root = Path(contract.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    result = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(rows, df.columns) == canonical(result.fetchall(), columns)
