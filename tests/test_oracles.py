"""Every registered query against its DuckDB oracle (the driver's gate)."""

import duckdb
import pytest

import __spark_entry__ as entry
from faultline.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    out = []
    for r in pdf.itertuples(index=False):
        out.append(
            tuple(
                None
                if v is None or (isinstance(v, float) and v != v)
                else (float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v)
                for v in r
            )
        )
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "column"
    assert df.count() == 4


def test_every_query_has_oracle_or_is_model_output():
    rows_only = set(QUERIES) - set(entry.oracle_sql())
    assert rows_only <= {"random_search"}


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL).toPandas()
    ddf = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert len(sdf) == len(ddf)
    assert _rows(sdf) == _rows(ddf)
