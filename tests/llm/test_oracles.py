"""Every registered query with SQL against its DuckDB twin."""

import duckdb
import pandas as pd
import pytest

from faultline.llm.oracle import ORACLE
from faultline.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.test_oracles import TABLES, _rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    found = con.execute(ORACLE[name])
    ddf = pd.DataFrame(found.fetchall(), columns=[c[0] for c in found.description])  # nulls as in toPandas()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert _rows(sdf) == _rows(ddf)
