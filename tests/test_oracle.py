"""A few registered queries against their DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from epigrid.plans import catalog

SF = "/root/testdata/sf0.001"
KEYS = ["weekly_cases", "population_long", "province_rates", "date_parse_ymd", "dissolve_boundary"]


def _rows(df_pd):
    cols = sorted(df_pd.columns)
    out = []
    for r in df_pd[cols].itertuples(index=False):
        out.append(tuple("∅" if v is None or v != v else (round(v, 6) if isinstance(v, float) else str(v)[:10])
                         for v in r))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation supplier orders lineitem".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    got = queries()[key](spark, SF).toPandas()
    want = con.execute(oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["ubigeo", "week_start", "cases"] and df.count() > 0


def test_every_key_has_an_oracle_or_is_rows_only():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"breaks_kmeans_ml"}
    assert set(catalog.queries()) <= set(queries()) and len(catalog.queries()) >= 91
