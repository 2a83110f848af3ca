"""Every registered query against its DuckDB oracle on the smallest tables
(the driver's correctness gate runs the same comparison at sf0.01)."""

import decimal

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from crashlake.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(df: pd.DataFrame):
    out = []
    for rec in df[sorted(df.columns)].astype(object).itertuples(index=False):
        row = []
        for v in rec:
            if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
                row.append("<null>")
            elif isinstance(v, (float, decimal.Decimal)):
                row.append(repr(round(float(v), 9)))
            elif hasattr(v, "hour") and hasattr(v, "date"):
                row.append(v.date().isoformat() if (v.hour, v.minute, v.second) == (0, 0, 0) else v.isoformat())
            else:
                row.append(str(v))
        out.append(tuple(row))
    return sorted(out)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) >= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 48
    assert df.columns == ["factor_desc", "factor_collision_count", "fatal_collisions", "fatal_rate_pct",
                          "fatality_rank"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    got = pd.DataFrame([tuple(r) for r in sdf.collect()], columns=sdf.columns, dtype=object)
    want = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)
