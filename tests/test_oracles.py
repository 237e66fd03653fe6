"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.check import TABLES, digest
from tools.types import SPARK_TO_DUCK

import __spark_entry__ as entry_mod
from cinelake import registry

KEYS = sorted(registry.queries())
ORACLES = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_key_has_an_oracle():
    assert len(KEYS) >= 71
    assert set(KEYS) == set(registry.oracle_sql()) and set(KEYS) <= set(entry_mod.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry_mod.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLES:
        assert len(rows) > 0
        return
    rel = con.sql(ORACLES[key])
    spark_types = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(ORACLES[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["genre_id", "genre_name", "genre_name_clean", "total_movies"]
    assert df.count() > 0
