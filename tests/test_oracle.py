"""Every registered key against its DuckDB oracle (batch result = SQL result).

Runs at sf0.001 so the suite stays quick; the driver's gate runs sf0.01.
"""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    yield con
    con.close()


ORACLES = E.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    got_cols, got = df.columns, df.collect()
    cur = duck.execute(ORACLES[key])
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    assert len(got) == len(want)
    assert _canon(got_cols, got) == _canon(want_cols, want)


def test_every_key_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["song_name", "plays"]
    assert 0 < df.count() <= 5


def test_rows_only_keys_run(spark):
    for key in sorted(set(E.queries()) - set(ORACLES)):
        assert E.queries()[key](spark, SF_SMALL).count() >= 0
