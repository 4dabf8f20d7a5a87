"""A few registered queries against their DuckDB oracle on sf0.001 (fast subset;
tools/check_oracle.py runs all of them)."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from billframe.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        if isinstance(v, decimal.Decimal):
            return str(v.normalize())
        if isinstance(v, float):
            return round(v, 6)
        return v.isoformat() if hasattr(v, "isoformat") else v

    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", [
    "dq_status", "hard_rules", "key_fold", "coerce_money", "size_gate", "get_by_key", "answer_sample", "month_stats",
    "rule_counts", "fx_audit", "load_history", "malformed_envelopes",
])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"status", "n", "total_gbp"}
    assert df.count() >= 0
