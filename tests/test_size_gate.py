"""The gates over measured texts agree with DuckDB, row by row."""

import duckdb

import __spark_entry__ as entry


def test_sizes_and_headers_are_measured(spark):
    name = "size_gate_contents"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{entry.SMOKE_DIR}/documents.parquet'")
    wanted = sorted(map(repr, duckdb.sql(entry.oracle_sql()[name]).fetchall()))
    got = entry.queries()[name](spark, entry.SMOKE_DIR).collect()
    assert sorted(repr(tuple(r)) for r in got) == wanted
    assert {(r.kind, r.hard_rule) for r in got} == {("plain", "EXTRACTION_FAILED"), ("headed", None)}
