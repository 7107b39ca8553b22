"""Registered queries against their DuckDB oracles on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, _rows

SF = "/root/testdata/sf0.001"
CHEAP = ["platinum_rollup", "sale_filter", "lag_lookup", "course_lag", "break_even", "opening_hours",
         "candidates_first", "candidates_continuing", "candidates_slot", "apportion_full", "metrics_one_row",
         "slot_hours", "site_hours", "calendar_gate", "pivot_site_month", "distinct_sorted",
         "course_recode", "union_rollup", "period_shift", "period_windows", "time_split", "schema_cast", "blackout_anti", "fact_sheet_scan", "dim_sheet_scan", "csv_passthrough", "snapshot_load", "layer_sinks",
         "publish_alias", "publish_evaluation", "overflow_realloc", "model_registry", "holdout_metrics", "month_correlation",
         "feature_attach"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_a_docstring_and_most_have_oracles():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    from cohortcast.catalog import ORACLES, QUERIES            # the library's own, without what may be added to it
    assert set(QUERIES) <= set(qs) and len(ORACLES) >= len(QUERIES) - 1
    assert all((q.__doc__ or "").strip() for q in qs.values())


@pytest.mark.parametrize("name", CHEAP)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "PERIODO_TARGET" in df.columns
