"""Registered queries vs their DuckDB oracles at sf0.001 (the full set runs in scripts/check_oracles.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

FAST = ["bronze_files", "delimiters_by_file", "transactions", "silver_claims", "parse_errors", "claim_keys",
        "service_lines_sv2", "providers", "merge_upsert", "merge_null_safe", "gold_metrics", "recon_files",
        "dq_results", "standardize_claims", "effective_steps"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(round(r[i], 6) if isinstance(r[i], float) else (str(r[i]) if hasattr(r[i], "isoformat") else r[i])
                 for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_registry_is_complete():
    from claimflow.plans import queries as own

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(own.queries()) <= set(q) and len(q) >= 45
    assert set(own.queries()) == set(own.oracle_sql())  # every query of the claims engine has its oracle


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert [r.vendor_id for r in rows] == ["vendorA", "vendorB", "vendorC"]
    assert sum(r.n_claims for r in rows) == 1369


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _norm(df.columns, [tuple(r) for r in df.collect()]) == _norm(d_cols, res.fetchall())
