"""The rendered landing files: whole under repeated and null keys, and without a row a segment on the way."""

from datetime import datetime

import pytest

from claimflow.sources.fixtures import render_landing

T = datetime(1996, 1, 2)


@pytest.fixture
def tables(spark, tmp_path):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    put("nation", [(1, "N1")], "n_nationkey int, n_name string")
    put("customer", [(3, "C3", 1), (6, "C6a", 1), (6, "C6b", 1), (None, "C", 1)], "c_custkey bigint, c_name string, c_nationkey int")
    put("supplier", [(1, "S1")], "s_suppkey bigint, s_name string")
    put("orders", [(10, 3, "F", 1.5, T, "1-URGENT"), (2, 3, "O", 2.5, T, "x"), (2, 3, "O", 2.5, T, "x"), (None, 3, "F", 1.0, T, "x"),
                   (7, 6, "F", 3.0, T, "x"), (8, None, "F", 3.0, T, "x")],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    put("lineitem", [(10, 5, 1, 2, 1.0, 2.0, 0.0, 0.0, "N", "O", T), (10, 4, 1, 1, 1.0, 2.0, 0.0, 0.0, "N", "O", T),
                     (2, 9, None, 1, 1.0, 2.0, 0.0, 0.0, "R", "F", None), (None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", T)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    return str(tmp_path)


def test_files_are_whole(spark, tables):
    got = [(r.path.rsplit("/", 1)[1], r.content.decode().split("~")) for r in render_landing(spark, tables, with_kinds=False).collect()]
    files = dict(got)
    body = [t for t in files["c000000003.x12"] if t.split("*")[0] in ("CLM", "LX", "SV1", "NM1")]
    # orders by key; the repeated order's segments stand place by place, its line comes with each of the two
    assert [t.split("*")[:2] for t in body[2:]] == [
        ["CLM", "2"], ["CLM", "2"], ["LX", "1"], ["LX", "1"], ["SV1", "HC:P9:R:F"], ["SV1", "HC:P9:R:F"],
        ["CLM", "10"], ["NM1", "82"], ["LX", "1"], ["SV1", "HC:P4:N:O"], ["LX", "2"], ["SV1", "HC:P5:N:O"]]
    # a customer that is there twice has two files, each with both headers
    twice = [t for name, t in got if name == "c000000006.x12"]
    assert len(got) == 3 and len(twice) == 2 and twice[0] == twice[1]
    assert [t.split("*")[3] for t in twice[0] if t.startswith("NM1*IL")] == ["C6a", "C6b"]
    assert sum(t.startswith("CLM*7*") for t in twice[0]) == 2 and sum(t.startswith("SE*") for t in twice[0]) == 2


def test_no_segment_rows(spark, tables):
    plan = render_landing(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "Window" not in plan


def test_no_rendered_segment_is_shuffled(spark, tables):
    plan = render_landing(spark, tables, with_extras=True)._jdf.queryExecution().optimizedPlan().toString()
    orders = [x for x in plan.splitlines() if " AS order#" in x]
    assert "SV1" in plan and orders and not any(t in x for x in orders for t in ("SV1", "CLM", "ABK", "REF"))
