"""Print the physical plans of the silver parse and the gold metrics, and count their exchanges.

Usage: python scripts/show_plans.py [sf_dir]
Shows that file content is shuffled once (by file_hash), that config sides
are broadcast, and that no Python UDF is in the plan.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimflow.operators import audit as A  # noqa: E402
from claimflow.operators import bronze as B  # noqa: E402
from claimflow.operators import claims as C  # noqa: E402
from claimflow.operators import gold as G  # noqa: E402
from claimflow.session import local_session  # noqa: E402
from claimflow.sources.fixtures import fixture_profiles  # noqa: E402
from claimflow.sources.fixtures import render_landing  # noqa: E402


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(name: str, plan: str) -> None:
    ops = re.findall(r"^\(\d+\) (\w+)", plan, re.M)
    print(f"== {name}: {ops.count('Exchange')} exchanges, {ops.count('BroadcastExchange')} broadcasts, "
          f"{ops.count('Window')} windows, python UDFs: {sum(o.startswith(('BatchEvalPython', 'ArrowEvalPython', 'MapInPandas')) for o in ops)}")
    for m in re.finditer(r"^\((\d+)\) (Exchange|BroadcastExchange)[^\n]*\n(?:.*\n)*?Arguments: ([^\n]*)", plan, re.M):
        print(f"   ({m.group(1)}) {m.group(2)}: {m.group(3)[:110]}")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session(8)
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    render_landing(spark, sf_dir).write.parquet(f"{scratch}/landing")
    good, _ = B.split_rejects(B.ingest(spark.read.parquet(f"{scratch}/landing"), "r", "2024-01-01 00:00:00"))
    B.dedupe_by_hash(good).write.parquet(f"{scratch}/bronze")
    bronze = spark.read.parquet(f"{scratch}/bronze").repartition("file_hash")
    res = C.parse(bronze, fixture_profiles(spark), repartition=False)
    silver = C.to_silver(C.dedupe_claims(res["claims"]), "2024-01-01 00:00:00")
    plan = plan_of(silver)
    print(plan.split("\n\n(")[0])
    summary("silver claims", plan)
    silver.write.parquet(f"{scratch}/silver")
    s = spark.read.parquet(f"{scratch}/silver")
    gm = A.gold_metrics(*[G.NORMALIZERS[t](s, "r", "2024-01-01 00:00:00") for t in G.NORMALIZERS])
    summary("gold metrics (7 tables, one aggregation)", plan_of(gm))
    spark.stop()


if __name__ == "__main__":
    main()
