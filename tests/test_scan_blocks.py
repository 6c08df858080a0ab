"""The two-level scan equals one scan, whatever the blocks; large files are read in ranges."""

import random

import pytest
from helpers import isa, landing
from pyspark.sql import functions as F

from claimflow.operators import bronze as B
from claimflow.operators import claims as C
from claimflow.operators import segments as S

STATE = ["file_hash", "text", "g", "in_txn", "k", "in_claim", "lx", "party_kind", "blk_off", "span_st", "clm_flag"]


def random_segments(rng, n):
    kinds = ["ST*837*{i}*V", "ST*835*{i}", "SE*1*{i}", "CLM*C{i}*1", "LX*{i}", "NM1*85*2*A*****XX*{i}", "NM1*IL*1*B", "SV1*HC:P*1*UN*1", "N3*x", "GS"]
    return [rng.choice(kinds).format(i=i) for i in range(n)]


def rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def gated(spark):
    rng = random.Random(9)
    files = [("vendorA", f"f{i}.x12", isa() + "~\n".join(random_segments(rng, rng.randint(0, 60))) + "~") for i in range(25)]
    good, _ = B.split_rejects(B.ingest(landing(spark, files), "r", "2024-01-01 00:00:00"))
    return S.resolve_delimiters(B.dedupe_by_hash(good)).cache()


@pytest.mark.parametrize("block", [1, 3, 8, 1000])
def test_blocks_of_any_size_give_the_same_state(spark, gated, block):
    columns = [*STATE, "pos", "party_pos", "last85_pos"]
    assert rows(S.segment_table(gated, block_segments=block), columns) == rows(S.segment_table(gated), columns)


def test_the_state_hangs_on_few_elements(spark, gated):
    segs = S.map_provider_codes(S.explode_segments(gated, keep=["file_path"]), None)
    columns = [*STATE, "pos", "party_pos", "last85_pos", "file_path"]
    slim = S.scan_elements(segs)
    assert rows(S.annotate(slim), columns) == rows(S.annotate(segs), columns)
    kept = slim.filter("el IS NOT NULL")
    assert kept.filter("size(el) > 4 OR tag NOT IN ('ST', 'LX', 'NM1')").count() == 0 < kept.count() < segs.count()


def test_claims_of_a_scan_in_blocks(spark, gated):
    files = gated.select("vendor_id", "file_hash", "file_path", "run_id", "content_str")
    columns = ["file_hash", "k", "claim_id", "st_control", "n_block_segments", "claim_block_text", "billing_npi", "subscriber_id"]
    whole, parts = C.parse(files)["claims"], C.parse(files, block_segments=4)["claims"]
    assert rows(parts, columns) == rows(whole, columns) and whole.count() > 20


def test_large_files_are_read_in_ranges(spark, tmp_path):
    rng = random.Random(4)
    text = isa() + "~".join(random_segments(rng, 4000)) + "~"
    path = tmp_path / "837" / "vendorA" / "big.x12"
    path.parent.mkdir(parents=True)
    path.write_text(text)
    good, _ = B.split_rejects(B.ingest(landing(spark, [("vendorA", "big.x12", text)]), "r", "2024-01-01 00:00:00"))
    gated = S.resolve_delimiters(good)
    files = gated.withColumn("path", F.lit(str(path))).select("path", "file_hash", "vendor_id", "element_delim", "component_delim")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        segs = S.read_blocks(spark, files, "~").cache()
        assert segs.select("blk").distinct().count() > 5
        got = rows(S.annotate(S.map_provider_codes(segs, None)), STATE)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == rows(S.segment_table(gated), STATE)


def test_a_segment_that_is_a_bare_identifier_belongs_to_its_span(spark):
    text = isa() + "ST*837*1*V~CLM*A*1~BARE~SE*1*1~ST*837*2*V~CLM*B*2~SE*1*2~"
    good, _ = B.split_rejects(B.ingest(landing(spark, [("vendorA", "a.x12", text)])))
    res = C.parse(good)
    assert res["transactions"].count() == 2 and res["errors"].count() == 0
