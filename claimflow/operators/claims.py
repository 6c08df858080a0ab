"""Silver claims from scanned files.

The parse keeps a file's segments in one array (:func:`segments.scan_files`):
the file's parties are a fold over it, its claims are slices of it, and a
claim's values are read from its slice, so no segment becomes a row.

From the segment table, which a scan in blocks needs, the same values come as
follows. Per-claim values are conditional aggregates over the claim's segment rows,
grouped by ``(file_hash, k)``; per-file parties and envelope are one
aggregate per file; transactions one per span. All of them are keyed by
``file_hash`` first, so they reuse the segment table's partitioning and the
final joins need no further shuffle of segment data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark import StorageLevel

from claimflow.functions.text import el, safe_double
from claimflow.operators import segments as S

# NM101 entity code -> provider role (unknown codes keep the
# code itself), and the roles kept as claim-level providers.
ROLE_MAP = {"85": "BILLING", "82": "RENDERING", "DN": "REFERRING", "77": "FACILITY",
            "72": "ATTENDING", "71": "OPERATING", "ZZ": "OTHER"}
CLAIM_PROVIDER_ROLES = ["RENDERING", "REFERRING", "FACILITY", "ATTENDING", "OPERATING"]
CLAIM_TEXT_CHARS = 4000

LINE_TYPE = (
    "array<struct<lx:string,revenue_code:string,qualifier:string,procedure_code:string,"
    "modifiers:array<string>,charge_amount:double,units:double>>"
)
DX_TYPE = "array<struct<diag_qualifier:string,diag_code:string,raw:string>>"
PROVIDER_FIELDS = ["role", "nm1_code", "entity_type", "last_name_or_org", "first_name", "id_qualifier", "id_value",
                   "npi", "addr1", "city", "state", "zip"]
PROVIDER_TYPE = "array<struct<" + ",".join(f"{f}:string" for f in PROVIDER_FIELDS) + ">>"
PARTY_FIELDS = ["member_id", "first_name", "last_name", "dob", "gender", "addr1", "city", "state", "zip"]
PARTY_TYPE = "struct<" + ",".join(f"{f}:string" for f in PARTY_FIELDS) + ">"
PAYER_TYPE = "array<struct<payer_name:string,payer_id:string>>"
REFERENCE_TYPE = "array<struct<ref_qualifier:string,ref_value:string>>"

SILVER_COLUMNS = [
    "vendor_id", "file_hash", "file_path", "run_id", "parse_ts", "isa_control", "gs_control", "st_control",
    "transaction_version", "claim_id", "claim_amount", "place_of_service", "subscriber_id", "patient_id",
    "billing_npi", "rendering_npi", "claim_from_dt", "claim_to_dt", "service_lines_json", "claim_block_text",
    "diagnosis_json", "providers_json", "subscriber_json", "patient_json", "other_payer_json",
]
ERROR_COLUMNS = ["vendor_id", "file_hash", "file_path", "run_id", "parse_ts", "error_stage", "error_message", "sample_text"]


def _truthy(c: Column) -> Column:
    """Python truthiness of an optional string: not NULL and not empty."""
    return c.isNotNull() & (c != "")


def _default_role(code: Column) -> Column:
    role_map = F.create_map(*[F.lit(x) for kv in ROLE_MAP.items() for x in kv])
    return F.try_element_at(role_map, code)


def _id_or_last(e: Column) -> Column:
    """Element 9, or the last element when the segment is shorter."""
    return F.when(F.size(e) > 9, el(e, 9)).otherwise(F.element_at(e, -1))


def nm1_info(e: Column, mapped_role: Column) -> Column:
    """NM1 segment -> provider struct (address fields NULL).

    The role is the configured one (``mapped_role``), else the default of the code, else the code.
    """
    code = el(e, 1)
    idq = el(e, 8)
    ident = _id_or_last(e)
    return F.struct(
        F.coalesce(mapped_role, _default_role(code), code).alias("role"),
        code.alias("nm1_code"),
        el(e, 2).alias("entity_type"),
        el(e, 3).alias("last_name_or_org"),
        el(e, 4).alias("first_name"),
        idq.alias("id_qualifier"),
        ident.alias("id_value"),
        F.when(idq == "XX", ident).alias("npi"),
        *[F.lit(None).cast("string").alias(f) for f in ["addr1", "city", "state", "zip"]],
    )


def _components(text: Column, comp_re: Column) -> Column:
    return F.split(text, comp_re, -1)


def _rest(arr: Column, start1: int) -> Column:
    """``arr[start1-1:]`` as in Python slicing (1-based start)."""
    return F.slice(arr, start1, F.greatest(F.size(arr) - (start1 - 1), F.lit(0)))


def service_line(e: Column, c1: Column, c2: Column, sv2_ref: Column, lx: Column) -> Column:
    """SV1 / SV2 segment -> line struct, from the split composites ``c1`` / ``c2``.

    SV1: ``el[1]`` = qualifier:code:modifiers, charge ``el[2]``, units ``el[4]``.
    SV2 with the component delimiter inside ``el[1]``: revenue:qualifier:code:
    modifiers, charge ``el[2]``, units ``el[4]``; otherwise the standard 837I
    layout: revenue ``el[1]``, composite ``el[2]``, charge ``el[3]``, units ``el[5]``.
    """
    tag = el(e, 0)
    e1 = el(e, 1)
    sv2_std = (tag == "SV2") & ~sv2_ref
    empty = F.array().cast("array<string>")
    revenue = F.when(sv2_ref, el(c1, 0)).when(sv2_std & _truthy(e1), e1)
    qualifier = F.when(tag == "SV1", el(c1, 0)).when(sv2_ref, el(c1, 1)).otherwise(el(c2, 0))
    proc = F.when(tag == "SV1", el(c1, 1)).when(sv2_ref, el(c1, 2)).otherwise(el(c2, 1))
    mods = (
        F.when(tag == "SV1", F.coalesce(_rest(c1, 3), empty))
        .when(sv2_ref, F.coalesce(_rest(c1, 4), empty))
        .otherwise(F.coalesce(_rest(c2, 3), empty))
    )
    charge = F.when(sv2_std, safe_double(el(e, 3))).otherwise(safe_double(el(e, 2)))
    units = F.when(sv2_std, safe_double(el(e, 5))).otherwise(safe_double(el(e, 4)))
    return F.struct(
        lx.alias("lx"), revenue.alias("revenue_code"), qualifier.alias("qualifier"), proc.alias("procedure_code"),
        mods.alias("modifiers"), charge.alias("charge_amount"), units.alias("units"),
    )


def diagnoses_of(e: Column, comp_re: Column) -> Column:
    """HI segment -> array of diagnosis structs (empty tokens skipped, kept if qualifier or code)."""
    tokens = F.filter(_rest(e, 2), lambda t: t != "")
    parsed = F.transform(
        F.transform(tokens, lambda t: F.struct(t.alias("raw"), F.split(t, comp_re, -1).alias("c"))),
        lambda x: F.struct(el(x["c"], 0).alias("diag_qualifier"), el(x["c"], 1).alias("diag_code"), x["raw"].alias("raw")),
    )
    return F.filter(parsed, lambda d: _truthy(d["diag_qualifier"]) | _truthy(d["diag_code"]))


def _sorted_values(col: Column, field: str = "v") -> Column:
    """collect_list of struct(pos, v) -> values ordered by pos."""
    return F.transform(F.array_sort(col), lambda x: x[field])


def claim_rows(seg: DataFrame) -> DataFrame:
    """One row per claim block: ``file_hash, g, k`` + claim values (typed arrays).

    Row-level values (line struct, diagnosis array, provider struct, ...) are
    computed once in a projection; the aggregation then only picks and
    collects plain columns.
    """
    tag = F.col("tag")
    e = F.col("el")
    pos = F.col("pos")
    is_dtp = (tag == "DTP") & (F.size(e) >= 4)
    is_nm1 = tag == "NM1"
    comp_d = F.col("component_delim")
    comp_re = F.col("comp_re")
    is_sv = tag.isin("SV1", "SV2")
    # step 1: split composites once per row (kept as columns, not repeated inside CASE branches)
    pre = seg.filter(F.col("in_claim")).select(
        "file_hash", "k", "g", "pos", "clm_flag", "segment_delim", "component_delim", "comp_re", "blk_off", "el", "tag",
        "lx", "text", "span_st", "mapped_role",
        F.when(is_sv & _truthy(el(e, 1)), F.split(el(e, 1), comp_re, -1)).alias("_c1"),
        F.when((tag == "SV2") & _truthy(el(e, 2)), F.split(el(e, 2), comp_re, -1)).alias("_c2"),
        ((tag == "SV2") & F.coalesce(F.instr(el(e, 1), comp_d) > 0, F.lit(False))).alias("_sv2ref"),
        F.when(tag == "HI", comp_re).alias("_comp_re"),
    )
    # step 2: row values
    rows = pre.select(
        "file_hash", "k", "g", "pos", "clm_flag", "segment_delim", "comp_re", "blk_off",
        F.when(F.col("clm_flag"), F.col("span_st")).alias("_span"),
        F.when(F.col("clm_flag"), e).alias("_clm_el"),
        F.when(is_dtp & (el(e, 1) == "434"), el(e, 3)).alias("_d434"),
        F.when(is_dtp & (el(e, 1) == "472"), el(e, 3)).alias("_d472"),
        F.when(is_sv, service_line(e, F.col("_c1"), F.col("_c2"), F.col("_sv2ref"), F.col("lx"))).alias("_line"),
        F.when(tag == "HI", diagnoses_of(e, F.col("_comp_re"))).alias("_dxs"),
        F.when(is_nm1, nm1_info(e, F.col("mapped_role"))).alias("_nm1"),
        F.when(tag == "REF", F.struct(el(e, 1).alias("ref_qualifier"), el(e, 2).alias("ref_value"))).alias("_ref"),
        F.when(is_nm1 & (F.size(e) > 2) & (el(e, 1) == "PR"),
               F.struct(el(e, 3).alias("payer_name"), _id_or_last(e).alias("payer_id"))).alias("_payer"),
        F.when(F.col("blk_off") < CLAIM_TEXT_CHARS, F.col("text")).alias("_txt"),
    )
    # a configured role renames what the code stands for; it can add a code to the claim's providers, not take one away
    default = _default_role(F.col("_nm1.nm1_code"))
    is_prov = F.col("_nm1.role").isin(*CLAIM_PROVIDER_ROLES) | F.coalesce(default.isin(*CLAIM_PROVIDER_ROLES), F.lit(False))
    renders = (F.col("_nm1.role") == "RENDERING") | F.coalesce(default == "RENDERING", F.lit(False))

    def keyed(c: str, cond: Column | None = None) -> Column:
        v = F.col(c)
        ok = v.isNotNull() if cond is None else cond
        return F.collect_list(F.when(ok, F.struct(pos.alias("p"), v.alias("v"))))

    aggs = [
        F.first("g").alias("g"),
        F.first("segment_delim").alias("_seg_d"),
        F.first("comp_re").alias("_comp_re"),
        F.min_by(F.col("_clm_el"), F.when(F.col("clm_flag"), pos)).alias("clm"),
        F.min_by(F.col("_span"), F.when(F.col("clm_flag"), pos)).alias("_span"),
        F.min_by(F.col("_d434"), F.when(F.col("_d434").isNotNull(), pos)).alias("from_434"),
        F.min("_d472").alias("min_472"),
        F.max("_d472").alias("max_472"),
        F.max(F.col("_d472").isNotNull()).alias("has_472"),
        keyed("_line").alias("_lines"),
        keyed("_dxs").alias("_dx"),
        keyed("_nm1", F.coalesce(is_prov, F.lit(False))).alias("_prov"),
        F.max_by(F.col("_nm1.npi"), F.when(renders & _truthy(F.col("_nm1.npi")), pos)).alias("rendering_npi"),
        keyed("_payer").alias("_payers"),
        keyed("_ref").alias("_refs"),
        keyed("_txt").alias("_text"),
        F.count(F.lit(1)).alias("n_block_segments"),
    ]
    claims = rows.groupBy("file_hash", "k").agg(*aggs)

    clm = F.col("clm")
    pos_el = el(clm, 5)
    dx = F.flatten(_sorted_values(F.col("_dx")))
    prov = _sorted_values(F.col("_prov"))
    payers = _sorted_values(F.col("_payers"))
    refs = _sorted_values(F.col("_refs"))
    from_434 = F.col("from_434")
    return claims.select(
        "file_hash", "g", "k", "n_block_segments",
        F.col("_span.st_control").alias("st_control"),
        F.col("_span.transaction_version").alias("transaction_version"),
        el(clm, 1).alias("claim_id"),
        safe_double(el(clm, 2)).alias("claim_amount"),
        F.when(_truthy(pos_el), el(_components(pos_el, F.col("_comp_re")), 0)).alias("place_of_service"),
        F.when(F.col("has_472"), F.when(_truthy(from_434), from_434).otherwise(F.col("min_472"))).otherwise(from_434).alias("claim_from_dt"),
        F.when(F.col("has_472"), F.col("max_472")).alias("claim_to_dt"),
        _sorted_values(F.col("_lines")).alias("service_lines"),
        F.when(F.size(dx) > 0, dx).alias("diagnoses"),
        prov.alias("claim_providers"),
        "rendering_npi",
        F.when(F.size(payers) > 0, payers).alias("other_payers"),
        F.when(F.size(refs) > 0, refs).alias("references"),
        F.substring(
            F.call_function("array_join", _sorted_values(F.col("_text")), F.col("_seg_d")), 1, CLAIM_TEXT_CHARS
        ).alias("claim_block_text"),
    )


RANK_COLUMNS = ["claims_with_id", "newer_claims"]


def _with_ranks(scan: DataFrame, ids: Column) -> DataFrame:
    """Add ``_ranks``: :data:`RANK_COLUMNS` of each of a file's claims, from the claims' ids in order; NULL when all ids differ.

    The claims sorted by id are cut into runs of one id. Every step is a column, so that none is worked out once an element.
    """
    s = scan.withColumn("_ids", ids)
    repeated = F.size(F.array_distinct("_ids")) < F.size("_ids")
    s = s.withColumn("_placed", F.when(repeated, F.sort_array(F.transform("_ids", lambda x, i: F.struct(x.alias("id"), i.alias("i"))))))
    s = s.withColumn("_starts", S.places("_placed", lambda x, i: (i == 0) | (x["id"] != F.get("_placed", i - 1)["id"])))
    runs = F.transform("_starts", lambda a, j: F.slice(
        "_placed", a + 1, F.coalesce(F.get("_starts", j + 1), F.size("_placed")) - a))
    ranked = F.flatten(F.transform(runs, lambda run: F.transform(run, lambda x, q: F.struct(
        x["i"].alias("i"), F.size(run).cast("long").alias("claims_with_id"), (F.size(run) - 1 - q).alias("newer_claims")))))
    return s.withColumn("_ranks", F.sort_array(ranked)).drop("_ids", "_placed", "_starts")


def scanned_claims(scan: DataFrame, keep: list[str]) -> DataFrame:
    """:func:`claim_rows` of scanned files, with the columns ``keep`` of the file: a claim is a slice of the file's segments."""
    own = ["segment_delim", "component_delim", "el_re", "comp_re", "own_roles", "all_roles"]
    comp_d, comp_re, el_re = F.col("component_delim"), F.col("comp_re"), F.col("el_re")
    at = F.flatten(F.transform("spans", lambda s: F.transform(s["clms"], lambda p, j: F.struct(
        s["g"].alias("g"), s["st"].alias("st"), p.alias("a"), F.coalesce(F.get(s["clms"], j + 1), s["z"]).alias("z")))))
    # slices are cut after the flatten: each array that a nested transform returns is copied with all its texts
    slices = F.transform("_claims", lambda c, i: F.struct(
        c["g"].alias("g"), c["st"].alias("st"), F.slice("texts", c["a"] + 1, c["z"] - c["a"]).alias("segs"),
        F.slice("tags", c["a"] + 1, c["z"] - c["a"]).alias("tags"), F.get("_ranks", i).alias("rank")))
    # an outer explode: Spark would work out the array of a plain one twice, to leave out empty ones before it
    c = scan.withColumn("_claims", at)
    def id_of(st_control: Column, claim_id: Column) -> Column:
        """Both as one text, by the length of the first; NULL and '' differ."""
        return F.concat(F.coalesce(F.length(st_control), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(st_control, F.lit("")),
                        F.when(claim_id.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), claim_id)))

    c = _with_ranks(c, F.transform("_claims", lambda c: id_of(el(c["st"], 2), el(F.split(F.get("texts", c["a"]), el_re, 3), 1))))
    c = c.select("file_hash", *keep, *own, F.posexplode_outer(slices).alias("_at", "_c")).filter(F.col("_at").isNotNull())
    c = c.select("file_hash", *keep, *own, (F.col("_at") + 1).cast("long").alias("k"), "_c.g", "_c.st", "_c.segs", "_c.tags",
                 F.coalesce("_c.rank.claims_with_id", F.lit(1).cast("long")).alias("claims_with_id"),
                 F.coalesce("_c.rank.newer_claims", F.lit(0)).alias("newer_claims"))

    def elements(t: Column) -> Column:
        return F.split(t, el_re, -1)

    def of(tag: str) -> Column:
        return F.transform(F.filter("segs", lambda t, i: F.get("tags", i) == tag), elements)

    def dates(code: str) -> Column:
        return F.transform(F.filter("_dtp", lambda e: (F.size(e) >= 4) & (el(e, 1) == code)), lambda e: el(e, 3))

    # only the segments that a value is read from are split into elements
    c = c.withColumns({
        "_lx": S.places("tags", lambda t, i: t == "LX"), "_nm1": of("NM1"), "_hi": of("HI"), "_ref": of("REF"), "_dtp": of("DTP"),
        "clm": elements(F.get("segs", F.lit(0))),
    })
    c = c.withColumns({"_d434": dates("434"), "_d472": dates("472")})
    # the segments before the first LX, and those from each LX to the next
    parts = F.transform(F.sequence(F.lit(0), F.size("_lx")), lambda i: F.struct(
        F.get("_lx", i - 1).alias("at"), F.coalesce(F.get("_lx", i - 1), F.lit(0)).alias("a"),
        F.coalesce(F.get("_lx", i), F.size("segs")).alias("z")))
    lined = F.flatten(F.transform(parts, lambda p: F.transform(
        F.filter(F.sequence(p["a"], p["z"] - 1), lambda i: F.get("tags", i).isin("SV1", "SV2")),
        lambda i: F.struct(i.alias("i"), p["at"].alias("at")))))
    lined = F.transform(lined, lambda x: F.struct(
        elements(F.get("segs", x["i"])).alias("e"), el(elements(F.get("segs", x["at"])), 1).alias("lx")))
    composites = F.transform(lined, lambda x: F.struct(
        x["e"].alias("e"), x["lx"].alias("lx"),
        F.when(_truthy(el(x["e"], 1)), F.split(el(x["e"], 1), comp_re, -1)).alias("c1"),
        F.when((el(x["e"], 0) == "SV2") & _truthy(el(x["e"], 2)), F.split(el(x["e"], 2), comp_re, -1)).alias("c2"),
        ((el(x["e"], 0) == "SV2") & F.coalesce(F.instr(el(x["e"], 1), comp_d) > 0, F.lit(False))).alias("ref")))
    named = F.transform("_nm1", lambda e: nm1_info(e, S.mapped_role(el(e, 1))))
    payers = F.transform(F.filter("_nm1", lambda e: (F.size(e) > 2) & (el(e, 1) == "PR")),
                         lambda e: F.struct(el(e, 3).alias("payer_name"), _id_or_last(e).alias("payer_id")))
    c = c.withColumns({
        "service_lines": F.transform(composites, lambda x: service_line(x["e"], x["c1"], x["c2"], x["ref"], x["lx"])),
        "_dx": F.flatten(F.transform("_hi", lambda e: diagnoses_of(e, comp_re))),
        "_named": named, "_payers": payers,
        "_refs": F.transform("_ref", lambda e: F.struct(el(e, 1).alias("ref_qualifier"), el(e, 2).alias("ref_value"))),
    })
    # a configured role renames what the code stands for; it can add a code to the claim's providers, not take one away
    is_prov = lambda x: x["role"].isin(*CLAIM_PROVIDER_ROLES) | F.coalesce(_default_role(x["nm1_code"]).isin(*CLAIM_PROVIDER_ROLES), F.lit(False))
    renders = lambda x: (x["role"] == "RENDERING") | F.coalesce(_default_role(x["nm1_code"]) == "RENDERING", F.lit(False))
    c = c.withColumn("_rend", F.filter("_named", lambda x: renders(x) & _truthy(x["npi"])))
    clm, pos_el, from_434, has_472 = F.col("clm"), el("clm", 5), F.get("_d434", F.lit(0)), F.size("_d472") > 0
    return c.select(
        "file_hash", *keep, "g", "k", *RANK_COLUMNS,
        F.size("segs").cast("long").alias("n_block_segments"),
        el("st", 2).alias("st_control"),
        el("st", 3).alias("transaction_version"),
        el(clm, 1).alias("claim_id"),
        safe_double(el(clm, 2)).alias("claim_amount"),
        F.when(_truthy(pos_el), el(_components(pos_el, comp_re), 0)).alias("place_of_service"),
        F.when(has_472 & ~F.coalesce(_truthy(from_434), F.lit(False)), F.array_min("_d472")).otherwise(from_434).alias("claim_from_dt"),
        F.when(has_472, F.array_max("_d472")).alias("claim_to_dt"),
        "service_lines",
        F.when(F.size("_dx") > 0, F.col("_dx")).alias("diagnoses"),
        F.filter("_named", is_prov).alias("claim_providers"),
        F.get("_rend", F.size("_rend") - 1)["npi"].alias("rendering_npi"),
        F.when(F.size("_payers") > 0, F.col("_payers")).alias("other_payers"),
        F.when(F.size("_refs") > 0, F.col("_refs")).alias("references"),
        F.substring(F.call_function("array_join", F.col("segs"), F.col("segment_delim")), 1, CLAIM_TEXT_CHARS).alias("claim_block_text"),
    )


PARTY_COLUMNS = ["billing_provider", "billing_npi", "subscriber", "patient", "subscriber_id", "patient_id"]


def scanned_parties(scan: DataFrame) -> DataFrame:
    """Scanned files with the columns of :func:`file_parties` (a file without segments has 0 of them).

    One fold over the file's party segments keeps the last segment of each kind, by its elements.
    """
    el_re = F.col("el_re")

    def first(tag: str, i: int) -> Column:
        at = F.array_position("tags", tag).cast("int") - 1
        return el(F.split(F.get("texts", at), el_re, -1), i)

    is_party = lambda e: (el(e, 0) != "NM1") | ((F.size(e) > 2) & el(e, 1).isin("85", "IL", "QC"))
    texts = F.filter("texts", lambda t, i: F.get("tags", i).isin("NM1", "N3", "N4", "DMG"))
    segments = F.filter(F.transform(texts, lambda t: F.split(t, el_re, -1)), is_party)
    kept = [f"{p}_{t}" for p in ("85", "IL", "QC") for t in ("NM1", "N3", "N4", "DMG")]

    def step(acc: Column, e: Column) -> Column:
        marker = el(e, 0) == "NM1"
        kind = F.when(marker, el(e, 1)).otherwise(acc["kind"])
        out = [kind.alias("kind")]
        for name in kept:
            p, t = name.split("_")
            old = acc[name]
            if p == "85" and t != "NM1":  # the address of the last billing NM1 only
                old = F.when(~(marker & (el(e, 1) == "85")), old)
            here = (el(e, 0) == t) & F.coalesce(kind == p, F.lit(False))
            out.append(F.when(here, e).otherwise(old).alias(name))
        return F.struct(*out)

    start = F.struct(F.lit(None).cast("string").alias("kind"), *[F.lit(None).cast("array<string>").alias(n) for n in kept])
    f = scan.withColumn("_party", F.aggregate(segments, start, step))
    last = {n: F.col(f"_party.{n}") for n in kept}
    names = {n: F.when(last[n].isNotNull(), _id_or_last(last[n])) for n in ("IL_NM1", "QC_NM1")}

    def party(p: str) -> Column:
        nm1, dmg, n3, n4 = (last[f"{p}_{t}"] for t in ("NM1", "DMG", "N3", "N4"))
        return F.struct(
            names[f"{p}_NM1"].alias("member_id"), el(nm1, 4).alias("first_name"), el(nm1, 3).alias("last_name"),
            el(dmg, 2).alias("dob"), el(dmg, 3).alias("gender"), el(n3, 1).alias("addr1"),
            el(n4, 1).alias("city"), el(n4, 2).alias("state"), el(n4, 3).alias("zip"),
        )

    bill, n4 = last["85_NM1"], last["85_N4"]
    info = nm1_info(bill, S.mapped_role(el(bill, 1)))
    f = f.withColumns({
        "n_segments": F.size("texts").cast("long"), "isa_control": first("ISA", 13), "gs_control": first("GS", 6),
        "found_837": F.size("spans") > 0,
        "_bill": F.when(bill.isNotNull(), info),
        "subscriber": F.when(last["IL_NM1"].isNotNull(), party("IL")), "_patient": F.when(last["QC_NM1"].isNotNull(), party("QC")),
    })
    address = {"addr1": el(last["85_N3"], 1), "city": el(n4, 1), "state": el(n4, 2), "zip": el(n4, 3)}
    billing = F.struct(*[address[c].alias(c) if c in address else F.col(f"_bill.{c}").alias(c) for c in PROVIDER_FIELDS])
    pat_member = F.col("_patient.member_id")
    return f.withColumns({
        "billing_provider": F.when(F.col("_bill").isNotNull(), billing),
        "billing_npi": F.col("_bill.npi"),
        "patient": F.coalesce("_patient", "subscriber"),
        "subscriber_id": F.col("subscriber.member_id"),
        "patient_id": F.when(_truthy(pat_member), pat_member).otherwise(F.col("subscriber.member_id")),
    }).drop("_party", "_bill", "_patient")


def party_rows(whole: DataFrame) -> DataFrame:
    """:func:`file_parties` of :func:`scanned_parties`: one row per file with segments.

    The rows come out of an explode, so that a filter on them is not worked out from the file's text once more.
    """
    values = F.struct("n_segments", "isa_control", "gs_control", "found_837", *PARTY_COLUMNS)
    p = whole.select("file_hash", F.explode_outer(F.when(F.col("n_segments") > 0, F.array(values))).alias("p"))
    return p.filter(F.col("p").isNotNull()).select("file_hash", "p.*")


def scanned_errors(gated: DataFrame, whole: DataFrame) -> DataFrame:
    """:func:`parse_errors` of scanned files: a file's errors are read from its spans, without a join."""
    own = ["file_hash", "vendor_id", "file_path", "run_id"]
    gate = F.col("gate_error")
    closed = gated.filter(gate.isNotNull()).select(
        "file_hash", gate.alias("error_stage"),
        F.when(gate == S.ERR_BASIC[0], F.lit(S.ERR_BASIC[1])).otherwise(F.lit(S.ERR_DELIMS[1])).alias("error_message"),
        *own[1:], F.substring("content_str", 1, S.ERROR_SAMPLE_CHARS).alias("sample_text"),
    )
    some = F.col("n_segments") > 0
    found = [(S.ERR_SPLIT, ~some), (S.ERR_NO_ST837, some & ~F.col("found_837")),
             (S.ERR_NO_CLM, F.exists("spans", lambda s: F.size(s["clms"]) == 0))]
    errs = F.array_compact(F.array(*[
        F.when(cond, F.struct(F.lit(stage).alias("error_stage"), F.lit(message).alias("error_message"))) for (stage, message), cond in found]))
    rows = whole.select(*own, "sample_text", F.explode_outer(errs).alias("e")).filter(F.col("e").isNotNull())
    return closed.unionByName(rows.select("file_hash", "e.*", *own[1:], "sample_text"))


def file_parties(seg: DataFrame) -> DataFrame:
    """Per file: envelope controls, billing provider, subscriber and patient (file scope, last wins)."""
    tag = F.col("tag")
    e = F.col("el")
    pos = F.col("pos")
    marker = F.col("marker")
    kind = F.col("party_kind")

    def under(p: str, t: str) -> Column:
        return F.when((tag == t) & (kind == p), pos)

    bill_cond = lambda t: F.when((tag == t) & (kind == "85") & (F.col("party_pos") == F.col("last85_pos")), pos)
    aggs = [
        F.count(F.lit(1)).alias("n_segments"),
        F.min_by(el(e, 13), F.when(tag == "ISA", pos)).alias("isa_control"),
        F.min_by(el(e, 6), F.when(tag == "GS", pos)).alias("gs_control"),
        F.max(F.col("is_st837")).alias("found_837"),
        F.max_by(nm1_info(e, F.col("mapped_role")), F.when(marker == "85", pos)).alias("_bill"),
        F.max_by(el(e, 1), bill_cond("N3")).alias("_bill_n3"),
        F.max_by(F.struct(el(e, 1).alias("city"), el(e, 2).alias("state"), el(e, 3).alias("zip")), bill_cond("N4")).alias("_bill_n4"),
    ]
    for p, name in (("IL", "sub"), ("QC", "pat")):
        aggs += [
            F.max(marker == p).alias(f"_has_{name}"),
            F.max_by(F.struct(_id_or_last(e).alias("member_id"), el(e, 3).alias("last_name"), el(e, 4).alias("first_name")),
                     F.when(marker == p, pos)).alias(f"_{name}_nm1"),
            F.max_by(F.struct(el(e, 2).alias("dob"), el(e, 3).alias("gender")), under(p, "DMG")).alias(f"_{name}_dmg"),
            F.max_by(el(e, 1), under(p, "N3")).alias(f"_{name}_n3"),
            F.max_by(F.struct(el(e, 1).alias("city"), el(e, 2).alias("state"), el(e, 3).alias("zip")), under(p, "N4")).alias(f"_{name}_n4"),
        ]
    f = seg.groupBy("file_hash").agg(*aggs)

    def party(name: str) -> Column:
        return F.struct(
            F.col(f"_{name}_nm1.member_id").alias("member_id"),
            F.col(f"_{name}_nm1.first_name").alias("first_name"),
            F.col(f"_{name}_nm1.last_name").alias("last_name"),
            F.col(f"_{name}_dmg.dob").alias("dob"),
            F.col(f"_{name}_dmg.gender").alias("gender"),
            F.col(f"_{name}_n3").alias("addr1"),
            F.col(f"_{name}_n4.city").alias("city"),
            F.col(f"_{name}_n4.state").alias("state"),
            F.col(f"_{name}_n4.zip").alias("zip"),
        )

    has_sub = F.coalesce(F.col("_has_sub"), F.lit(False))
    has_pat = F.coalesce(F.col("_has_pat"), F.lit(False))
    subscriber = F.when(has_sub, party("sub"))
    patient = F.when(has_pat, party("pat")).otherwise(subscriber)
    sub_id = F.col("_sub_nm1.member_id")
    pat_member = F.when(has_pat, F.col("_pat_nm1.member_id"))
    billing = F.when(
        F.col("_bill").isNotNull(),
        F.col("_bill")
        .withField("addr1", F.col("_bill_n3"))
        .withField("city", F.col("_bill_n4.city"))
        .withField("state", F.col("_bill_n4.state"))
        .withField("zip", F.col("_bill_n4.zip")),
    )
    return f.select(
        "file_hash", "n_segments", "isa_control", "gs_control",
        F.coalesce(F.col("found_837"), F.lit(False)).alias("found_837"),
        billing.alias("billing_provider"),
        F.col("_bill.npi").alias("billing_npi"),
        subscriber.alias("subscriber"),
        patient.alias("patient"),
        sub_id.alias("subscriber_id"),
        F.when(_truthy(pat_member), pat_member).otherwise(sub_id).alias("patient_id"),
    )


def preceding_parties(seg: DataFrame) -> DataFrame:
    """Per claim: billing provider, subscriber and patient as they stood at the claim's CLM segment.

    The same overlay rules as the file scope (last segment wins per group,
    NULLs included), but only segments before the CLM count: running
    ``last(..., ignorenulls)`` windows over the segment order, read at the
    CLM row. Keyed by ``(file_hash, k)``.
    """
    w = Window.partitionBy("file_hash").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tag, e, kind, marker = F.col("tag"), F.col("el"), F.col("party_kind"), F.col("marker")

    def last(cond: Column, value: Column) -> Column:
        return F.last(F.when(cond, value), True).over(w)

    cols = {
        "_bill": last(marker == "85", F.struct(F.col("pos").alias("at"), nm1_info(e, F.col("mapped_role")).alias("v"))),
        "_bill_n3": last((tag == "N3") & (kind == "85"), F.struct(F.col("party_pos").alias("at"), el(e, 1).alias("v"))),
        "_bill_n4": last((tag == "N4") & (kind == "85"), F.struct(F.col("party_pos").alias("at"), el(e, 1).alias("city"),
                                                                   el(e, 2).alias("state"), el(e, 3).alias("zip"))),
    }
    for p, name in (("IL", "sub"), ("QC", "pat")):
        cols[f"_{name}_nm1"] = last(marker == p, F.struct(_id_or_last(e).alias("member_id"), el(e, 3).alias("last_name"),
                                                          el(e, 4).alias("first_name")))
        cols[f"_{name}_dmg"] = last((tag == "DMG") & (kind == p), F.struct(el(e, 2).alias("dob"), el(e, 3).alias("gender")))
        cols[f"_{name}_n3"] = last((tag == "N3") & (kind == p), F.struct(el(e, 1).alias("v")))
        cols[f"_{name}_n4"] = last((tag == "N4") & (kind == p), F.struct(el(e, 1).alias("city"), el(e, 2).alias("state"),
                                                                         el(e, 3).alias("zip")))
    at_clm = seg.select("file_hash", "k", "clm_flag", *[v.alias(n) for n, v in cols.items()]).filter(F.col("clm_flag"))

    def party(name: str) -> Column:
        return F.struct(
            F.col(f"_{name}_nm1.member_id").alias("member_id"), F.col(f"_{name}_nm1.first_name").alias("first_name"),
            F.col(f"_{name}_nm1.last_name").alias("last_name"), F.col(f"_{name}_dmg.dob").alias("dob"),
            F.col(f"_{name}_dmg.gender").alias("gender"), F.col(f"_{name}_n3.v").alias("addr1"),
            F.col(f"_{name}_n4.city").alias("city"), F.col(f"_{name}_n4.state").alias("state"),
            F.col(f"_{name}_n4.zip").alias("zip"),
        )

    same = lambda c: F.col(f"{c}.at") == F.col("_bill.at")  # noqa: E731 - address of the current billing NM1 only
    billing = F.when(F.col("_bill").isNotNull(), F.col("_bill.v")
                     .withField("addr1", F.when(same("_bill_n3"), F.col("_bill_n3.v")))
                     .withField("city", F.when(same("_bill_n4"), F.col("_bill_n4.city")))
                     .withField("state", F.when(same("_bill_n4"), F.col("_bill_n4.state")))
                     .withField("zip", F.when(same("_bill_n4"), F.col("_bill_n4.zip"))))
    subscriber = F.when(F.col("_sub_nm1").isNotNull(), party("sub"))
    pat_member = F.col("_pat_nm1.member_id")
    sub_id = F.col("_sub_nm1.member_id")
    return at_clm.select(
        "file_hash", "k",
        billing.alias("billing_provider"), F.col("_bill.v.npi").alias("billing_npi"),
        subscriber.alias("subscriber"),
        F.when(F.col("_pat_nm1").isNotNull(), party("pat")).otherwise(subscriber).alias("patient"),
        sub_id.alias("subscriber_id"),
        F.when(_truthy(pat_member), pat_member).otherwise(sub_id).alias("patient_id"),
    )


def parse(files: DataFrame, profiles: DataFrame | None = None, num_partitions: int | None = None,
          persist: bool = False, party_scope: str = "file", repartition: bool = True, params: DataFrame | None = None,
          role_map: DataFrame | None = None, block_segments: int | None = None,
          keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Bronze rows -> ``{"claims", "ranked", "errors", "segments", "transactions", "parties", "files"}``.

    ``claims`` is one row per claim with typed nested columns (use
    :func:`to_silver` for the JSON table shape); ``ranked`` is the same with
    the columns of :func:`rank_claims`, which a scan of files reads from each
    file without a window (bronze has a row a content); ``errors`` one row per
    (file, stage, message). Pass ``repartition=False`` for input already
    hash-partitioned by ``file_hash``. ``party_scope="preceding"`` gives each claim the
    parties in force at its CLM segment instead of the file's last ones.
    ``params`` (``vendor_id, params``) override profile fields, ``role_map`` is
    the configured NM1 role map. Claims carry the columns ``keep`` of their file, so that
    nobody has to join them to it.

    The files are scanned as arrays of segments (:func:`segments.scan_files`), a
    row a claim; the errors are read from the spans and need no claim.
    ``block_segments`` scans files on two levels instead, as rows of segments,
    for files too large for one task. That segment table feeds three
    aggregations (claims, spans, parties) and the errors; with ``persist=True``
    it is computed once and kept (memory, spilling to local disk; lost blocks
    are recomputed from the input) — the caller unpersists
    ``result["segments"]`` when done.
    """
    gated = S.resolve_delimiters(files, profiles, params)
    if party_scope not in ("file", "preceding"):
        raise ValueError(f"party_scope must be 'file' or 'preceding', not {party_scope!r}")
    seg = S.segment_table(gated, num_partitions, repartition, role_map, block_segments)
    if not block_segments:
        scan = S.scan_files(gated, num_partitions, repartition, role_map, keep)
        txn = S.span_rows(scan)
        whole = scanned_parties(scan)
        own = ["vendor_id", "file_path", "run_id", "isa_control", "gs_control", *keep]
        claims = scanned_claims(whole, own + (PARTY_COLUMNS if party_scope == "file" else []))
        parties = party_rows(whole)
        errors = scanned_errors(gated, whole)
    else:
        if persist:
            seg = seg.persist(StorageLevel.MEMORY_AND_DISK)
        txn = S.transactions(seg)
        parties = file_parties(seg)
        if persist:  # one row per span / per file: small, and read by both the claims and the errors
            txn = txn.persist(StorageLevel.MEMORY_AND_DISK)
            parties = parties.persist(StorageLevel.MEMORY_AND_DISK)
        # span controls come with the claim rows (carried by the windows): only file_hash joins below
        own = parties if party_scope == "file" else parties.select("file_hash", "isa_control", "gs_control")
        meta = gated.select("file_hash", "vendor_id", "file_path", "run_id", *keep)
        claims = claim_rows(seg).join(meta, "file_hash", "inner").join(own, "file_hash", "inner")
        errors = parse_errors(gated, parties, txn, meta)
    if party_scope == "preceding":
        before = seg
        if not block_segments:  # what the parties hang on: the other segments need no row
            before = S.tagged_rows(scan, ["ST", "SE", "CLM", "N3", "N4", "DMG", "NM1"]).filter(
                (F.col("tag") != "NM1") | el("el", 1).isin("85", "IL", "QC"))
            before = S.annotate(S.map_provider_codes(before, role_map))
        claims = claims.join(preceding_parties(before), ["file_hash", "k"], "inner")
    claims = claims.withColumn(
        "providers",
        F.when(
            F.col("billing_provider").isNotNull(),
            F.concat(F.array(F.col("billing_provider")), F.col("claim_providers")),
        ).otherwise(F.col("claim_providers")),
    ).withColumn("providers", F.when(F.size("providers") > 0, F.col("providers")))
    columns = [
        "vendor_id", "file_hash", "file_path", "run_id", "isa_control", "gs_control", "st_control",
        "transaction_version", "claim_id", "claim_amount", "place_of_service", "subscriber_id", "patient_id",
        "billing_npi", "rendering_npi", "claim_from_dt", "claim_to_dt", "service_lines", "claim_block_text",
        "diagnoses", "providers", "subscriber", "patient", "other_payers", "references", "k", "g", "n_block_segments",
        *keep,
    ]
    ranks = [F.col("k").cast("int").alias("claim_ordinal"), *RANK_COLUMNS]
    ranked = rank_claims(claims.select(*columns)) if block_segments else claims.select(*columns, *ranks)
    claims = claims.select(*columns)

    return {"claims": claims, "ranked": ranked, "errors": errors, "segments": seg, "transactions": txn, "parties": parties, "files": gated}


def parse_errors(gated: DataFrame, parties: DataFrame, txn: DataFrame, meta: DataFrame) -> DataFrame:
    """Error rows for every stage; one row per (file_hash, error_stage, error_message)."""
    gate = gated.filter(F.col("gate_error").isNotNull()).select(
        "file_hash",
        F.col("gate_error").alias("error_stage"),
        F.when(F.col("gate_error") == S.ERR_BASIC[0], F.lit(S.ERR_BASIC[1])).otherwise(F.lit(S.ERR_DELIMS[1])).alias("error_message"),
    )
    no_segments = (
        gated.filter(F.col("gate_error").isNull())
        .select("file_hash")
        .join(parties.select("file_hash"), "file_hash", "left_anti")
        .select("file_hash", F.lit(S.ERR_SPLIT[0]).alias("error_stage"), F.lit(S.ERR_SPLIT[1]).alias("error_message"))
    )
    no_st = parties.filter(~F.col("found_837")).select(
        "file_hash", F.lit(S.ERR_NO_ST837[0]).alias("error_stage"), F.lit(S.ERR_NO_ST837[1]).alias("error_message")
    )
    no_clm = txn.filter(F.col("n_claims") == 0).select(
        "file_hash", F.lit(S.ERR_NO_CLM[0]).alias("error_stage"), F.lit(S.ERR_NO_CLM[1]).alias("error_message")
    )
    errs = gate.unionByName(no_segments).unionByName(no_st).unionByName(no_clm).dropDuplicates(
        ["file_hash", "error_stage", "error_message"]
    )
    sample = gated.select("file_hash", "vendor_id", "file_path", "run_id",
                          F.substring("content_str", 1, S.ERROR_SAMPLE_CHARS).alias("sample_text"))
    return errs.join(sample, "file_hash", "inner")


def _rank(df: DataFrame, ordinal: str) -> DataFrame:
    """Add ``claims_with_id`` and ``newer_claims``: claims of the same silver key, and those after this one."""
    w = Window.partitionBy("file_hash", "st_control", "claim_id")
    return df.withColumns({
        "claims_with_id": F.count(F.lit(1)).over(w),
        "newer_claims": F.row_number().over(w.orderBy(F.col(ordinal).desc())) - 1,
    })


def rank_claims(claims: DataFrame) -> DataFrame:
    """Parsed claims with their ordinal in the file and their place among claims of the same silver key.

    The window is keyed by ``file_hash`` first, so it reuses the parse's
    partitioning (no shuffle).
    """
    return _rank(claims.withColumn("claim_ordinal", F.col("k").cast("int")), "claim_ordinal")


def rank_silver(silver: DataFrame) -> DataFrame:
    """The same for silver rows that carry ``claim_ordinal``."""
    return _rank(silver, "claim_ordinal")


def dedupe_claims(claims: DataFrame) -> DataFrame:
    """One claim per silver key ``(file_hash, st_control, claim_id)``: the last by claim ordinal."""
    return latest_claims(rank_claims(claims))


def latest_claims(ranked: DataFrame) -> DataFrame:
    """The same from claims that are ranked already."""
    return ranked.filter("newer_claims = 0").drop("claim_ordinal", *RANK_COLUMNS)


def _json(c: str) -> Column:
    return F.to_json(F.col(c), {"ignoreNullFields": "false"})


def to_silver(claims: DataFrame, parse_ts: str | None = None, extra: list[str] | None = None) -> DataFrame:
    """Typed claims -> the silver claim table shape (nested values as JSON text), plus the ``extra`` columns."""
    ts = F.lit(parse_ts).cast("timestamp") if parse_ts else F.current_timestamp()
    return claims.select(
        "vendor_id", "file_hash", "file_path", "run_id", ts.alias("parse_ts"), "isa_control", "gs_control",
        "st_control", "transaction_version", "claim_id", "claim_amount", "place_of_service", "subscriber_id",
        "patient_id", "billing_npi", "rendering_npi", "claim_from_dt", "claim_to_dt",
        _json("service_lines").alias("service_lines_json"),
        "claim_block_text",
        _json("diagnoses").alias("diagnosis_json"),
        _json("providers").alias("providers_json"),
        _json("subscriber").alias("subscriber_json"),
        _json("patient").alias("patient_json"),
        _json("other_payers").alias("other_payer_json"),
        *[_json("references").alias(c) if c == "references_json" else c for c in extra or []],
    )


def errors_table(errors: DataFrame, parse_ts: str | None = None) -> DataFrame:
    ts = F.lit(parse_ts).cast("timestamp") if parse_ts else F.current_timestamp()
    return errors.withColumn("parse_ts", ts).select(*ERROR_COLUMNS)


def quarantine_rows(errors: DataFrame, run_id: str | None = None, created_ts: str | None = None) -> DataFrame:
    """Delimiter failures -> quarantine rows (stage SILVER, rule SISA), one per (vendor, file, stage, rule)."""
    ts = F.lit(created_ts).cast("timestamp") if created_ts else F.current_timestamp()
    return (
        errors.filter(F.col("error_stage") == S.ERR_DELIMS[0])
        .select(
            "vendor_id", "file_hash", "file_path",
            F.coalesce(F.lit(run_id).cast("string"), F.col("run_id")).alias("run_id"),
            F.lit("SILVER").alias("stage"), F.lit("SISA").alias("rule_id"),
            F.col("error_message").alias("reason"), ts.alias("created_ts"),
        )
        .dropDuplicates(["vendor_id", "file_hash", "stage", "rule_id"])
    )
