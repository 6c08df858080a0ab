"""Hand-written X12 files: one per parse rule / quirk, with literal expected values."""

from pyspark.sql import functions as F

from claimflow.operators import claims as C
from claimflow.operators import gold as G
from helpers import claims_of, errors_of, isa, landing, parse_texts

ENV = "GS*HC*S*R*20240101*1200*7*X*005010X222A1~"
TAIL = "GE*1*7~IEA*1*000000001~"


def test_two_transactions_one_without_claims(spark):
    text = isa() + ENV + "ST*837*0001*V1~CLM*A1*10.00~SE*3*0001~ST*837*0002*V1~NM1*IL*1*DOE*J****MI*M1~SE*2*0002~" + TAIL
    cl = claims_of(spark, [("vendorA", "two.x12", text)])
    assert [(c["claim_id"], c["st_control"], c["claim_amount"]) for c in cl] == [("A1", "0001", 10.0)]
    assert errors_of(spark, [("vendorA", "two.x12", text)]) == [("two.x12", "no_clm")]
    assert cl[0]["isa_control"] == "000000001" and cl[0]["gs_control"] == "7"


def test_span_rules_nested_st_non_837_and_missing_se(spark):
    text = (isa() + "ST*837*1*V~CLM*A~ST*837*2*V~CLM*B~SE*4*1~"
            "ST*835*9*V~CLM*X~SE*2*9~ST*837*3*V~CLM*C*5~")
    cl = claims_of(spark, [("vendorA", "span.x12", text)])
    assert [(c["claim_id"], c["st_control"]) for c in cl] == [("A", "1"), ("B", "1"), ("C", "3")]
    # the last block of an unterminated span runs to the end of file
    assert cl[2]["claim_block_text"] == "CLM*C*5"
    # the block of B includes the SE that closes the span
    assert cl[1]["claim_block_text"] == "CLM*B~SE*4*1"


def test_no_st_837(spark):
    text = isa() + ENV + "ST*835*1*V~CLM*A~SE*2*1~" + TAIL
    assert errors_of(spark, [("vendorA", "x.x12", text)]) == [("x.x12", "no_st_837")]


def test_parties_are_file_scoped_and_last_wins(spark):
    text = (isa() + ENV + "ST*837*1*V~NM1*85*2*CLINIC A*****XX*111~N3*1 MAIN~N4*CITY*ST*12345~"
            "NM1*IL*1*DOE*JOHN****MI*M1~DMG*D8*19700101*M~CLM*A*1~"
            "NM1*IL*1*ROE*JANE****MI*M2~NM1*PR*2*PAYER*****PI*P1~N3*SUB STREET~CLM*B*2~SE*9*1~")
    cl = claims_of(spark, [("vendorA", "p.x12", text)])
    for c in cl:  # every claim gets the file's last subscriber
        assert c["subscriber_id"] == "M2" and c["patient_id"] == "M2"
        assert c["subscriber"]["last_name"] == "ROE"
        # DMG stays from the earlier IL (overlay per segment type); N3 after NM1*PR still goes to SUB
        assert c["subscriber"]["dob"] == "19700101" and c["subscriber"]["addr1"] == "SUB STREET"
        assert c["billing_npi"] == "111"
        assert c["providers"][0]["addr1"] == "1 MAIN" and c["providers"][0]["zip"] == "12345"
        assert c["patient"] == c["subscriber"]
    # the next subscriber's NM1*PR leaks into the previous claim block (file scope)
    assert cl[0]["other_payers"] == [{"payer_name": "PAYER", "payer_id": "P1"}]


def test_second_billing_replaces_first_and_drops_address(spark):
    text = (isa() + "ST*837*1*V~NM1*85*2*A*****XX*111~N3*X~N4*C*S*Z~NM1*85*2*B*****XX*222~CLM*A*1~SE*2*1~")
    c = claims_of(spark, [("vendorA", "b.x12", text)])[0]
    assert c["billing_npi"] == "222"
    bill = c["providers"][0]
    assert bill["last_name_or_org"] == "B" and bill["addr1"] is None and bill["city"] is None


def test_short_nm1_uses_last_element_as_id(spark):
    text = isa() + "ST*837*1*V~NM1*IL*1*DOE*J****MI*M1~NM1*QC*1*KID*AMY~DMG*D8*20100101*F~CLM*A*1~SE*2*1~"
    c = claims_of(spark, [("vendorA", "q.x12", text)])[0]
    assert c["patient"]["member_id"] == "AMY" and c["patient_id"] == "AMY"
    assert c["patient"]["dob"] == "20100101" and c["subscriber"]["dob"] is None


def test_dates(spark):
    text = (isa() + "ST*837*1*V~"
            "CLM*R*1~DTP*434*RD8*20240101-20240105~"
            "CLM*S*1~DTP*472*D8*20240310~DTP*472*D8*20240301~DTP*434*D8*20240305~"
            "CLM*N*1~DTP*472*D8~"
            "CLM*B*1~DTP*472*D8*20241399~SE*9*1~")
    cl = {c["claim_id"]: c for c in claims_of(spark, [("vendorA", "d.x12", text)])}
    assert (cl["R"]["claim_from_dt"], cl["R"]["claim_to_dt"]) == ("20240101-20240105", None)
    assert (cl["S"]["claim_from_dt"], cl["S"]["claim_to_dt"]) == ("20240305", "20240310")
    assert (cl["N"]["claim_from_dt"], cl["N"]["claim_to_dt"]) == (None, None)
    res, _ = parse_texts(spark, [("vendorA", "d.x12", text)])
    hdr = {r.claim_id: r for r in G.claim_header(res["claims"]).collect()}
    assert hdr["R"].claim_from_date is None  # RD8 range is not an 8-character date
    assert hdr["B"].claim_from_date is None  # bad calendar date -> NULL, no failure
    assert str(hdr["S"].claim_to_date) == "2024-03-10"


def test_number_parsing(spark):
    vals = {"A": "abc", "B": "", "C": "1e5", "D": "1_000", "E": "1d", "F": "nan", "G": " 12.50 ", "H": "-.5"}
    body = "".join(f"CLM*{k}*{v}~" for k, v in vals.items())
    cl = {c["claim_id"]: c["claim_amount"] for c in claims_of(spark, [("vendorA", "n.x12", isa() + "ST*837*1*V~" + body)])}
    assert cl == {"A": None, "B": None, "C": 100000.0, "D": None, "E": None, "F": None, "G": 12.5, "H": -0.5}


def test_hi_diagnoses(spark):
    text = isa() + "ST*837*1*V~CLM*A*1~HI*ABK:E11**ABF*ABJ:*:~SE*3*1~"
    c = claims_of(spark, [("vendorA", "h.x12", text)])[0]
    assert c["diagnoses"] == [
        {"diag_qualifier": "ABK", "diag_code": "E11", "raw": "ABK:E11"},
        {"diag_qualifier": "ABF", "diag_code": None, "raw": "ABF"},
        {"diag_qualifier": "ABJ", "diag_code": "", "raw": "ABJ:"},
    ]
    res, _ = parse_texts(spark, [("vendorA", "h.x12", text)])
    dx = [(r.diag_seq, r.diag_code) for r in G.claim_diagnosis(res["claims"]).orderBy("diag_seq").collect()]
    assert dx == [(1, "E11"), (3, "")]


def test_service_lines_layouts_and_lx(spark):
    text = (isa() + "ST*837*1*V~CLM*A*1~SV1*HC:99213:25:59*100*UN*2~LX*1~SV1*HC:99214*50.5*UN*1~"
            "LX*2~SV2*0450:HC:99283:25*200*UN*1~LX*3~SV2*0300*HC:80053*75*UN*3~LX*4~SV2*0450**100.00*UN*2~SE*9*1~")
    c = claims_of(spark, [("vendorA", "s.x12", text)])[0]
    got = [(s["lx"], s["revenue_code"], s["qualifier"], s["procedure_code"], s["modifiers"], s["charge_amount"], s["units"])
           for s in c["service_lines"]]
    assert got == [
        (None, None, "HC", "99213", ["25", "59"], 100.0, 2.0),
        ("1", None, "HC", "99214", [], 50.5, 1.0),
        ("2", "0450", "HC", "99283", ["25"], 200.0, 1.0),
        ("3", "0300", "HC", "80053", [], 75.0, 3.0),
        ("4", "0450", None, None, [], 100.0, 2.0),
    ]
    res, _ = parse_texts(spark, [("vendorA", "s.x12", text)])
    gl = G.claim_service_line(res["claims"]).orderBy("line_seq").collect()
    assert [(r.line_seq, r.rev_code, r.procedure_code, r.modifiers_str, r.modifier1, r.modifier2) for r in gl] == [
        (1, None, "99213", "25,59", "25", "59"), (2, None, "99214", "", None, None), (3, "0450", "99283", "25", "25", None),
        (4, "0300", "80053", "", None, None), (5, "0450", None, "", None, None),  # revenue-only line kept
    ]


def test_duplicate_claim_ids_keep_last(spark):
    text = isa() + "ST*837*1*V~CLM*A*1~CLM*A*2~CLM*B*3~SE*4*1~"
    res, _ = parse_texts(spark, [("vendorA", "dup.x12", text)])
    got = sorted((r.claim_id, r.claim_amount) for r in C.dedupe_claims(res["claims"]).collect())
    assert got == [("A", 2.0), ("B", 3.0)]


def test_crlf_and_blanks_are_trimmed(spark):
    text = isa(s="~") + "\r\n  ST*837*1*V~\r\nCLM*A*1 ~\r\n  \r\n~SE*2*1~\r\n"
    c = claims_of(spark, [("vendorA", "crlf.x12", text)])[0]
    assert c["claim_id"] == "A" and c["claim_amount"] == 1.0 and c["claim_block_text"] == "CLM*A*1~SE*2*1"


def test_non_utf8_and_not_x12_are_rejected(spark):
    _, bad = parse_texts(spark, [("vendorA", "bin.x12", b"\xff\x49\x53\x41"), ("vendorA", "txt.x12", "HELLO")])
    got = sorted((r.file_path.rsplit("/", 1)[1], r.reject_reason) for r in bad.collect())
    assert got == [("bin.x12", "Content is not valid UTF-8"), ("txt.x12", "Not X12-like (ISA not at position 1)")]


def test_garbage_isa_fails_fixed_offsets(spark):
    broken = "ISA*00*SHORT~ST*837*1*V~CLM*A*1~" + "NTE*" + "X" * 120 + "~SE*3*1~"
    assert errors_of(spark, [("vendorA", "g.x12", broken)]) == [("g.x12", "quarantine_delimiters")]


def test_lenient_profile_supplies_delimiters(spark):
    text = "ISA|00~ST|837|13|V~CLM|13|1.00~SE|1|13~"
    cl = claims_of(spark, [("vendorB", "c13.x12", text)])
    assert [(c["claim_id"], c["claim_amount"], c["claim_block_text"]) for c in cl] == [("13", 1.0, "CLM|13|1.00~SE|1|13")]
    assert errors_of(spark, [("vendorA", "a13.x12", text)]) == [("a13.x12", "quarantine_delimiters")]
    # a vendor without profile gets the strict default
    assert errors_of(spark, [("vendorZ", "z13.x12", text)]) == [("z13.x12", "quarantine_delimiters")]


def test_other_delimiters_from_isa(spark):
    text = isa(e="|", c=">", s="\n") + "ST|837|1|V\nCLM|A|9.5|||11>B>1\nHI|ABK>E11\nSV1|HC>1>M1|9.5|UN|1\nSE|4|1\n"
    c = claims_of(spark, [("vendorA", "o.x12", text)])[0]
    assert (c["claim_id"], c["claim_amount"], c["place_of_service"]) == ("A", 9.5, "11")
    assert c["diagnoses"][0]["diag_code"] == "E11" and c["service_lines"][0]["modifiers"] == ["M1"]


def test_claim_block_text_cut_at_4000(spark):
    text = isa() + "ST*837*1*V~CLM*A*1~" + "".join(f"NTE*{i:04d}" + "Y" * 90 + "~" for i in range(60)) + "SE*3*1~"
    c = claims_of(spark, [("vendorA", "long.x12", text)])[0]
    full = "~".join(["CLM*A*1"] + [f"NTE*{i:04d}" + "Y" * 90 for i in range(60)] + ["SE*3*1"])
    assert c["claim_block_text"] == full[:4000] and len(c["claim_block_text"]) == 4000


def test_silver_json_shape(spark):
    text = isa() + "ST*837*1*V~CLM*A*1~SE*2*1~"
    res, _ = parse_texts(spark, [("vendorA", "j.x12", text)])
    s = C.to_silver(res["claims"]).collect()[0]
    assert s.service_lines_json == "[]" and s.diagnosis_json is None and s.providers_json is None
    assert s.subscriber_json is None and s.other_payer_json is None
    assert set(C.SILVER_COLUMNS) == set(C.to_silver(res["claims"]).columns)


def test_rendering_npi_is_last_rendering_with_npi(spark):
    text = (isa() + "ST*837*1*V~CLM*A*1~NM1*82*1*X*Y****XX*900~NM1*DN*1*R*S****XX*700~NM1*82*1*Z*W****XX*~"
            "NM1*ZZ*1*O*P****XX*500~SE*6*1~")
    c = claims_of(spark, [("vendorA", "r.x12", text)])[0]
    assert c["rendering_npi"] == "900"
    assert [p["role"] for p in c["providers"]] == ["RENDERING", "REFERRING", "RENDERING"]  # ZZ/OTHER dropped


def test_ingest_vendor_from_path(spark):
    df = landing(spark, [("vendorA", "a.x12", "ISA")])
    from claimflow.operators import bronze as B
    rows = B.ingest(df.withColumn("path", F.lit("/landing/nofolder/a.x12"))).collect()
    assert rows[0].vendor_id is None and rows[0].reject_reason == B.REJECT_NO_VENDOR


def test_party_scope_preceding(spark):
    text = (isa() + ENV + "ST*837*1*V~NM1*85*2*A*****XX*111~N3*1 MAIN~NM1*IL*1*DOE*JOHN****MI*M1~CLM*A*1~"
            "NM1*IL*1*ROE*JANE****MI*M2~NM1*QC*1*KID*K****MI*P2~NM1*85*2*B*****XX*222~CLM*B*2~SE*9*1~")
    res, _ = parse_texts(spark, [("vendorA", "pre.x12", text)])
    from claimflow.operators import bronze as B
    from claimflow.sources.fixtures import fixture_profiles
    good, _ = B.split_rejects(B.ingest(landing(spark, [("vendorA", "pre.x12", text)])))
    pre = C.parse(good, fixture_profiles(spark), party_scope="preceding")["claims"]
    got = {r.claim_id: (r.subscriber_id, r.patient_id, r.billing_npi, r.providers[0].addr1) for r in pre.collect()}
    assert got == {"A": ("M1", "M1", "111", "1 MAIN"), "B": ("M2", "P2", "222", None)}
    filed = {r.claim_id: (r.subscriber_id, r.patient_id, r.billing_npi) for r in res["claims"].collect()}
    assert filed == {"A": ("M2", "P2", "222"), "B": ("M2", "P2", "222")}
