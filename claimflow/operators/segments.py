"""X12 structure as a segment table.

A file is exploded once into ``(file_hash, pos, text, el)`` rows. The
sequential state of a left-to-right scan is then expressed as running
window aggregates over one ``(file_hash ORDER BY pos)`` ordering:

* ``g``        number of ``SE`` segments strictly before the row (an ``SE``
               belongs to the span it closes);
* ``in_txn``   an ``ST*837`` opened in the current ``g`` at or before the
               row — a nested ``ST`` is swallowed, a non-837 ``ST`` is
               stepped over, a missing ``SE`` runs to the end of file;
* ``k``        running count of ``CLM`` inside transactions: the claim ordinal;
* ``in_claim`` a ``CLM`` of the current span at or before the row;
* ``lx``       the last ``LX`` value of the current claim;
* ``party``    the last ``NM1*85/IL/QC`` marker before the row (file scope);
* ``blk_off``  character offset of the segment inside its claim block text.

All windows share the partitioning and ordering, so Spark sorts the segment
rows once. Files are hash-partitioned by ``file_hash`` *before* the explode
(one shuffle of whole files, not of segments); windows and the per-claim /
per-span / per-file aggregations downstream reuse that partitioning.

The parse itself does not need a row a segment (:func:`scan_files`): a file's
segments stay in one array, which is cut at its SE, ST and CLM segments into
spans and claims, so nothing is sorted and only claims become rows. The segment
table is what the tables of segments and the two-level scan are read from.

A file too large for one task is scanned on two levels: the same windows run
over blocks of its positions, the blocks' totals (sums, last positions, last
values) are combined in order, and each block starts from what the blocks
before it amount to. The totals are associative, so the result is that of one
scan whatever the blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from claimflow.functions.text import delimiter_regex, el, py_strip
from claimflow.sources.config import DEFAULT_PROFILE, active, broadcast_if_small, effective_profiles, scoped_lookup

# ISA is fixed-width; 0-based offsets of the element delimiter,
# repetition separator (ISA11), component separator (ISA16) and the segment
# terminator right after it, and the 16 offsets where an element delimiter
# must stand in a well-formed ISA.
ISA_MIN_LENGTH = 106
ISA_ELEMENT_AT, ISA_REPETITION_AT, ISA_COMPONENT_AT, ISA_SEGMENT_AT = 3, 82, 104, 105
ISA_ELEMENT_OFFSETS = [3, 6, 17, 20, 31, 34, 50, 53, 69, 76, 81, 83, 89, 99, 101, 103]

# Error stages and messages of the silver parse.
ERR_BASIC = ("basic_check", "Content is null or does not start with ISA")
ERR_DELIMS = ("quarantine_delimiters", "ISA delimiter detection failed (strict_mode=true)")
ERR_SPLIT = ("split_segments", "No segments after splitting")
ERR_NO_CLM = ("no_clm", "Found ST*837 but no CLM segments")
ERR_NO_ST837 = ("no_st_837", "No ST*837 transaction found in file")

ERROR_SAMPLE_CHARS = 300

FILE_COLUMNS = ["file_hash", "vendor_id", "segment_delim", "component_delim", "comp_re"]
DELIM_COLUMNS = ["segment_delim", "element_delim", "component_delim", "repetition_delim"]


def _char(s: Column, offset0: int) -> Column:
    return F.substring(s, offset0 + 1, 1)


def detect_isa_delimiters(content: Column) -> Column:
    """Struct of the four delimiters read from the fixed-width ISA, or NULL.

    NULL when the text does not start with ``ISA``, is shorter than 106
    characters, or the element delimiter is missing at any fixed ISA offset
    (a broken ISA would otherwise yield garbage delimiters).
    """
    e = _char(content, ISA_ELEMENT_AT)
    well_formed = F.lit(True)
    for off in ISA_ELEMENT_OFFSETS:
        well_formed = well_formed & (_char(content, off) == e)
    ok = content.startswith("ISA") & (F.length(content) >= ISA_MIN_LENGTH) & well_formed
    return F.when(
        ok,
        F.struct(
            _char(content, ISA_SEGMENT_AT).alias("segment_delim"),
            e.alias("element_delim"),
            _char(content, ISA_COMPONENT_AT).alias("component_delim"),
            _char(content, ISA_REPETITION_AT).alias("repetition_delim"),
        ),
    )


def resolve_delimiters(files: DataFrame, profiles: DataFrame | None = None, params: DataFrame | None = None) -> DataFrame:
    """Add the delimiters each file is parsed with, ``delim_source`` and ``gate_error``.

    ISA detection first (when the vendor profile allows it); when detection
    fails a strict profile quarantines the file and a lenient one supplies
    its own delimiters. ``use_isa_delimiters = false`` always takes the
    profile's. Vendors without a profile get the default profile (strict).
    ``gate_error`` is the error stage for files that cannot be parsed.
    ``params`` (``vendor_id, params``) are step parameters that override
    fields of the profile.
    """
    if profiles is not None:
        prof = effective_profiles(profiles, params).withColumnRenamed("vendor_id", "_pv")
        prof = broadcast_if_small(prof, files=params is None)
        files = files.join(prof, files["vendor_id"] == prof["_pv"], "left").drop("_pv")
    else:
        for c in ["use_isa_delimiters", "strict_mode", *DELIM_COLUMNS]:
            files = files.withColumn(c, F.lit(None))
    use_isa = F.coalesce(F.col("use_isa_delimiters").cast("boolean"), F.lit(DEFAULT_PROFILE["use_isa_delimiters"]))
    strict = F.coalesce(F.col("strict_mode").cast("boolean"), F.lit(DEFAULT_PROFILE["strict_mode"]))
    detected = F.when(use_isa, detect_isa_delimiters(F.col("content_str")))
    basic_ok = F.coalesce(F.col("content_str").startswith("ISA"), F.lit(False))
    source = (
        F.when(~basic_ok, F.lit(None))
        .when(detected.isNotNull(), F.lit("ISA"))
        .when(use_isa & strict, F.lit("FAILED"))
        .otherwise(F.lit("PROFILE"))
    )
    prof_d = {c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(DEFAULT_PROFILE[c])) for c in DELIM_COLUMNS}
    out = files.withColumn("_det", detected).withColumn("delim_source", source)
    for c in DELIM_COLUMNS:
        out = out.withColumn(
            c,
            F.when(F.col("delim_source") == "ISA", F.col(f"_det.{c}"))
            .when(F.col("delim_source") == "PROFILE", prof_d[c]),
        )
    gate = (
        F.when(~basic_ok, F.lit(ERR_BASIC[0]))
        .when(F.col("delim_source") == "FAILED", F.lit(ERR_DELIMS[0]))
    )
    return out.withColumn("gate_error", gate).drop("_det", "use_isa_delimiters", "strict_mode")


def explode_segments(files: DataFrame, num_partitions: int | None = None, repartition: bool = True,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Files (with delimiters, ``gate_error`` NULL) -> one row per non-empty segment.

    Columns: ``file_hash, vendor_id, segment_delim, component_delim, comp_re, pos, text, el, tag``, and ``keep`` of the file.
    ``tag`` is ``el[0]`` only when the segment has an element after it (a
    segment *is* ``ID`` only when it starts with ``ID`` + element delimiter).
    The delimiter regexes are built once per file, before the explode.
    ``repartition=False`` when ``files`` is already hash-partitioned by
    ``file_hash`` (the windows then need no exchange at all).
    """
    f = files.filter(F.col("gate_error").isNull()).select(
        "file_hash", "vendor_id", "content_str", "segment_delim", "component_delim",
        delimiter_regex(F.col("segment_delim")).alias("seg_re"),
        delimiter_regex(F.col("element_delim")).alias("el_re"),
        delimiter_regex(F.col("component_delim")).alias("comp_re"), *keep,
    )
    if repartition:
        f = f.repartition(num_partitions, "file_hash") if num_partitions else f.repartition("file_hash")
    pieces = f.select(
        *FILE_COLUMNS, *keep, "el_re",
        F.posexplode(F.split(F.col("content_str"), F.col("seg_re"), -1)).alias("pos", "raw"),
    )
    return split_elements(pieces)


def provider_codes(files: DataFrame, role_map: DataFrame | None) -> DataFrame:
    """Add ``own_roles`` and ``all_roles``: the configured NM1 roles by entity code, of the file's vendor and of all vendors."""
    roles = "map<string,string>"
    if role_map is None:
        return files.withColumns({c: F.lit(None).cast(roles) for c in ("own_roles", "all_roles")})
    code = F.col("nm101_entity_id")
    best = active(role_map).filter(code.isNotNull()).groupBy("vendor_id", "nm101_entity_id").agg(
        F.min_by(F.struct("role_name"), F.col("precedence")).alias("v"))
    entries = F.map_from_entries(F.collect_list(F.struct("nm101_entity_id", F.col("v.role_name"))))
    own = best.filter(F.col("vendor_id").isNotNull()).groupBy(F.col("vendor_id").alias("_mv")).agg(entries.alias("own_roles"))
    every = best.filter(F.col("vendor_id").isNull()).agg(entries.alias("all_roles"))
    own = broadcast_if_small(own, files=False)
    return files.join(own, files["vendor_id"] == own["_mv"], "left").drop("_mv").crossJoin(F.broadcast(every))


def mapped_role(code: Column) -> Column:
    """The configured role of an NM1 entity code in a frame of :func:`provider_codes`; a vendor's row wins, even without a role."""
    own = F.coalesce(F.map_contains_key("own_roles", F.coalesce(code, F.lit(""))) & code.isNotNull(), F.lit(False))
    return F.when(own, F.try_element_at("own_roles", code)).otherwise(F.try_element_at("all_roles", code))


def is_segment(e: Column, *tags: str) -> Column:
    """Whether the elements are those of a segment with one of the tags (and an element after it)."""
    return (F.size(e) > 1) & el(e, 0).isin(*tags)


def places(arr: Column | str, cond) -> Column:
    """0-based indexes of the elements that meet ``cond(element, index)``."""
    return F.filter(F.transform(arr, lambda x, i: F.when(cond(x, i), i)), lambda i: i.isNotNull())


def scan_files(files: DataFrame, num_partitions: int | None = None, repartition: bool = True,
               role_map: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per parseable file, with its non-empty segments (``texts``, ``tags``), its ``ST*837`` spans and the columns ``keep``.

    ``spans`` has one struct per span: its number ``g``, the elements ``st`` of
    the ST that opens it, ``n_segments``, and the places ``clms`` of its CLM
    segments, which end where the next begins or at ``z``. One pass picks the
    SE, ``ST*837`` and CLM segments, which are cut at each SE first; a span is the rest of such a piece from its first
    ``ST*837`` on (a nested ST is swallowed, a piece without one is skipped). Every
    step is linear in the file's segments.
    """
    f = files.filter(F.col("gate_error").isNull()).select(
        "file_hash", "vendor_id", "file_path", "run_id", *keep, "content_str", "segment_delim", "element_delim", "component_delim",
        delimiter_regex(F.col("segment_delim")).alias("seg_re"),
        delimiter_regex(F.col("element_delim")).alias("el_re"),
        delimiter_regex(F.col("component_delim")).alias("comp_re"),
    )
    if repartition:
        f = f.repartition(num_partitions, "file_hash") if num_partitions else f.repartition("file_hash")
    ed, el_re, texts = F.col("element_delim"), F.col("el_re"), F.col("texts")
    f = provider_codes(f, role_map)
    f = f.withColumn("texts", F.filter(F.transform(F.split("content_str", F.col("seg_re"), -1), py_strip), lambda t: t != ""))
    f = f.withColumn("sample_text", F.substring("content_str", 1, ERROR_SAMPLE_CHARS)).drop("content_str", "seg_re")
    f = f.withColumn("tags", F.transform("texts", lambda t: F.when(F.instr(t, ed) > 0, F.call_function("substring_index", t, ed, F.lit(1)))))

    def st837(i: Column) -> Column:
        return el(F.split(F.get(texts, i), el_re, -1), 1) == "837"

    # the few segments that a file is cut at; all that follows is read from these
    f = f.withColumn("_cuts", F.filter(F.transform("tags", lambda t, i: F.when(
        t.isin("SE", "CLM") | ((t == "ST") & st837(i)), F.struct(i.alias("i"), t.alias("t")))), lambda x: x.isNotNull()))
    f = f.withColumn("_se", places("_cuts", lambda x, j: x["t"] == "SE"))
    pieces = F.transform(F.sequence(F.lit(0), F.size("_se")), lambda j: F.struct(
        j.alias("g"), F.coalesce(F.get("_cuts", F.get("_se", j - 1))["i"] + 1, F.lit(0)).alias("a"),
        F.coalesce(F.get("_cuts", F.get("_se", j))["i"] + 1, F.size("texts")).alias("z"),
        F.coalesce(F.get("_se", j - 1) + 1, F.lit(0)).alias("from"), F.coalesce(F.get("_se", j), F.size("_cuts")).alias("to")))
    cut = F.transform(pieces, lambda s: F.struct(
        s["g"].alias("g"), s["z"].alias("z"), F.slice("_cuts", s["from"] + 1, s["to"] - s["from"]).alias("cuts")))
    opened = F.transform(cut, lambda s: F.struct(
        s["g"].alias("g"), s["z"].alias("z"), s["cuts"].alias("cuts"),
        F.get(F.filter(s["cuts"], lambda x: x["t"] == "ST"), F.lit(0))["i"].alias("at")))
    spans = F.transform(F.filter(opened, lambda s: s["at"].isNotNull()), lambda s: F.struct(
        s["g"].cast("long").alias("g"), F.split(F.get(texts, s["at"]), el_re, -1).alias("st"),
        (s["z"] - s["at"]).cast("long").alias("n_segments"), s["z"].alias("z"),
        F.transform(F.filter(s["cuts"], lambda x: (x["t"] == "CLM") & (x["i"] > s["at"])), lambda x: x["i"]).alias("clms")))
    return f.withColumn("spans", spans).drop("_se", "_cuts")


def tagged_rows(scan: DataFrame, tags: list[str]) -> DataFrame:
    """The segments of scanned files that have one of the tags, as rows of :func:`explode_segments`; no other becomes a row."""
    found = F.filter(F.transform("texts", lambda t, i: F.when(
        F.get("tags", i).isin(*tags), F.struct(i.alias("pos"), t.alias("text")))), lambda x: x.isNotNull())
    # an outer explode: Spark would work out the array of a plain one twice, to leave out empty ones before it
    s = scan.select(*FILE_COLUMNS, "el_re", F.explode_outer(found).alias("s")).filter(F.col("s").isNotNull())
    s = s.select(*FILE_COLUMNS, "s.pos", "s.text", F.split("s.text", F.col("el_re"), -1).alias("el"))
    return s.withColumn("tag", F.when(F.size("el") > 1, el("el", 0)))


def span_rows(scan: DataFrame) -> DataFrame:
    """:func:`transactions` of scanned files."""
    # an outer explode: Spark would work out the array of a plain one twice, to leave out empty ones before it
    s = scan.select("file_hash", F.explode_outer("spans").alias("s")).filter(F.col("s").isNotNull())
    return s.select("file_hash", "s.g", el("s.st", 2).alias("st_control"), el("s.st", 3).alias("transaction_version"),
                    F.size("s.clms").cast("long").alias("n_claims"), "s.n_segments")


def split_elements(pieces: DataFrame) -> DataFrame:
    """Raw segment texts (``raw``, ``el_re``) -> non-empty segments with their elements and tag."""
    keep = [c for c in pieces.columns if c not in ("raw", "el_re")]
    segs = pieces.select(*keep, "el_re", py_strip(F.col("raw")).alias("text")).filter(F.col("text") != "")
    segs = segs.withColumn("el", F.split(F.col("text"), F.col("el_re"), -1)).drop("el_re")
    return segs.withColumn("tag", F.when(F.size("el") > 1, el("el", 0)))


def read_blocks(spark: SparkSession, files: DataFrame, segment_delim: str) -> DataFrame:
    """Segments of large landing files, read in parallel: no task reads a whole file.

    ``files`` has ``path, file_hash, vendor_id, element_delim, component_delim``
    for files that share the one-character ``segment_delim`` (a literal of the
    reader). The text source splits a file into byte ranges at that delimiter; a
    range is a block (``blk``), and a segment's ``pos`` is the range's start plus
    its number in the range, which grows through the file because every
    segment has a byte at least. Few files: their paths are listed on the driver.
    """
    paths = [r["path"] for r in files.select("path").collect()]
    raw = spark.read.option("lineSep", segment_delim).text(paths).select(
        F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/").alias("path"),
        F.col("_metadata.file_block_start").alias("blk"), F.monotonically_increasing_id().alias("_i"), F.col("value").alias("raw"),
    )
    own = files.select(
        F.regexp_replace("path", "^file:/*", "/").alias("path"), "file_hash", "vendor_id", F.lit(segment_delim).alias("segment_delim"),
        "component_delim", delimiter_regex(F.col("element_delim")).alias("el_re"), delimiter_regex(F.col("component_delim")).alias("comp_re"),
    )
    rows = raw.join(broadcast_if_small(own), "path")
    number = F.row_number().over(Window.partitionBy("file_hash", "blk").orderBy("_i")) - 1
    return split_elements(rows.select(*FILE_COLUMNS, "el_re", "blk", (F.col("blk") + number).alias("pos"), "raw"))


def map_provider_codes(segs: DataFrame, role_map: DataFrame | None) -> DataFrame:
    """Add ``mapped_role``: the configured role of an NM1 segment's entity code, if there is one.

    A vendor's row wins over the global one, the lowest precedence within
    either; two broadcast joins that match NM1 rows only.
    """
    if role_map is None:
        return segs.withColumn("mapped_role", F.lit(None).cast("string"))
    code = F.when(F.col("tag") == "NM1", el("el", 1))
    m = role_map.withColumnRenamed("role_name", "mapped_role")
    found = scoped_lookup(segs.withColumn("_code", code), m, "_code", "nm101_entity_id", ["mapped_role"], precedence="precedence")
    return found.drop("_code")


@dataclass(frozen=True)
class Running:
    """A running value over a file's segments: sum, largest or last non-null ``value`` up to a row (``before``: without it)."""

    name: str
    kind: str
    value: Column
    before: bool = False

    def over(self, part: list[str]) -> Column:
        last = -1 if self.before else Window.currentRow
        w = Window.partitionBy(*part).orderBy("pos").rowsBetween(Window.unboundedPreceding, last)
        if self.kind == "last":
            return F.last(self.value, True).over(w)
        return (F.sum if self.kind == "sum" else F.max)(self.value).over(w)

    def total(self) -> Column:
        """The value of a whole block."""
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), F.col("pos")))
        return (F.sum if self.kind == "sum" else F.max)(self.value)

    def prefix(self, totals: str) -> Column:
        """The combined totals of the blocks before."""
        w = Window.partitionBy("file_hash").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
        if self.kind == "last":
            return F.last(totals, True).over(w)
        return (F.sum if self.kind == "sum" else F.max)(totals).over(w)

    def joined(self, carried: str, local: str) -> Column:
        """What the blocks before amount to, continued by the block's own running value."""
        if self.kind == "last":
            return F.coalesce(local, carried)
        if self.kind == "max":
            return F.greatest(local, carried)
        return F.coalesce(F.col(local), F.lit(0)) + F.coalesce(F.col(carried), F.lit(0))


def running(segs: DataFrame, values: list[Running]) -> DataFrame:
    """Add the running values: one window over the file, or two levels when the segments have a block (``blk``).

    On two levels the windows are partitioned by file and block. One row a
    block carries the totals; an exclusive prefix over those rows gives what
    each block starts from, joined back on file and block.
    """
    if "blk" not in segs.columns:
        return segs.select("*", *[v.over(["file_hash"]).alias(v.name) for v in values])
    key = ["file_hash", "blk"]
    totals = segs.groupBy(*key).agg(*[v.total().alias(v.name) for v in values])
    carried = totals.select(*key, *[v.prefix(v.name).alias(f"_from_{v.name}") for v in values])
    local = segs.select("*", *[v.over(key).alias(f"_own_{v.name}") for v in values])
    joined = local.join(carried, key)
    out = joined.withColumns({v.name: v.joined(f"_from_{v.name}", f"_own_{v.name}") for v in values})
    return out.drop(*[f"{p}{v.name}" for v in values for p in ("_from_", "_own_")])


def annotate(segs: DataFrame) -> DataFrame:
    """Add the scan state (``g, in_txn, k, in_claim, lx, party_*, blk_off``) as running values.

    Two groups over the same ``(file_hash ORDER BY pos)`` order: the first
    carries what depends only on the segment itself (SE count, last ST*837 /
    SE / LX / party marker, running text length), the second what depends on
    the transaction state (claim ordinal, last claim start). A row is inside a
    transaction when the last ST*837 at or before it comes after the last SE
    strictly before it; inside a claim when, in addition, the last
    in-transaction CLM does. Segments with a ``blk`` column are scanned on two
    levels (:func:`running`).
    """
    tag = F.col("tag")
    pos = F.col("pos")
    is_se = F.coalesce(tag == "SE", F.lit(False)).cast("int")
    is_st837 = F.coalesce((tag == "ST") & (el("el", 1) == "837"), F.lit(False))
    marker = F.when((tag == "NM1") & (F.size("el") > 2) & el("el", 1).isin("85", "IL", "QC"), el("el", 1))
    seg_len = (F.length("text") + F.length("segment_delim")).cast("long")

    s = segs.withColumn("is_st837", is_st837).withColumn("marker", marker)
    at_st, at_se = F.when(F.col("is_st837"), pos), F.when(tag == "SE", pos)
    s = running(s, [
        Running("_n_se", "sum", is_se),
        Running("_last_st", "max", at_st),
        Running("_last_se", "max", at_se, before=True),
        Running("_last_st_before", "max", at_st, before=True),
        Running("_cum", "sum", seg_len),
        Running("_lx", "last", F.when(tag == "LX", F.struct(pos.alias("at"), el("el", 1).alias("v")))),
        Running("_party", "last", F.when(F.col("marker").isNotNull(), F.struct(F.col("marker").alias("kind"), pos.alias("at")))),
    ])
    s = s.withColumn("g", F.col("_n_se") - is_se)
    at_85 = F.when(F.col("marker") == "85", pos)
    if "blk" in segs.columns:
        last = s.groupBy("file_hash").agg(F.max(at_85).alias("last85_pos"))  # combined a block at a time before the shuffle
        s = s.join(last, "file_hash")
    else:
        s = s.withColumn("last85_pos", F.max(at_85).over(Window.partitionBy("file_hash")))
    after_se = F.coalesce(F.col("_last_se"), F.lit(-1))
    s = s.withColumn("in_txn", F.coalesce(F.col("_last_st") > after_se, F.lit(False)))
    s = s.withColumn("clm_flag", F.coalesce(tag == "CLM", F.lit(False)) & F.col("in_txn"))
    # the ST*837 that opens a span arrives while no transaction is open
    opener = F.col("is_st837") & ~F.coalesce(F.col("_last_st_before") > after_se, F.lit(False))
    s = running(s, [
        Running("_span", "last", F.when(opener, F.struct(el("el", 2).alias("st_control"), el("el", 3).alias("transaction_version")))),
        Running("k", "sum", F.col("clm_flag").cast("int")),
        Running("_last_clm", "max", F.when(F.col("clm_flag"), pos)),
        Running("_start", "last", F.when(F.col("clm_flag"), F.col("_cum") - seg_len)),
    ])
    in_claim = F.col("in_txn") & F.coalesce(F.col("_last_clm") > after_se, F.lit(False))
    return (
        s.withColumn("in_claim", in_claim)
        .withColumn("lx", F.when(F.col("_lx.at") > F.col("_last_clm"), F.col("_lx.v")))
        .withColumn("blk_off", F.when(F.col("in_claim"), F.col("_cum") - seg_len - F.col("_start")))
        .withColumn("party_kind", F.col("_party.kind"))
        .withColumn("party_pos", F.col("_party.at"))
        .withColumn("span_st", F.when(F.col("in_txn"), F.col("_span")))
        .drop("_n_se", "_lx", "_cum", "_start", "_party", "_last_st", "_last_se", "_last_clm", "_last_st_before", "_span", "blk")
    )


def scan_elements(segs: DataFrame) -> DataFrame:
    """Segments with the elements that :func:`annotate` reads and no others, for a scan whose state alone is wanted."""
    return segs.withColumn("el", F.when(F.col("tag").isin("ST", "LX", "NM1"), F.slice("el", 1, 4)))


def segment_table(files: DataFrame, num_partitions: int | None = None, repartition: bool = True,
                  role_map: DataFrame | None = None, block_segments: int | None = None) -> DataFrame:
    """Exploded and annotated segments of every parseable file.

    ``block_segments`` scans files on two levels, in blocks of that many
    positions (for files whose segments are too many for one task).
    """
    segs = map_provider_codes(explode_segments(files, num_partitions, repartition), role_map)
    if block_segments:
        segs = segs.withColumn("blk", F.floor(F.col("pos") / block_segments).cast("long")).repartition("file_hash", "blk")
    return annotate(segs)


def envelope_and_parties_raw(seg: DataFrame) -> DataFrame:
    """Per file: segment count, first ISA13 / GS06, whether an ``ST*837`` exists."""
    return seg.groupBy("file_hash").agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.min_by(el("el", 13), F.when(F.col("tag") == "ISA", F.col("pos"))).alias("isa_control"),
        F.min_by(el("el", 6), F.when(F.col("tag") == "GS", F.col("pos"))).alias("gs_control"),
        F.max(F.col("is_st837")).alias("found_837"),
    )


def transactions(seg: DataFrame) -> DataFrame:
    """One row per ``ST*837`` span: ``file_hash, g, st_control, transaction_version, n_claims, n_segments``."""
    first_st = F.when(F.col("is_st837"), F.col("pos"))
    return (
        seg.filter(F.col("in_txn"))
        .groupBy("file_hash", "g")
        .agg(
            F.min_by(el("el", 2), first_st).alias("st_control"),
            F.min_by(el("el", 3), first_st).alias("transaction_version"),
            F.sum(F.col("clm_flag").cast("int")).alias("n_claims"),
            F.count(F.lit(1)).alias("n_segments"),
        )
    )
