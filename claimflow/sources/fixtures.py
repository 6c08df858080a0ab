"""Landing rows rendered from the star tables (test and bench input).

One landing file per (customer, order-key range): one claim per order, one
service line per lineitem. The result has the ``binaryFile`` schema
(``path, modificationTime, length, content``), so everything downstream runs
exactly as it does on real landing folders. The renderer only produces input
text; it computes none of the parse results.

Layout (fixed by the fixture definition):

* vendor by ``k % 3``: 0 vendorA ``* : ~``, 1 vendorB ``| > ~``,
  2 vendorC ``* :`` and newline as segment terminator; repetition ``^``.
* file kind by ``k % 50``: 7 not X12, 13 short ISA, 19 ``ST*835``, 23 no
  claims, 31 duplicated under ``..._copy.x12``; everything else plain.
* a file holds the orders of one customer whose ``o_orderkey div 2^20`` is
  equal, so no file grows past 2^20 claims however skewed customers are.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.sources import config as cfg
from claimflow.sources.star import read_table

# Fixed values of the fixture definition.
FILE_KEY_SPAN = 1 << 20
VENDORS = ["vendorA", "vendorB", "vendorC"]
ELEMENT_DELIMS = ["*", "|", "*"]
COMPONENT_DELIMS = [":", ">", ":"]
SEGMENT_DELIMS = ["~", "~", "\n"]
REPETITION_DELIM = "^"
VERSIONS = ["005010X222A1", "005010X222A1", "005010X223A2"]
KIND_NOT_X12, KIND_SHORT_ISA, KIND_ST835, KIND_NO_CLAIMS, KIND_DUPLICATE = 7, 13, 19, 23, 31
LANDING_ROOT = "/landing/x12/837"


def fixture_profiles(spark: SparkSession) -> DataFrame:
    """The seeded vendor profiles, but vendorB's: not strict, with the delimiters of its files."""
    b = F.col("vendor_id") == "vendorB"
    own = {"element_delim": "|", "component_delim": ">", "strict_mode": False}
    return cfg.vendor_profiles(spark).withColumns({c: F.when(b, F.lit(v)).otherwise(F.col(c)) for c, v in own.items()})


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _seg(e: Column, *parts) -> Column:
    """One segment: parts joined by the element delimiter (NULL parts -> '')."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.call_function("concat_ws", e, *cols)


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def _ymd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def render_landing(
    spark: SparkSession,
    sf_dir: str,
    with_kinds: bool = True,
    with_extras: bool = False,
) -> DataFrame:
    """Landing frame ``path, modificationTime, length, content`` from the star tables.

    ``with_extras`` adds segments to claims by order key: a service facility
    (NM1*77) to every fourth, references (REF*F8, REF*ZZ) to every third and
    seventh; and a second claim of the same id, one cent dearer and without
    children, to every eleventh.
    """
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    lineitem = read_table(spark, sf_dir, "lineitem")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")

    k = F.col("k")
    v = F.pmod(k, F.lit(3))
    kind = F.pmod(k, F.lit(50)) if with_kinds else F.lit(0)
    own = {"e": _pick(ELEMENT_DELIMS, v), "c": _pick(COMPONENT_DELIMS, v), "sd": _pick(SEGMENT_DELIMS, v),
           "ver": _pick(VERSIONS, v), "vendor_id": _pick(VENDORS, v)}
    e, c, sd, ver, vendor = (F.col(x) for x in own)
    cust = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .select(F.col("c_custkey").alias("k"), "c_name", "c_nationkey", "n_name")
        .withColumns(own)
    )
    body_kind = ~kind.isin(KIND_NOT_X12, KIND_SHORT_ISA)
    claims_kind = body_kind & (kind != KIND_NO_CLAIMS)

    # ---- files: (k, part) for every order range, part 0 for customers without orders
    o_parts = orders.select(
        F.col("o_custkey").alias("k"), F.floor(F.col("o_orderkey") / F.lit(FILE_KEY_SPAN)).cast("long").alias("part"),
        F.col("o_orderdate"),
    ).groupBy("k", "part").agg(F.max("o_orderdate").alias("last_order_ts"))
    with_orders = cust.filter(claims_kind).join(o_parts, "k", "inner")
    without_orders = (
        cust.join(o_parts.select("k").distinct(), "k", "left_anti")
        .unionByName(cust.filter(~claims_kind).join(o_parts.select("k").distinct(), "k", "left_semi"))
        .withColumn("part", F.lit(0).cast("long"))
        .withColumn("last_order_ts", F.lit(None).cast("timestamp"))
    )
    files = with_orders.unionByName(without_orders)

    k9 = F.lpad(k.cast("string"), 9, "0")
    isa = F.concat(
        F.lit("ISA"), e, F.lit("00"), e, F.lit(" " * 10), e, F.lit("00"), e, F.lit(" " * 10), e,
        F.lit("ZZ"), e, F.lit("SENDER" + " " * 9), e, F.lit("ZZ"), e, F.lit("RECEIVER" + " " * 7), e,
        F.lit("240101"), e, F.lit("1200"), e, F.lit(REPETITION_DELIM), e, F.lit("00501"), e, k9, e,
        F.lit("0"), e, F.lit("P"), e, c,
    )
    st_code = F.when(kind == KIND_ST835, F.lit("835")).otherwise(F.lit("837"))
    header = F.array(
        isa,
        _seg(e, "GS", "HC", "S", "R", "20240101", "1200", k, "X", ver),
        _seg(e, "ST", st_code, k, ver),
        _seg(e, "NM1", "85", "2", F.concat(F.lit("CLINIC "), F.col("n_name")), "", "", "", "", "XX", k + 1000000000),
        _seg(e, "N3", F.concat(k.cast("string"), F.lit(" MAIN ST"))),
        _seg(e, "N4", F.concat(F.lit("CITY"), F.col("c_nationkey").cast("string")), "ST", F.pmod(k, F.lit(90000)) + 10000),
        _seg(e, "NM1", "IL", "1", F.col("c_name"), "SUB", "", "", "", "MI", F.concat(F.lit("M"), k.cast("string"))),
        _seg(e, "DMG", "D8", F.pmod(k, F.lit(28)) + 19500101, F.when(F.pmod(k, F.lit(2)) == 0, "F").otherwise("M")),
    )
    dependent = F.array(
        _seg(e, "NM1", "QC", "1", F.concat(F.lit("DEP"), k.cast("string")), "KID", "", "", "", "MI",
             F.concat(F.lit("P"), k.cast("string"))),
        _seg(e, "DMG", "D8", "20100101", "F"),
    )
    header = F.when(F.pmod(k, F.lit(4)) == 0, F.concat(header, dependent)).otherwise(header)
    trailer = F.array(_seg(e, "SE", "1", k), _seg(e, "GE", "1", k), _seg(e, "IEA", "1", k9))

    # ---- orders with their lines, in line order (one array an order)
    line = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )
    lines = (
        lineitem.filter(F.col("l_orderkey").isNotNull())
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sort_array(F.collect_list(line)).alias("lines"))
    )
    # what an order is rendered from: the texts are made once its file is whole, so that no rendered segment is shuffled
    urgent = F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False))
    pos_code = (
        F.when(F.col("o_orderstatus") == "F", F.lit("11"))
        .when(F.col("o_orderstatus") == "O", F.lit("21"))
        .otherwise(F.lit("22"))
    )
    o = (
        orders.filter(F.col("o_orderkey").isNotNull() & F.col("o_custkey").isNotNull())
        .withColumn("k", F.col("o_custkey"))
        .filter(claims_kind)
        .select(
            "o_orderkey", "k", pos_code.alias("pos_code"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
            urgent.alias("urgent"), F.when(urgent, F.col("o_orderdate").cast("date")).alias("day"),
        )
        .join(lines, "o_orderkey", "left")
        .withColumn("rend_supp", F.get("lines", F.lit(0))["l_suppkey"])
    )
    o = o.join(supplier, o.rend_supp == supplier.s_suppkey, "left")
    line_values = F.transform("lines", lambda x: F.struct(
        x["l_partkey"].alias("part_key"), x["l_extendedprice"].cast("decimal(18,2)").alias("price"),
        x["l_quantity"].cast("decimal(18,2)").alias("qty"), x["l_shipdate"].cast("date").alias("day"),
        x["l_returnflag"].alias("flag"), x["l_linestatus"].alias("status")))
    order = F.struct(
        F.col("o_orderkey").alias("okey"), "pos_code", "price", "urgent", "day", "rend_supp", F.col("s_name").alias("rend_name"),
        line_values.alias("lines"))
    order_rows = o.select("k", F.floor(F.col("o_orderkey") / F.lit(FILE_KEY_SPAN)).cast("long").alias("part"), order.alias("order"))

    # texts that are the same all through a file
    fixed = {
        "lx": F.concat(F.lit("LX"), e), "hc": F.concat(F.lit("HC"), c, F.lit("P")), "un": F.concat(e, F.lit("UN"), e),
        "sv1": F.concat(F.lit("SV1"), e), "sv2": F.concat(F.lit("SV2"), e),
        "dtp": F.concat(F.lit("DTP"), e, F.lit("472"), e, F.lit("D8"), e),
    }

    def order_parts(x: Column) -> tuple[list[Column], Callable[[Column, Column], list[list[Column]]], list[Column]]:
        """An order's segments (missing ones are NULL): those before its lines, the texts of each segment of a line, those after."""
        ok = x["okey"]
        claim = [
            _seg(e, "CLM", ok, x["price"], "", "", F.concat_ws("", x["pos_code"], c, F.lit("B"), c, F.lit("1"))),
            F.when(x["urgent"], _seg(e, "DTP", "434", "D8", _ymd(x["day"]))),
            F.when(
                F.pmod(ok, F.lit(5)) != 0,
                _seg(e, "HI", F.concat_ws("", F.lit("ABK"), c, F.lit("D"), F.pmod(ok, F.lit(1000)).cast("string")),
                     F.concat_ws("", F.lit("ABF"), c, F.lit("Z"), F.pmod(ok, F.lit(77)).cast("string"))),
            ),
            F.when(
                x["rend_supp"].isNotNull(),
                _seg(e, "NM1", "82", "1", x["rend_name"], "DOC", "", "", "", "XX", x["rend_supp"] + 2000000000),
            ),
            F.when(
                F.pmod(ok, F.lit(6)) == 0,
                _seg(e, "NM1", "PR", "2", F.concat(F.lit("PAYER"), F.pmod(k, F.lit(7)).cast("string")), "", "", "", "", "PI",
                     F.concat(F.lit("PY"), F.pmod(k, F.lit(7)).cast("string"))),
            ),
        ]
        again = []
        if with_extras:
            okey = ok.cast("string")
            site = F.pmod(ok, F.lit(9))
            dearer = (x["price"] + F.lit("0.01").cast("decimal(18,2)")).cast("decimal(18,2)")
            claim += [
                F.when(F.pmod(ok, F.lit(4)) == 1, _seg(e, "NM1", "77", "2", F.concat(F.lit("SITE"), site.cast("string")), "", "", "", "",
                                                       "XX", site + 3000000000)),
                F.when(F.pmod(ok, F.lit(3)) == 0, _seg(e, "REF", "F8", F.concat(F.lit("R"), okey))),
                F.when(F.pmod(ok, F.lit(7)) == 0, _seg(e, "REF", "ZZ", F.concat(F.lit("X"), okey))),
            ]
            again = [F.when(F.pmod(ok, F.lit(11)) == 0, _seg(e, "CLM", ok, dearer))]

        def line(y: Column, i: Column) -> list[list[Column]]:
            pk, flag = y["part_key"], y["flag"]
            rest = [e, y["price"].cast("string"), F.col("un"), y["qty"].cast("string")]
            rev = (F.pmod(pk, F.lit(900)) + 100).cast("string")
            after_rev = F.when(F.pmod(ok, F.lit(2)) == 0, c).otherwise(e)
            sv = F.when(vendor != "vendorC", F.concat_ws("", F.col("sv1"), F.col("hc"), pk.cast("string"), c, flag, c, y["status"], *rest)).otherwise(
                F.concat_ws("", F.col("sv2"), rev, after_rev, F.col("hc"), pk.cast("string"), c, flag, *rest))
            return [[F.col("lx"), (i + 1).cast("string")], [sv], [F.col("dtp"), _ymd(y["day"])]]

        return claim, line, again

    def order_segs(x: Column) -> Column:
        """An order's segments, each at its place, so that orders of one key can be merged place by place."""
        claim, line, again = order_parts(x)
        lines = F.transform(x["lines"], lambda y, i: F.array(*[F.concat_ws("", *seg) for seg in line(y, i)]))
        lines = F.coalesce(F.flatten(lines), F.array().cast("array<string>"))
        return F.concat(F.array(*claim), lines, F.array(*again).cast("array<string>"))

    def order_text(x: Column) -> Column:
        """The same segments as one text."""
        claim, line, again = order_parts(x)

        def line_text(y: Column, i: Column) -> Column:
            first, *more = line(y, i)
            return F.concat_ws("", *first, *[t for seg in more for t in (sd, *seg)])

        return F.call_function("concat_ws", sd, *claim, F.transform(x["lines"], line_text), *again)

    head_rows = files.filter(body_kind & k.isNotNull() & F.col("part").isNotNull()).select(
        "k", "part", header.alias("header"), "last_order_ts",
    )

    # ---- one row a file: a customer that is there m times has m files, with every segment m times
    grouped = (
        head_rows.unionByName(order_rows, allowMissingColumns=True)
        .groupBy("k", "part")
        .agg(F.collect_list("header").alias("headers"), F.sort_array(F.collect_list("order")).alias("orders"),
             F.max("last_order_ts").alias("last_order_ts"))
        .filter(F.size("headers") > 0)
        .withColumns(own)
        .withColumns(fixed)
    )
    m = F.size("headers")

    def merged(rows: Column) -> Column:
        """``array<struct<okey, segs>>`` -> texts by order key and place, then text."""
        placed = F.transform(rows, lambda x: F.transform(
            x["segs"], lambda t, i: F.struct(x["okey"].alias("okey"), i.alias("at"), t.alias("text"))))
        return F.transform(F.array_sort(F.flatten(placed)), lambda x: x["text"])

    plain = (m == 1) & (F.size(F.array_distinct("orders.okey")) == F.size("orders"))
    segs = F.transform("orders", lambda x: F.struct(x["okey"].alias("okey"), order_segs(x).alias("segs")))
    every = F.flatten(F.transform(segs, lambda x: F.array_repeat(x, m)))
    heads = F.transform("headers", lambda h: F.struct(F.lit(0).cast("long").alias("okey"), h.alias("segs")))
    joined = lambda *texts: F.call_function("concat_ws", sd, *texts)
    text = F.when(plain, joined(F.get("headers", F.lit(0)), F.transform("orders", order_text), trailer)).otherwise(
        joined(merged(heads), merged(every), F.flatten(F.transform(trailer, lambda t: F.array_repeat(t, m)))))
    body_files = grouped.select("k", "part", "last_order_ts", "vendor_id", F.concat(text, sd).alias("text"), m.alias("_copies"))
    body_files = body_files.select("k", "part", "last_order_ts", "vendor_id", "text", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).drop("col")

    # ---- literal files
    short_isa = F.concat(
        _seg(e, "ISA", "00"), sd, _seg(e, "ST", "837", k, ver), sd, _seg(e, "CLM", k, "1.00"), sd,
        _seg(e, "SE", "1", k), sd,
    )
    literal = files.filter(~body_kind).withColumn(
        "text",
        F.when(kind == KIND_NOT_X12, F.concat(F.lit("BAD*"), k.cast("string"), F.lit("~"))).otherwise(short_isa),
    )

    all_files = body_files.unionByName(literal.select(body_files.columns))
    path = F.concat(
        F.lit(LANDING_ROOT + "/"), vendor, F.lit("/c"), k9,
        F.when(F.col("part") == 0, F.lit("")).otherwise(F.concat(F.lit("_"), F.col("part").cast("string"))),
    )
    out = all_files.select(
        path.alias("base"),
        F.coalesce(F.col("last_order_ts"), F.lit("1992-01-01 00:00:00").cast("timestamp")).alias("modificationTime"),
        F.encode(F.col("text"), "UTF-8").alias("content"),
        kind.alias("kind"),
    )
    copies = out.filter(F.col("kind") == KIND_DUPLICATE).withColumn("base", F.concat(F.col("base"), F.lit("_copy")))
    out = out.unionByName(copies)
    return out.select(
        F.concat(F.col("base"), F.lit(".x12")).alias("path"),
        "modificationTime",
        F.octet_length("content").cast("long").alias("length"),
        "content",
    )


def write_landing(landing: DataFrame, root: str) -> None:
    """Write every landing row as a real file ``root`` + ``path`` (in tasks; ``root`` has to be shared storage)."""

    def put(rows) -> None:
        import pyarrow.fs

        local = root.startswith("/")
        uri = root if local else re.sub("^file:/*", "file:///", root)
        fs, base = (pyarrow.fs.LocalFileSystem(), root) if local else pyarrow.fs.FileSystem.from_uri(uri)
        made = set()
        for r in rows:
            path = base.rstrip("/") + r["path"]
            folder = path.rsplit("/", 1)[0]
            if folder not in made:
                fs.create_dir(folder, recursive=True)
                made.add(folder)
            with fs.open_output_stream(path) as out:
                out.write(bytes(r["content"]))

    landing.select("path", "content").foreachPartition(put)
