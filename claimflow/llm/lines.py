"""Near-duplicate lines by a deletion-neighbourhood join (DataFrame functions only).

Lines within one edit (a character changed, added or removed) of an earlier
line are dropped, as are repeats. Lines too short for an edit to leave much of
them are compared for equality only. Two different lines are one edit apart in
one of two ways, and each is a variant that both emit:

* changed: equal length, and deleting the same position leaves the same text;
* added: deleting some position of the longer line leaves the shorter one.

Emitting every variant of every line of the corpus would cost as many rows as
there are characters. Three steps emit only those that can join, and lose none:

1. an edit leaves the first or the second half of a line untouched, so only
   lines that share a half (and length class) with another line go on;
2. of ``CHUNKS`` chunks the edit touches one, so only lines that share all of
   a line but one chunk go on;
3. the variants of that chunk are emitted as hashed keys: a key holds the
   rest of the line, the place of the chunk, and the chunk less a character.

Equal keys are joined by an aggregate that keeps a group's earliest line, so
no pairs inside a group are formed; every line meets the earliest of each of
its groups, the edit distance of the two texts is verified, and the earliest
verified line wins. Lines are named by two 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import stored

#: Lines of fewer characters (after trimming) are near no other line; their repeats go all the same.
LEAST_CHARS = 10
#: Characters trimmed from both ends of a line.
TRIMMED = " \t\r\x0b\x0c"
#: Chunks that a line is cut into.
CHUNKS = 8


def _trimmed(line: Column) -> Column:
    """The line without white space at its ends; lines without any there (most) are passed on as they are."""
    ragged = F.lit(False)
    for c in TRIMMED:
        ragged = ragged | line.startswith(c) | line.endswith(c)
    return F.when(ragged, F.trim(line, F.lit(TRIMMED))).otherwise(line)


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every line that isn't empty: its place (``at``: id, row hash, number), trimmed text, and name (``a``, ``b``)."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("g"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "raw")
    )
    rows = rows.select("id", "g", "line_no", _trimmed(F.col("raw")).alias("line")).where(F.col("line") != "")
    return rows.select(
        F.struct("id", "g", "line_no").alias("at"), "line", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b")
    )


def _half_keys(line: Column) -> list[Column]:
    """Both halves in the frame of the line's length, and in that of a line one longer."""
    keys = []
    for more in (0, 1):
        m = F.char_length(line) + more
        h = F.floor(m / 2).cast("int")
        keys.append(F.xxhash64(F.lit("head"), m, F.left(line, h)))
        keys.append(F.xxhash64(F.lit("tail"), m, F.right(line, m - h)))
    return keys


def _frames(line: Column) -> Column:
    """The line cut at one chunk, in both frames: key of the rest, role, chunk.

    In a frame of ``m`` characters chunk ``i`` covers ``size`` of them from ``i * size``. A line of ``m``
    characters has the chunk itself (role 2); one of ``m - 1`` has a character
    less there (role 1).
    """

    def frame(more: int) -> Column:
        m = F.char_length(line) + more
        size = F.ceil(m / CHUNKS).cast("int")

        def cut(i: Column) -> Column:
            start = i * size
            length = F.least(size, m - start) - more
            rest = F.xxhash64(m, i, F.xxhash64(F.substring(line, F.lit(1), start)), F.xxhash64(F.substring(line, start + length + 1, m)))
            return F.struct(rest.alias("rest"), F.lit(2 - more).alias("role"), F.substring(line, start + 1, length).alias("chunk"))

        last = F.floor((m - 1) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), last), cut)

    return F.concat(frame(0), frame(1))


def _variants(rest: Column, role: Column, chunk: Column) -> Column:
    """Keys of a chunk's variants with the role in the key's group.

    Role 0: lines that agree but for the character at the place deleted. Role
    1: the shorter line of a group of lines one character longer (role 2).
    """
    places = F.sequence(F.lit(1), F.char_length(chunk))

    def less(p: Column) -> Column:
        return F.concat(F.left(chunk, p - 1), F.substring(chunk, p + 1, F.char_length(chunk)))

    changed = F.transform(places, lambda p: F.struct(F.xxhash64(rest, p, less(p)).alias("key"), F.lit(0).alias("part")))
    longer = F.transform(places, lambda p: F.struct(F.xxhash64(rest, less(p)).alias("key"), F.lit(2).alias("part")))
    shorter = F.array(F.struct(F.xxhash64(rest, chunk).alias("key"), F.lit(1).alias("part")))
    return F.when(role == 1, shorter).otherwise(F.concat(changed, F.array_distinct(longer)))


def near_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> tuple[DataFrame, DataFrame]:
    """Two stored tables over the different lines: all (``a``, ``b``, ``first``, ``n``) and near ones (``a``, ``b``, ``keep``).

    ``first`` is a line's earliest place and ``n`` its number of places;
    ``keep`` is the earliest place of an earlier line one edit away.
    """
    seen = occurrences(docs, id_col, text_col)
    # keys before the aggregate: what it sorts are numbers, no lines
    halves = {f"h{i}": F.when(F.char_length("line") >= least_chars, k) for i, k in enumerate(_half_keys(F.col("line")))}
    named = seen.select("at", "a", "b", *[k.alias(h) for h, k in halves.items()])
    distinct = named.groupBy("a", "b").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"), *[F.first(h).alias(h) for h in halves])
    distinct = stored(distinct, "line-names")

    halves = distinct.where("h0 IS NOT NULL").select("a", "b", F.explode(F.array_distinct(F.array(*halves))).alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half")
    close = halves.join(shared, "half").select("a", "b").distinct()
    close = distinct.select("a", "b", "first").join(close, ["a", "b"])
    texts = seen.join(close, ["a", "b"]).where(F.col("at") == F.col("first")).select("a", "b", "first", "line")
    texts = stored(texts, "line-texts")

    frames = texts.select("a", "b", "first", F.explode(_frames(F.col("line"))).alias("f")).select("a", "b", "first", "f.*")
    crowded = frames.groupBy("rest").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("rest")
    frames = stored(frames.join(crowded, "rest"), "line-frames")

    keys = frames.select("a", "b", "first", F.explode(_variants(F.col("rest"), F.col("role"), F.col("chunk"))).alias("v"))
    keys = keys.select("a", "b", "first", "v.key", "v.part")
    line = F.struct("first", "a", "b")
    groups = keys.groupBy("key").agg(F.min(F.when(F.col("part") < 2, line)).alias("up"), F.min(F.when(F.col("part") == 2, line)).alias("low"), F.count(F.lit(1)).alias("c"))
    partner = F.when(F.col("part") == 1, F.col("low")).otherwise(F.col("up"))
    pairs = keys.join(groups.where("c > 1 and up is not null"), "key").select("a", "b", "first", partner.alias("p"))
    pairs = pairs.where(F.col("p.first") < F.col("first")).select("a", "b", F.col("p.a").alias("pa"), F.col("p.b").alias("pb")).distinct()

    mine = texts.select("a", "b", "line")
    other = texts.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("line").alias("other"), F.col("first").alias("keep"))
    near = pairs.join(mine, ["a", "b"]).join(other, ["pa", "pb"]).where(F.levenshtein("line", "other", 1) == 1)
    near = stored(near.groupBy("a", "b").agg(F.min("keep").alias("keep")), "line-near")
    return distinct.select("a", "b", "first", "n"), near


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per input row: ``id``, ``g`` (row hash), ``n_lines``, ``n_exact``, ``n_near`` and ``dropped`` line numbers.

    Lines are the pieces between newlines, trimmed of ASCII white space;
    "earliest" is by id, then row hash, then line number (from 0). A line is
    dropped when an earlier place holds the same line (``n_exact``), or when
    some earlier line is one edit away, dropped itself or not (``n_near``, all
    places of the line). Lines under ``least_chars`` are near no line; empty
    lines stay. A null text has no lines, an empty one an empty line. Rows equal in id and text share their
    decisions. Only id and text are read; an empty table gives an empty result.
    """
    names, near = near_lines(docs, id_col, text_col, least_chars)
    marked = names.join(near, ["a", "b"], "left").where(F.col("keep").isNotNull() | (F.col("n") > 1))
    marked = marked.select("a", "b", "first", F.col("keep").isNotNull().alias("near"))
    seen = occurrences(docs, id_col, text_col).select("at", "a", "b")
    gone = seen.join(marked, ["a", "b"]).where(F.col("near") | (F.col("at") != F.col("first")))
    by_doc = gone.select("at.*", "near").groupBy("id", "g").agg(
        F.sort_array(F.collect_set("line_no")).alias("dropped"), F.collect_set(F.when(F.col("near"), F.col("line_no"))).alias("near")
    )
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("g"), F.coalesce(F.size(F.split(text_col, "\n")), F.lit(0)).alias("n_lines")
    )
    same = rows["g"].eqNullSafe(by_doc["g"]) & rows["id"].eqNullSafe(by_doc["id"])
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    return rows.join(by_doc, same, "left").select(
        rows["id"],
        rows["g"],
        F.greatest("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        (n("dropped") - n("near")).alias("n_exact"),
        n("near").alias("n_near"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )


def without_lines(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents less the dropped lines that ``line_dedup`` found in them; same columns."""
    gone = found.where(F.size("dropped") > 0).select("g", "dropped").dropDuplicates(["g"])
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(id_col, text_col).alias("g"), F.col(text_col).alias("text"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("dropped", i)), "\n")
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept)
    out = rows.join(gone, "g", "left").select("row", text.alias("text"))
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
