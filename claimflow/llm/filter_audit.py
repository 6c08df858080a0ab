"""Filter interaction audit by count-weighted decision diagrams.

1. Every document gets a mask of the filters that it fails (bits in the order
   of ``FILTERS``). Repeats are found on narrow rows of id and text digest: the
   smallest id of a digest is joined back on (digest, id), so a text held by a
   third of all rows is spread by its ids.
2. Rows are counted per part and mask, with labelled good and toxic rows
   beside: at most 2**filters rows a part.
3. The counts of a part become a quasi-reduced decision diagram: one level a
   filter, equal subdiagrams shared, every node weighted by the documents below
   it. Adjacent level swaps, made in place, run through all orders (plain
   changes). In each order the path that passes every filter gives the steps:
   the fail child's weight is what the step removes, the pass child's what
   stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
#: Letters of the filters, by bit of the mask.
FILTERS = "ABCDE"
SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
_ARROW = pa.schema(
    [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
    + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
)

Weight = tuple[int, ...]


def _sum(a: Weight, b: Weight) -> Weight:
    return tuple(x + y for x, y in zip(a, b))


class Diagram:
    """A weighted decision diagram over failure masks; bit i of a mask is variable i.

    Every path meets every level, so a node's weight is that of its two
    children. Nodes of a level are shared when their children are equal.
    """

    def __init__(self, counts: dict[int, Weight], variables: int):
        width = len(next(iter(counts.values()), (0,)))
        self.order = list(range(variables))
        self.kids: dict[int, tuple[int, int]] = {}
        self.weight: dict[int, Weight] = {}
        self.levels: list[list[int]] = [[] for _ in range(variables)]
        leaves: dict[Weight, int] = {}

        def leaf(mask: int) -> int:
            w = counts.get(mask, (0,) * width)
            if w not in leaves:
                leaves[w] = self._new(w)
            return leaves[w]

        below = [leaf(mask) for mask in range(1 << variables)]
        for level in reversed(range(variables)):  # mask bits above this level stay open
            half = 1 << level
            made: dict[tuple[int, int], int] = {}
            below = [self._node(made, below[m], below[m + half]) for m in range(half)]
            self.levels[level] = list(made.values())
        self.root = below[0]

    def _new(self, weight: Weight) -> int:
        n = len(self.weight) if not self.weight else max(self.weight) + 1
        self.weight[n] = weight
        return n

    def _node(self, made: dict[tuple[int, int], int], passed: int, failed: int) -> int:
        key = (passed, failed)
        if key not in made:
            made[key] = n = self._new(_sum(self.weight[passed], self.weight[failed]))
            self.kids[n] = key
        return made[key]

    def swap(self, level: int) -> None:
        """Exchange the variables of ``level`` and the next; nodes above stay as they are."""
        made: dict[tuple[int, int], int] = {}
        for n in self.levels[level]:
            passed, failed = self.kids[n]
            (pp, pf), (fp, ff) = self.kids[passed], self.kids[failed]
            self.kids[n] = (self._node(made, pp, fp), self._node(made, pf, ff))
        for n in self.levels[level + 1]:
            del self.kids[n], self.weight[n]
        self.levels[level + 1] = list(made.values())
        o = self.order
        o[level], o[level + 1] = o[level + 1], o[level]

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """(variable, weight kept, weight removed) along the path that passes every variable."""
        n = self.root
        for v in self.order:
            passed, failed = self.kids[n]
            yield v, self.weight[passed], self.weight[failed]
            n = passed


def plain_changes(n: int) -> Iterator[int]:
    """Levels to swap with the next, one after the other, to meet all n! orders once."""
    if n < 2:
        return
    sweep = list(range(n - 2, -1, -1))
    at_end = True
    for inner in [*plain_changes(n - 1), None]:
        yield from sweep if at_end else reversed(sweep)
        at_end = not at_end
        if inner is not None:
            yield inner if at_end else inner + 1


def audit_part(counts: dict[int, Weight], filters: str = FILTERS) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part.

    ``counts``: by mask, the numbers of documents, good ones and toxic ones.
    """
    n = len(filters)
    fails = [sum(c[0] for m, c in counts.items() if m >> v & 1) for v in range(n)]
    alone = [counts.get(1 << v, (0, 0, 0))[0] for v in range(n)]
    shapley = [0] * n
    rows = []
    diagram = Diagram(counts or {0: (0, 0, 0)}, n)

    def walk() -> None:
        order = "".join(filters[v] for v in diagram.order)
        for i, (v, kept, removed) in enumerate(diagram.steps(), 1):
            shapley[v] += removed[0]
            rows.append((order, i, kept[0], removed[0], fails[v] - removed[0], alone[v], removed[1], removed[2], v))

    walk()
    for level in plain_changes(n):
        diagram.swap(level)
        walk()
    return [(*r[:-1], shapley[r[-1]]) for r in rows]


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
            counts = {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in cells}
            columns = list(zip(*((part, *r) for r in audit_part(counts))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def text_masks(text: Column) -> Column:
    """Bits 0 to 3 of the mask (A to D) of a text without null."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    letters = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failed = [
        n < 100,
        100 * distinct.cast("long") < 80 * n.cast("long"),
        100 * letters.cast("long") > 10 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]
    mask = F.lit(0)
    for bit, c in enumerate(failed):
        mask = mask + F.when(c, 1 << bit).otherwise(0)
    return mask


def mask_counts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    quality_col: str = "quality",
    toxic_col: str = "toxic",
) -> DataFrame:
    """``part, mask, n, good, toxic``: the documents of each part by the filters they fail."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), part.alias("part"), text.alias("text")).select(
        "id", "part", F.sha2("text", 256).alias("digest"), text_masks(F.col("text")).alias("own")
    )
    # rows that agree in all of this are one row with a count from here on
    rows = rows.groupBy("id", "part", "digest", "own").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True)).alias("f")
    rows = rows.alias("r").join(
        first, (F.col("r.digest") == F.col("f.digest")) & F.col("r.id").eqNullSafe(F.col("f.id")), "left"
    )
    rows = rows.select("r.id", "part", "n", (F.col("own") + F.when(F.col("first"), 0).otherwise(16)).alias("mask"))
    known = labels.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(quality_col) == 1, F.lit(False)).alias("good"),
        F.coalesce(F.col(toxic_col) == 1, F.lit(False)).alias("toxic"),
    ).where(F.col("id").isNotNull())
    known = known.groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    return (
        rows.join(known, "id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    quality_col: str = "quality",
    toxic_col: str = "toxic",
) -> DataFrame:
    """One row per part, order of the five filters and step (``SCHEMA``).

    Null texts are empty, null parts the empty string. A row fails E when a
    smaller id has the same text; rows that repeat the smallest id pass, and a
    null id counts as larger than any other (rows of null ids alone pass).
    Repeated rows count each. Of several labels of an id, one that says good
    (toxic) is enough; null labels say neither. Other columns are ignored. An
    empty table has no parts and gives no rows.
    """
    cells = F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")  # 32 a part at most
    counts = mask_counts(docs, labels, id_col, text_col, part_col, quality_col, toxic_col)
    return counts.groupBy("part").agg(cells).mapInArrow(_audit, SCHEMA)
