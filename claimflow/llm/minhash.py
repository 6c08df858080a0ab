"""Near-duplicate detection by b-bit MinHash.

1. One Arrow pass hashes each text's distinct word shingles and takes
   ``ROWS * BANDS`` minima; it stores per document the set's size, a digest of
   the whole set, and one key per band of minima.
2. Equal sets (equal digests) become one class; only classes go on, so exact
   copies never meet each other in a bucket. Classes sharing a band key are
   candidates.
3. For the classes that share a key, the packed signature is made: the
   ``BITS`` low bits of ``HASHES`` minima, the first of them the band minima.
   A candidate pair goes on when its sizes allow the threshold and its
   similarity, estimated from the bit counts of two signatures and corrected
   for chance agreement of the bits, is not more than ``SIGMAS`` standard
   errors below it. Links are then confirmed on the full shingle sets.
4. First each class is compared with its bucket's smallest class only, and
   components are formed. What is still open are pairs inside a bucket that
   lie in different components: each class outside the component of its
   bucket's smallest class is compared with the bucket's members of other
   components, by the same estimate inside the join condition (in the first
   bucket that both share) and the same confirmation. So no link between
   different components is lost, and a large group of near copies is not
   expanded into its pairs.

With bands of 5 minima a pair at the threshold of 0.8 shares none of its 32
keys with probability 0.672 ** 32 = 3e-6; pairs above it with less.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.llm.common import stored
from claimflow.llm.components import components

ROWS, BANDS = 5, 32
#: Minima and low bits of a signature; lanes of a 64-bit word, and words that hold the band minima.
HASHES, BITS = 1024, 2
LANES = 64 // BITS
COARSE = ROWS * BANDS // LANES
#: Standard errors that an estimate may lie below the threshold before the pair is given up.
SIGMAS = 5.0
#: Words whose hash a task remembers at most.
CACHE_WORDS = 500_000

_rng = np.random.default_rng(8)
_MULTIPLIERS = _rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_ROW_MIX = _rng.integers(0, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)
_BAND_MIX = _rng.integers(0, 2**63, BANDS, dtype=np.uint64)
_WORD_MIX = _rng.integers(0, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct hashed shingles of texts: words are split at ASCII white space after lower-casing A-Z."""

    def __init__(self, size: int):
        self.size = size
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        n = len(h) - size + 1
        out = np.full(n, size, np.uint64)
        for i in range(size):
            out += mix(h[i : i + n] + np.uint64(i)) * _WORD_MIX[i]
        return np.unique(mix(out))


def minima(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """The smallest value of each of the first hash functions over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(hashes, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(low, np.multiply.outer(x[i : i + 512], _MULTIPLIERS[:hashes]).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    return mix((low.astype(np.uint64).reshape(BANDS, ROWS) * _ROW_MIX).sum(axis=1) + _BAND_MIX).view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    """The signature: ``BITS`` bits of each (scrambled) minimum, ``LANES`` to a word."""
    bits = ((low * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64)
    shift = np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)
    return (bits.reshape(-1, LANES) << shift).sum(axis=1, dtype=np.uint64).view(np.int64)


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(size)
        for batch in batches:
            n, k, bands = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle(text)
                n.append(len(s))
                k.append(blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(band_keys(minima(s, ROWS * BANDS)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "g", "h")),
                    pa.array(n, pa.int64()),
                    pa.array(k, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["id", "g", "h", "n", "k", "bands"],
            )

    return sign


def _set_maker(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(size)
        kind = pa.list_(pa.int64())
        for batch in batches:
            sets = [shingle(text) for text in batch.column("text").to_pylist()]
            sigs = [packed(minima(s, HASHES)) for s in sets]
            cols = [pa.array([s.view(np.int64) for s in sets], kind), pa.array(sigs, kind)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *cols], ["node", "shingles", "sig"])

    return make


def _differing(a: Column, b: Column) -> Column:
    """Lanes of two signature words that differ in any of their bits."""
    ones = sum(1 << (BITS * i) for i in range(LANES))
    x = a.bitwiseXOR(b)
    lanes = x
    for j in range(1, BITS):
        lanes = lanes.bitwiseOR(F.shiftrightunsigned(x, j))
    return F.bit_count(lanes.bitwiseAND(F.lit(ones - (1 << 64) if ones >> 63 else ones)))


def most_differing(percent: int, hashes: int) -> int:
    """Differing lanes at which an estimate is ``SIGMAS`` standard errors below the threshold.

    Two sets of similarity j agree in a lane with probability p = j + (1 - j) * c,
    c = 2 ** -BITS by chance; the estimate is (m / hashes - c) / (1 - c).
    """
    c = 2.0**-BITS
    j = percent / 100
    p = j + (1 - j) * c
    least = j - SIGMAS * (p * (1 - p) / hashes) ** 0.5 / (1 - c)
    return int(hashes * (1 - c) * (1 - least))


def _plausible(percent: int) -> Column:
    """Sizes that allow the threshold, and an estimate near or above it (columns n/sig and n2/sig2).

    The estimate is read from the band minima's words first and, where they
    don't rule the pair out, from the whole signatures.
    """
    small, large = F.least("n", "n2"), F.greatest("n", "n2")
    coarse = sum((_differing(F.col("sig")[i], F.col("sig2")[i]) for i in range(1, COARSE)), _differing(F.col("sig")[0], F.col("sig2")[0]))
    fine = F.aggregate(F.zip_with("sig", "sig2", _differing), F.lit(0), lambda n, x: n + x)
    return (
        (small * 100 >= large * percent)
        & (coarse <= most_differing(percent, ROWS * BANDS))
        & (fine <= most_differing(percent, HASHES))
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    sa = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return pairs.join(sb, "b").join(sa, "a").where(both * 100 >= union * percent).select("a", "b").distinct()


def _row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """128 bits of id and text by which rows are found again (equal rows share them)."""
    return F.xxhash64(id_col, text_col).alias("g"), F.xxhash64(text_col).alias("h")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: ``id``, ``g`` and ``h`` (the row's key), ``n_shingles``, ``component_id``.

    Documents are linked when 100 * intersection >= ``percent`` * union of
    their sets of distinct ``size``-word shingles (a text of fewer words is
    one shingle); ``component_id`` is the smallest id reachable over links.
    Texts without words, null ones included, are linked with nothing and keep
    their own id. Repeated rows and repeated ids are rows of their own.
    Columns other than id and text are not read; an empty table gives an
    empty result.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("g", T.LongType()),
            T.StructField("h", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("k", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    rows = docs.select(F.col(id_col).alias("id"), *_row_key(id_col, text_col), F.col(text_col).cast("binary").alias("text"))
    signed = rows.mapInArrow(_signer(size), schema).withColumn("rid", F.monotonically_increasing_id())
    signed = stored(signed, "minhash-signatures")

    classes = signed.where("n > 0").groupBy("k").agg(F.min("rid").alias("node"), F.min("id").alias("least_id"))
    classes = stored(classes, "minhash-classes")
    nodes = signed.join(classes.select(F.col("node").alias("rid")), "rid").withColumnRenamed("rid", "node")
    nodes = stored(nodes.select("node", "g", "h", "bands"), "minhash-nodes")

    keys = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("c")).where("c > 1")
    matched = stored(keys.join(shared.select("bucket", "center"), "bucket"), "minhash-buckets")

    # the full sets and signatures of every class that shares a bucket
    met = nodes.join(matched.select("node").distinct(), "node")
    once = Window.partitionBy("g", "h").orderBy("node")  # of equal rows, one stands for the class
    texts = rows.drop("id").join(met.select("node", "g", "h"), ["g", "h"]).withColumn("nth", F.row_number().over(once))
    texts = texts.where("nth = 1").select("node", "text")
    sets = texts.mapInArrow(_set_maker(size), "node long, shingles array<long>, sig array<long>")
    sets = stored(sets, "minhash-sets")

    marks = sets.select("node", F.size("shingles").alias("n"), "sig")
    marks2 = marks.toDF("node2", "n2", "sig2")
    keys_of = met.select("node", "bands")
    star = matched.where("node != center").select(F.col("center").alias("node2"), "node").distinct()
    star = star.join(marks, "node").join(marks2, "node2").where(_plausible(percent))
    links = stored(_confirmed(star.select(F.col("node2").alias("a"), F.col("node").alias("b")), sets, percent), "minhash-links")
    labels = stored(components(links), "minhash-labels")

    # open pairs: members of a bucket in different components, one of them outside its center's component
    of_center = labels.select(F.col("node").alias("center"), F.col("comp").alias("main"))
    placed = (
        matched.join(labels, "node", "left")
        .join(of_center, "center", "left")
        .select(
            "bucket",
            "node",
            "center",
            F.coalesce("comp", "node").alias("comp"),
            F.coalesce("main", "center").alias("main"),
        )
    )
    outside = stored(placed.where("comp != main"), "minhash-outside")
    crowded = outside.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_out"))
    others = placed.where("node != center").join(crowded, "bucket").where("n_out > 1 or comp = main")
    others = others.join(marks, "node").join(keys_of, "node").select(
        "bucket",
        F.col("node").alias("node2"),
        F.col("comp").alias("comp2"),
        (F.col("comp") == F.col("main")).alias("in_main"),
        F.col("n").alias("n2"),
        F.col("sig").alias("sig2"),
        F.col("bands").alias("bands2"),
    )
    outside = outside.join(marks, "node").join(keys_of, "node")
    differ = (F.col("comp") != F.col("comp2")) & (F.col("in_main") | (F.col("node") < F.col("node2")))
    first = F.col("bucket") == F.array_min(F.array_intersect("bands", "bands2"))
    open_pairs = outside.drop("main", "center").join(others, "bucket").where(differ & _plausible(percent) & first)
    open_pairs = open_pairs.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()
    late = _confirmed(open_pairs, sets, percent)
    la = labels.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    lb = labels.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    late = late.join(la, "a", "left").join(lb, "b", "left")
    late = stored(late.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct(), "minhash-late")
    merged = components(late).select(F.col("node").alias("comp"), F.col("comp").alias("top"))

    named = (
        classes.join(labels, "node", "left")
        .select("k", "least_id", F.coalesce("comp", "node").alias("comp"))
        .join(merged, "comp", "left")
        .select("k", "least_id", F.coalesce("top", "comp").alias("comp"))
    )
    least = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    by_set = named.join(least, "comp").select("k", "component_id")
    out = signed.select("id", "g", "h", "n", "k").join(by_set, "k", "left")
    return out.select(
        "id", "g", "h", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """The documents with one row of each group of near duplicates: that of the smallest id; same columns.

    Of rows that repeat the staying id and text, one stays. Texts without
    words all stay.
    """
    found = near_duplicates(docs, id_col, text_col, size, percent)
    empty = F.col("n_shingles") == 0
    stay = found.where(empty | F.col("id").eqNullSafe(F.col("component_id")))
    stay = stay.groupBy("g", "h").agg(F.first(empty).alias("empty"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_row_key(id_col, text_col))
    nth = F.row_number().over(Window.partitionBy("g", "h").orderBy("g"))
    kept = rows.join(stay, ["g", "h"]).withColumn("nth", nth).where("nth = 1 or empty")
    return kept.select("row.*")
