"""Target-distribution importance resampling over hashed features, with length-bucketed CRC matrices.

1. One Arrow pass cuts the texts into words. The distinct features of a slice
   of texts are grouped by their byte length; each group is a matrix of
   uint8, one feature a row, whose CRC-32s are updated together, column by
   column. Their buckets are scattered back to the texts and stored packed, so
   no later step reads a text again.
2. Bucket counts of the corpus and of the target give a gain per bucket (one
   small vector, its length the parameter ``buckets``), the gains a weight per
   text, and a Gumbel draw hashed from the id a score.
3. The highest scores are drawn. A histogram of the integer scores gives the
   score below which none is drawn; the rows above are range-partitioned and
   sorted, and a row's rank is its place in its partition plus the rows of
   the partitions before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.llm.common import stored

#: Reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
#: Bytes of text whose features are hashed together.
SLICE_BYTES = 4 << 20
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1)
    return c.astype(np.uint32)


_TABLE = _crc_table()


def crc32_all(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every byte string: those of equal length are one matrix, updated column by column."""
    out = np.zeros(len(features), np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    ends = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, ends):
        size = int(lengths[rows[0]]) if len(rows) else 0
        if not size:
            continue  # the checksum of no bytes is 0
        joined = b"".join([features[i] for i in rows])
        matrix = np.frombuffer(joined, np.uint8).reshape(-1, size)
        columns = np.ascontiguousarray(matrix.T)
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in columns:
            crc = _TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[rows] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def words_of(raw: bytes | None) -> list[bytes]:
    """Runs of 0-9, a-z and non-ASCII bytes, A-Z lower-cased."""
    return raw.translate(_FOLD).split() if raw else []


def features_of(words: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` consecutive words, joined by one space."""
    out = list(words)
    for n in range(2, longest + 1):
        out += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return out


def _packed(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def _slices(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= SLICE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _hashing(longest: int, buckets: int, packed: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _slices(texts):
                words = [words_of(t) for t in texts[a:b]]
                found = [features_of(w, longest) for w in words] if longest > 1 else words
                distinct = list({f for fs in found for f in fs})
                at = dict(zip(distinct, (crc32_all(distinct) % np.uint32(buckets)).tolist()))
                blobs = [np.fromiter(map(at.__getitem__, fs), packed, len(fs)).tobytes() for fs in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(a, b - a),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([len(fs) for fs in found], pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    ["id", "n_words", "n_features", "hashed"],
                )

    return run


def _joined(batch: pa.RecordBatch, packed: type) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("hashed").to_pylist()), packed)


def _counting(buckets: int, packed: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_joined(batch, packed), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    return run


def _weighing(gains, packed: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_features").to_numpy()
            ends = np.cumsum(n)
            sums = np.concatenate([[0], np.cumsum(gains.value[_joined(batch, packed)])])
            total = sums[ends] - sums[ends - n]
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.select(["rid", "id", "n_words", "n_features"]).columns, pa.array(weight, pa.int64())], ["rid", "id", "n_words", "n_features", "weight"])

    return run


def hashed_features(df: DataFrame, id_col: str | None, text_col: str, longest: int, buckets: int) -> DataFrame:
    """``rid, id, n_words, n_features, hashed``: the buckets of every text's features, packed in order."""
    id_ = F.col(id_col) if id_col else F.lit(None).cast("long")
    rows = df.select(id_.alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_features", T.LongType()),
            T.StructField("hashed", T.BinaryType()),
        ]
    )
    found = rows.mapInArrow(_hashing(longest, buckets, _packed(buckets)), schema)
    return stored(found.withColumn("rid", F.monotonically_increasing_id()), "resample-features")


def bucket_counts(hashed: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; at most ``buckets`` rows reach the driver."""
    counted = hashed.select("hashed").mapInArrow(_counting(buckets, _packed(buckets)), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of target to corpus per bucket, in floored thousandths."""
    n = len(corpus)
    whole, aim = float(corpus.sum()) + n, float(target.sum()) + n
    return np.array(
        [math.floor(1000 * math.log((t + 1) * whole / ((s + 1) * aim))) for s, t in zip(corpus.tolist(), target.tolist())],
        np.int64,
    )


def gumbel(id_col: Column, seed: int) -> Column:
    """Floored thousandths of a Gumbel draw hashed from seed and id (a null id hashes as the empty text)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, percent: int) -> DataFrame:
    """``rid, rank``: the ``percent`` % highest scores, ties to the smaller id (null ids last), then to ``rid``.

    Scores are thousandths of logarithms, so there are some ten thousand
    different ones whatever the number of rows: the histogram is small.
    """
    spark = scored.sparkSession
    histogram = sorted(((r.score, r.n) for r in scored.groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    drawn = percent * sum(n for _, n in histogram) // 100
    seen, least = 0, None
    for score, n in histogram:
        if seen >= drawn:
            break
        seen, least = seen + n, score
    if least is None:
        return spark.createDataFrame([], "rid long, rank long")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("rid")]
    top = scored.where(F.col("score") >= least).repartitionByRange(*order).sortWithinPartitions(*order)
    # the number of a row holds its partition above 33 bits of its place in it
    placed = stored(top.select("rid", F.monotonically_increasing_id().alias("place")), "resample-order")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r.part, r.n) for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for p, n in sizes:  # one row a partition
        starts.append((p, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(starts, "part long, before long"))
    found = placed.select("rid", part.cast("long").alias("part"), inside.alias("inside")).join(offsets, "part")
    return found.select("rid", (F.col("before") + F.col("inside") + 1).alias("rank")).where(F.col("rank") <= drawn)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
) -> DataFrame:
    """One row per input row: id, n_words, n_features, weight, score, rank (null where not drawn).

    Null and empty texts have no words, weight 0 and a score, and are never
    drawn while ``least_words`` is above 0. Repeated rows are scored each and
    get ranks of their own. Ties go to the smaller id, then to the order in
    which rows were read. Other columns are ignored. An empty table gives an
    empty result, an empty target the gains of no target word at all.
    """
    hashed = hashed_features(docs, id_col, text_col, longest, buckets)
    aim = hashed_features(target, None, target_text_col, longest, buckets)
    gains = bucket_gains(bucket_counts(hashed, buckets), bucket_counts(aim, buckets))
    # one vector of ``buckets`` numbers
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    fields = [hashed.schema[c] for c in ("rid", "id", "n_words", "n_features")]
    weighed = hashed.mapInArrow(
        _weighing(shared, _packed(buckets)), T.StructType([*fields, T.StructField("weight", T.LongType())])
    )
    scored = stored(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "resample-scores")
    drawn = ranked(scored.where(F.col("n_words") >= least_words), percent)
    return scored.join(drawn, "rid", "left").select(
        F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank"
    )
