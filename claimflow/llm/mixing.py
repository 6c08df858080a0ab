"""Mixing documents to target domain weights with soft membership.

1. A classifier trained on the labelled table predicts, for every document,
   the probabilities of its domains.
2. Document ``i`` with ``n`` tokens and posteriors ``p`` taken at rate ``r``
   adds ``r * n * p`` expected tokens to the domains. Projected gradient steps
   of the least-squares problem ``min |W (sum r n p - target)|^2, r >= 0``
   move the rates from 1: with ``G = sum n p p'`` and ``W' W = inv(G)``, in
   units that weight a document by its tokens, the gradient of a document is
   ``p . y`` with ``y = inv(G) (sum r n p - target)`` and the step length 1 is
   safe; steps are taken with momentum. Each is one distributed sum of a few
   numbers a domain; a document's rate follows from the list of ``y`` so far,
   so no rate is stored between steps.
3. A document is emitted ``floor(rate)`` times, and once more with the
   probability of the rest, by a hash of its id and text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.llm.common import stored

#: Labelled documents of a domain that training reads at most, and bytes of each document's features.
SAMPLE_DOCS = 2000
#: Hash buckets of words; further features describe the text's shape.
BUCKETS, SHAPES = 2048, 6
STEPS, BATCH, RATE = 500, 128, 0.02
#: Words whose bucket a task remembers at most.
CACHE_WORDS = 500_000
#: Projected gradient steps at most, and the residual (as a share of the target total) that ends them.
MAX_STEPS, TOLERANCE = 60, 1e-4
#: Domains of the labelled table and the shares of the token total that the query asks for.
TARGETS = {"high": 0.85, "low": 0.12, "toxic": 0.03}


def label_domain(quality: Column, toxic: Column) -> Column:
    """The domain of a labelled row: toxic, or else high or low quality."""
    return F.when(toxic == 1, "toxic").when(quality == 1, "high").when(quality == 0, "low")


class Featurizer:
    """Hashed word shares of a text (L2-normalised) and its shape; also the number of words."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, raw: bytes | None) -> tuple[np.ndarray, int]:
        raw = raw or b""
        words = raw.split()
        out = np.zeros(BUCKETS + SHAPES, np.float32)
        if not words:
            return out, 0
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        distinct = set(words)
        for w in distinct.difference(known):
            known[w] = xxhash.xxh32_intdigest(w.strip(b".,!?;:#%$&*|\"'()").lower()) % BUCKETS
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        counts = np.log1p(np.bincount(ids, minlength=BUCKETS))
        out[:BUCKETS] = counts / np.linalg.norm(counts)
        n = len(raw)
        alpha = len(raw.translate(None, bytes(range(0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))))
        upper = n - len(raw.translate(None, bytes(range(0x41, 0x5B))))
        digit = n - len(raw.translate(None, b"0123456789"))
        space = n - len(raw.translate(None, b" \t\n\x0b\x0c\r"))
        out[BUCKETS:] = (
            alpha / n,
            upper / n * 4,
            digit / n * 4,
            (n - alpha - digit - space) / n * 4,
            len(distinct) / len(words),
            np.log1p(len(words)) / 8,
        )
        return out, len(words)


@dataclass
class Classifier:
    """Softmax regression over the features."""

    domains: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train(rows: list[tuple[int, str, bytes]], domains: list[str], prior: dict[str, float], seed: int = 9) -> Classifier:
    """Fit on (order, domain, features) rows, classes weighted alike; then shift to the class shares ``prior``.

    A domain without rows keeps a posterior near 0; without any rows all
    domains are alike.
    """
    rows = sorted(rows)
    n, k = len(rows), len(domains)
    w, b = np.zeros((BUCKETS + SHAPES, k), np.float32), np.zeros(k, np.float32)
    if not n:
        return Classifier(domains, w, b)
    x = np.frombuffer(b"".join(r[2] for r in rows), np.float32).reshape(n, -1)
    y = np.array([domains.index(r[1]) for r in rows])
    rng = np.random.default_rng(seed)
    groups = [g for g in (np.flatnonzero(y == c) for c in range(k)) if len(g)]
    state = [np.zeros_like(v) for v in (w, b, w, b)]
    for step in range(1, STEPS + 1):
        pick = np.concatenate([rng.choice(g, BATCH // len(groups)) for g in groups])
        d = Classifier(domains, w, b).posteriors(x[pick])
        d[np.arange(len(pick)), y[pick]] -= 1
        d /= len(pick)
        rate = RATE * (1 - step / (STEPS + 1))
        for i, (v, g) in enumerate(((w, x[pick].T @ d + 1e-4 * w), (b, d.sum(0)))):
            state[i] += 0.1 * (g - state[i])
            state[i + 2] += 0.01 * (g * g - state[i + 2])
            v -= rate * (state[i] / (1 - 0.9**step)) / (np.sqrt(state[i + 2] / (1 - 0.99**step)) + 1e-6)
    b += np.log(np.maximum([prior.get(c, 0.0) for c in domains], 1e-6)).astype(np.float32)
    return Classifier(domains, w, b)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make = Featurizer()
    for batch in batches:
        x = [make(raw)[0].tobytes() for raw in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("domain"), pa.array(x, pa.binary())], ["o", "domain", "x"])


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Train on at most SAMPLE_DOCS labelled documents a domain, chosen by hash.

    Only labels of ids in ``docs`` count, also for the class shares: a stage
    before may have left few of a domain.
    ``labelled`` has the id and a ``domain``; rows of null or unlisted domains
    teach nothing; of several domains of an id the first in order counts.
    """
    known = labelled.select(F.col(id_col).alias("i"), "domain").where(F.col("i").isNotNull() & F.col("domain").isin(domains))
    known = known.groupBy("i").agg(F.min("domain").alias("domain")).withColumn("o", F.xxhash64("i"))
    known = stored(known.join(docs.select(F.col(id_col).alias("i")), "i", "left_semi"), "mixing-labels")
    shares = {r.domain: r["count"] for r in known.groupBy("domain").count().toLocalIterator()}
    total = sum(shares.values())
    sample = None
    for d in domains:
        some = known.where(F.col("domain") == d).orderBy("o", "i").limit(SAMPLE_DOCS)
        sample = some if sample is None else sample.unionByName(some)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("binary").alias("text"))
    # at most SAMPLE_DOCS ids a domain
    rows = rows.join(F.broadcast(sample), "i").select("o", "domain", "text")
    found = rows.mapInArrow(_feature_rows, "o long, domain string, x binary").toLocalIterator()
    return train([(r.o, r.domain, bytes(r.x)) for r in found], domains, {d: n / total for d, n in shares.items()})


def _predicting(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Featurizer()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n, p = [], []
            for i in range(0, len(texts), 256):
                found = [make(raw) for raw in texts[i : i + 256]]
                n += [k for _, k in found]
                p += list(model.value.posteriors(np.stack([x for x, _ in found])).astype(np.float64))
            cols = [batch.column("row"), batch.column("u"), pa.array(n, pa.int64()), pa.array(p, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, ["row", "u", "n_tokens", "p"])

    return run


def posteriors(docs: DataFrame, model, carry: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (a struct of the ``carry`` columns), ``u`` (uniform by hash), ``n_tokens`` and posteriors ``p``; ``model`` is a broadcast."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit("mixing"), F.col(id_col), F.col(text_col)), 11).cast("double")) / float(1 << 53)
    rows = docs.select(F.struct(*carry).alias("row"), u.alias("u"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType(
        [rows.schema["row"], rows.schema["u"], T.StructField("n_tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))]
    )
    return rows.mapInArrow(_predicting(model), schema)


def _states(steps: list[list[float]], domains: int) -> Column:
    """A document's last two rates after the steps, from its posteriors ``p``.

    A step holds ``y`` and the momentum: from ``z = rate + momentum * (rate -
    rate before)`` it goes to ``max(0, z - p . y)``.
    """
    state = lambda rate, before: F.struct(rate.alias("rate"), before.alias("before"))
    one = F.lit(1.0)
    if not steps:
        return state(one, one)
    ys = F.array(*[F.array(*[F.lit(float(v)) for v in y]) for y in steps])

    def move(s: Column, y: Column) -> Column:
        z = s["rate"] + y[domains] * (s["rate"] - s["before"])
        for d in range(domains):
            z = z - F.col("p")[d] * y[d]
        return state(F.greatest(F.lit(0.0), z), s["rate"])

    return F.aggregate(ys, state(one, one), move)


def rate_of(steps: list[list[float]], domains: int) -> Column:
    """A document's rate after the projected steps."""
    return _states(steps, domains)["rate"]


def fit_rates(known: DataFrame, weights: list[float], budget: float | None = None) -> list[list[float]]:
    """The projected gradient steps for documents with ``n_tokens`` and ``p``.

    ``weights`` are the targets' shares of ``budget`` tokens (all tokens if
    null). Every step is one pass over the narrow table and brings twice as many
    sums to the driver as there are domains. Targets out of reach are
    approached in the least-squares sense.
    """
    k = len(weights)
    n, p = F.col("n_tokens"), F.col("p")
    gram = known.agg(F.sum(n), *[F.sum(n * p[i] * p[j]) for i in range(k) for j in range(k)]).first()
    if not gram[0]:
        return []
    inverse = np.linalg.pinv(np.array(gram[1:], float).reshape(k, k), rcond=1e-9, hermitian=True)
    total = float(budget or gram[0])
    target = np.array(weights, float) / sum(weights) * total
    steps: list[list[float]] = []
    for i in range(MAX_STEPS):
        momentum = i / (i + 3)
        now = known.select("n_tokens", "p", _states(steps, k).alias("s"))
        ahead = F.col("s.rate") + F.lit(momentum) * (F.col("s.rate") - F.col("s.before"))
        sums = now.agg(*[F.sum(n * x * p[d]) for x in (F.col("s.rate"), ahead) for d in range(k)]).first()
        off = np.array(sums, float).reshape(2, k) - target
        if np.abs(off[0]).sum() <= TOLERANCE * total:
            break
        steps.append([*(inverse @ off[1]).tolist(), momentum])
    return steps


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    carry: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: float | None = None,
) -> DataFrame:
    """One row per input row: ``row``, ``n_tokens``, ``p``, ``rate`` and ``copies``.

    Tokens are runs without ASCII white space. Texts without tokens (null,
    empty) keep a rate like any other and add nothing to the totals. Repeated
    rows are documents of their own with equal rates and copies. An empty
    table gives an empty result. The texts are read once: posteriors are
    stored with the ``carry`` columns, and the steps read only the numbers.
    """
    domains = list(targets)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labelled, domains, id_col, text_col))
    known = stored(posteriors(docs, model, carry, id_col, text_col), "mixing-posteriors")
    steps = fit_rates(known.select("n_tokens", "p"), [targets[d] for d in domains], budget)
    rated = known.withColumn("rate", rate_of(steps, len(domains)))
    return rated.withColumn("copies", F.floor(F.col("rate") + F.col("u")).cast("int")).drop("u")


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, each as often as its copies; same columns."""
    found = mix(docs, labelled, targets, docs.columns, id_col, text_col).where("copies > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
