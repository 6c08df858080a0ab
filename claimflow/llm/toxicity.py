"""Toxicity scores: a bidirectional GRU with attention pooling over character and word inputs.

A word enters as the sum of what is known of it: a hashed word embedding, and
the mean of the hashed embeddings of its character n-grams. Windows of
``WINDOW`` words, one every ``STRIDE`` words, run through a GRU in either
direction; attention pools the states and a logistic unit gives the window's
probability. A document's score is a logistic function, fitted on labelled
rows that the network was not trained on, of the mean over all its windows
and of their number; it is shifted so that the threshold is the cut of the
highest F1 on those rows.

The network is trained in numpy, in one task, on a bounded sample of labelled
rows: at most ``SAMPLE_DOCS`` documents a class, chosen by hash. Their texts
are read whole: training draws from all their windows, and the document's
function and the threshold's cut are fitted on the mean over all windows and
their full number, the quantities that scoring applies them to.
"""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of a window, and words from one window's start to the next.
WINDOW, STRIDE = 64, 48
#: Labelled documents of a class that training reads at most; windows that a document counts for at most when
#: training draws (each of its windows is as likely as the others).
SAMPLE_DOCS, SAMPLE_WINDOWS = 3000, 6
#: Hash buckets of words and of character n-grams; sizes of embeddings and states.
WORD_BUCKETS, GRAM_BUCKETS, WORD_DIM, GRAM_DIM, HIDDEN = 1 << 15, 1 << 15, 8, 8, 8
GRAMS = (4, 6)
#: Bytes of a word that its features hold; a longer run is read as pieces of so many bytes.
WIDTH = 40
#: Distinct words whose inputs a task remembers, and windows of one forward pass.
CACHE_WORDS, CHUNK = 200_000, 2048
STEPS, BATCH, RATE = 320, 256, 0.015
#: Floor of the optimiser's scale for embeddings: what few windows say moves them little.
EMBED_EPS = 1e-3
#: Training documents that must hold a word or an n-gram before it has an embedding (rarer ones say nothing).
LEAST_WORD_DOCS, LEAST_GRAM_DOCS = 3, 6
#: Score from which a document is predicted to be toxic.
THRESHOLD = 0.7

_WORD_BYTES = bytes(
    i + 32 if 0x41 <= i <= 0x5A else i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20
    for i in range(256)
)


def words_of(raw: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII bytes; runs over WIDTH bytes as overlapping pieces.

    Scripts without spaces make such runs. Neighbouring pieces share one byte
    less than the longest n-gram has, so every n-gram of the run is in one.
    """
    words = (raw or b"").translate(_WORD_BYTES).split()
    if max(map(len, words), default=0) <= WIDTH:
        return words
    shared = max(GRAMS) - 1
    return [w[s : s + WIDTH] for w in words for s in range(0, max(len(w) - shared, 1), WIDTH - shared)]


def starts_of(n: int) -> range:
    """Starts of the windows over ``n`` words: every word is in one, neighbours overlap."""
    return range(0, max(n - (WINDOW - STRIDE), 1), STRIDE) if n else range(0)


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each word, its n-gram buckets (padded) and which of them are real."""
    width = WIDTH + 2
    flat = b"".join((b"^" + w + b"$").ljust(width, b"\0") for w in words)
    m = np.frombuffer(flat, np.uint8).reshape(len(words), width).astype(np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    bucket = np.fromiter((xxhash.xxh32_intdigest(w) % WORD_BUCKETS for w in words), np.int64, len(words))
    longest = int(size.max(initial=max(GRAMS)))
    ids, real = [], []
    for n in GRAMS:
        places = longest - n + 1
        code = np.full((len(words), places), n, np.uint32)
        for j in range(n):
            code = code * np.uint32(0x01000193) ^ m[:, j : j + places]
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        ids.append(((code ^ (code >> np.uint32(13))) % np.uint32(GRAM_BUCKETS)).astype(np.uint16))
        real.append(np.arange(places)[None, :] <= np.maximum(size - n, 0)[:, None])
    return bucket, np.concatenate(ids, 1), np.concatenate(real, 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights of the network (``p``) and of the document's logistic function (``doc``)."""

    p: dict[str, np.ndarray]
    doc: np.ndarray

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """The words' contributions to the gates of both directions, one row a word."""
        out = []
        for i in range(0, len(words), 8192):
            bucket, gram, real = features(words[i : i + 8192])
            mean = (self.p["gram"][gram] * real[:, :, None]).sum(1) / real.sum(1)[:, None]
            out.append(np.concatenate([self.p["word"][bucket], mean], 1) @ self.p["wx"] + self.p["bx"])
        return np.concatenate(out).astype(np.float32) if out else np.empty((0, 6 * HIDDEN), np.float32)

    def windows(self, table: np.ndarray, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probability of each window; ``ids`` are rows of ``table``, ``mask`` marks real words."""
        return sigmoid(_forward(self.p, table[ids], mask)[0])

    def score(self, mean: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Scores of documents from the mean probability of their windows and the windows' number."""
        return sigmoid(_doc_features(mean, count) @ self.doc)


def _doc_features(mean: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The mean and its log odds, and the mean weighted by its reliability: more windows, a sharper boundary."""
    root = np.sqrt(np.maximum(count, 1))
    m = np.clip(mean, 1e-3, 1 - 1e-3)
    return np.stack([np.ones_like(m), m, np.log(m / (1 - m)), root, root * m], 1)


def _forward(p: dict, x: np.ndarray, mask: np.ndarray):
    """Logits of the windows, and what the backward pass needs. x: (batch, time, 2 * 3 * HIDDEN)."""
    n, steps, _ = x.shape
    xd = x.reshape(n, steps, 2, 3 * HIDDEN)
    h = np.zeros((2, n, HIDDEN), x.dtype)
    states = np.empty((steps, 2, n, HIDDEN), x.dtype)
    trace = []
    for t in range(steps):
        xt = np.stack([xd[:, t, 0], xd[:, steps - 1 - t, 1]])
        m = np.stack([mask[:, t], mask[:, steps - 1 - t]])[:, :, None]
        hu = h @ p["u"]
        gates = sigmoid(xt[..., : 2 * HIDDEN] + hu[..., : 2 * HIDDEN])
        z, r = gates[..., :HIDDEN], gates[..., HIDDEN:]
        c = np.tanh(xt[..., 2 * HIDDEN :] + r * hu[..., 2 * HIDDEN :])
        new = h + m * (1 - z) * (c - h)
        trace.append((h, m, z, r, c, hu[..., 2 * HIDDEN :]))
        states[t] = h = new
    both = np.concatenate([states[:, 0].transpose(1, 0, 2), states[::-1, 1].transpose(1, 0, 2)], 2)
    e = np.tanh(both @ p["wa"] + p["ba"])
    a = e @ p["va"] + (mask - 1) * 1e4
    a = np.exp(a - a.max(1, keepdims=True))
    a /= a.sum(1, keepdims=True)
    pooled = (a[:, :, None] * both).sum(1)
    return pooled @ p["wo"] + p["bo"][0], (trace, both, e, a, pooled)


def _backward(p: dict, kept: tuple, d: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the weights and of x, for ``d``, the gradient of the logits."""
    trace, both, e, a, pooled = kept
    steps = len(trace)
    g = {"wo": pooled.T @ d, "bo": np.array([d.sum()], d.dtype)}
    dpool = d[:, None] * p["wo"]
    da = (both * dpool[:, None, :]).sum(2)
    dboth = a[:, :, None] * dpool[:, None, :]
    ds = a * (da - (a * da).sum(1, keepdims=True))
    g["va"] = (e * ds[:, :, None]).sum((0, 1))
    de = ds[:, :, None] * p["va"] * (1 - e * e)
    g["wa"] = both.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, de.shape[2])
    g["ba"] = de.sum((0, 1))
    dboth = dboth + de @ p["wa"].T
    n = len(d)
    dx = np.zeros((n, steps, 2, 3 * HIDDEN), d.dtype)
    du = np.zeros_like(p["u"])
    dh = np.zeros((2, n, HIDDEN), d.dtype)
    ut = p["u"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        h, m, z, r, c, hn = trace[t]
        dh = dh + np.stack([dboth[:, t, :HIDDEN], dboth[:, steps - 1 - t, HIDDEN:]])
        dn = dh * m
        dc = dn * (1 - z) * (1 - c * c)
        dz = -dn * (c - h) * z * (1 - z)
        dr = dc * hn * r * (1 - r)
        dhu = np.concatenate([dz, dr, dc * r], 2)
        dxt = np.concatenate([dz, dr, dc], 2)
        dx[:, t, 0], dx[:, steps - 1 - t, 1] = dxt[0], dxt[1]
        du += h.transpose(0, 2, 1) @ dhu
        dh = dh - dn * (1 - z) + dhu @ ut
    g["u"] = du
    return g, dx.reshape(n, steps, 6 * HIDDEN)


def train(windows: Iterable[tuple[int, int, list[bytes]]], share_toxic: float, seed: int = 6) -> Model:
    """Fit the network on (document, label, words) windows, the classes weighted alike.

    The document's function is then fitted with the classes weighted as in
    the whole labelled table, where ``share_toxic`` of the rows are toxic.
    """
    rng = np.random.default_rng(seed)
    scale = lambda *s: (rng.standard_normal(s) * (1 / np.sqrt(s[-2] if len(s) > 1 else s[0]))).astype(np.float32)
    small = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
    p = {
        "word": small(WORD_BUCKETS, WORD_DIM),
        "gram": small(GRAM_BUCKETS, GRAM_DIM),
        "wx": scale(WORD_DIM + GRAM_DIM, 6 * HIDDEN),
        "bx": np.zeros(6 * HIDDEN, np.float32),
        "u": scale(2, HIDDEN, 3 * HIDDEN),
        "wa": scale(2 * HIDDEN, HIDDEN),
        "ba": np.zeros(HIDDEN, np.float32),
        "va": scale(HIDDEN),
        "wo": scale(2 * HIDDEN),
        "bo": np.zeros(1, np.float32),
    }
    model = Model(p, np.array([-4.0, 8.0, 0.0, 0.0, 0.0]))
    place: dict[bytes, int] = {}
    # the windows' words one after the other: whole texts, so nothing is kept a window but its owner, label and size
    flat, owner, y, size = array("i"), array("q"), array("b"), array("i")
    for d, label, words in windows:
        if words:
            flat.extend(place.setdefault(w, len(place)) for w in words)
            owner.append(d)
            y.append(label)
            size.append(len(words))
    names = sorted(place)
    rank = np.empty(len(names), np.int32)
    rank[[place[w] for w in names]] = np.arange(len(names), dtype=np.int32)
    text = rank[np.frombuffer(flat, np.int32)]
    owner, y, size = np.array(owner, np.int64), np.array(y, np.float32), np.array(size, np.int64)
    start = np.cumsum(size) - size
    digest = np.fromiter((xxhash.xxh64_intdigest(text[s : s + n]) for s, n in zip(start, size)), np.uint64, len(size))
    order = np.lexsort((digest, owner))  # whatever the order of arrival
    owner, y, size, start = owner[order], y[order], size[order], start[order]
    if not len(y) or y.min() == y.max():  # nothing to learn from: every text gets the same low score
        return Model(p, np.array([-6.0, 0.0, 0.0, 0.0, 0.0]))
    bucket = np.empty(len(names), np.int32)
    flat, per_word = [], []  # the words' n-grams one after the other, and their numbers
    for i in range(0, len(names), 8192):
        bucket[i : i + 8192], gram, real = features(names[i : i + 8192])
        flat.append(gram[real])
        per_word.append(real.sum(1))
    gram, per_word = np.concatenate(flat), np.concatenate(per_word)
    begin = np.cumsum(per_word) - per_word
    del place, flat

    def grams_of(used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams of these words one after the other, and where each word's begin."""
        n = per_word[used]
        at = np.cumsum(n) - n
        return gram[np.repeat(begin[used] - at, n) + np.arange(n.sum())], at

    def words_in(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of these windows, padded, and which are real."""
        real = np.arange(WINDOW) < size[rows, None]
        return text[np.where(real, start[rows, None] + np.arange(WINDOW), 0)] * real, real.astype(np.float32)

    for key, buckets, least in (("word", WORD_BUCKETS, LEAST_WORD_DOCS), ("gram", GRAM_BUCKETS, LEAST_GRAM_DOCS)):
        docs = np.zeros(buckets, np.int64)
        for rows in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1):
            ids, real = words_in(rows)
            used = np.unique(ids[real > 0])
            docs[np.unique(bucket[used] if key == "word" else grams_of(used)[0])] += 1
        p[key][docs < least] = 0
    live = {k: (p[k] != 0) for k in ("word", "gram")}
    fold = owner % 4 == 0  # a quarter of the documents fits the document's function
    groups = [np.flatnonzero((y == c) & ~fold) for c in (0, 1)]
    if not all(len(g) for g in groups) or not fold.any():
        fold[:] = False
        groups = [np.flatnonzero(y == c) for c in (0, 1)]
    _, doc, n = np.unique(owner, return_inverse=True, return_counts=True)
    weight = np.minimum(1, SAMPLE_WINDOWS / n)[doc]
    draws = [np.cumsum(weight[g]) / weight[g].sum() for g in groups]
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, STEPS + 1):
        at = [np.minimum(np.searchsorted(c, rng.random(BATCH // 2), "right"), len(c) - 1) for c in draws]
        rows = np.concatenate([g[i] for g, i in zip(groups, at)])
        ids, m = words_in(rows)
        cut = np.where(rng.random(BATCH // 2) < 0.2, rng.integers(1, WINDOW, BATCH // 2), WINDOW)
        m[: BATCH // 2] *= np.arange(WINDOW) < cut[:, None]  # clean texts of any length are clean
        used, where = np.unique(ids, return_inverse=True)
        where = where.reshape(BATCH, WINDOW)
        own, at = grams_of(used)
        share = (1 / per_word[used]).astype(np.float32)[:, None]
        x = np.concatenate([p["word"][bucket[used]], np.add.reduceat(p["gram"][own], at, axis=0) * share], 1)
        table = x @ p["wx"] + p["bx"]
        logit, kept = _forward(p, table[where], m)
        d = ((sigmoid(logit) - y[rows]) / BATCH).astype(np.float32)
        g, dx = _backward(p, kept, d)
        order = np.argsort(where.ravel(), kind="stable")
        first = np.searchsorted(where.ravel()[order], np.arange(len(used)))
        dt = np.add.reduceat(dx.reshape(-1, 6 * HIDDEN)[order], first, axis=0)
        g["wx"], g["bx"] = x.T @ dt, dt.sum(0)
        dwords = dt @ p["wx"].T
        g["word"] = _summed(bucket[used], dwords[:, :WORD_DIM], WORD_BUCKETS)
        g["gram"] = _summed(own, np.repeat(dwords[:, WORD_DIM:] * share, per_word[used], axis=0), GRAM_BUCKETS)
        for k in live:
            g[k] *= live[k]
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        clip = min(1.0, 5.0 / (norm + 1e-9))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, v in p.items():
            gk = g[k].reshape(v.shape) * clip + 1e-5 * v
            mean[k] += 0.1 * (gk - mean[k])
            square[k] += 0.01 * (gk * gk - square[k])
            eps = EMBED_EPS if k in live else 1e-8
            v -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + eps)
    rest = np.flatnonzero(fold if fold.any() else ~fold)
    prob = np.empty(len(rest))
    for i in range(0, len(rest), CHUNK):
        rows = rest[i : i + CHUNK]
        ids, m = words_in(rows)
        used, where = np.unique(ids, return_inverse=True)
        prob[i : i + CHUNK] = model.windows(model.inputs([names[j] for j in used]), where.reshape(-1, WINDOW), m)
    _, doc, n = np.unique(owner[rest], return_inverse=True, return_counts=True)
    label = np.bincount(doc, y[rest]) / n
    weight = np.where(label > 0.5, share_toxic / max(label.mean(), 1e-9), (1 - share_toxic) / max(1 - label.mean(), 1e-9))
    x = _doc_features(np.bincount(doc, prob) / n, n)
    model.doc = _logistic(x, label, weight)
    model.doc[0] += np.log(THRESHOLD / (1 - THRESHOLD)) - _best_cut(x @ model.doc, label > 0.5, weight)
    return model


def _summed(where: np.ndarray, values: np.ndarray, buckets: int) -> np.ndarray:
    """Sums of the rows of ``values`` by bucket."""
    return np.stack([np.bincount(where, c, buckets) for c in values.T], 1).astype(np.float32)


def _best_cut(z: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The log odds above which the weighted F1 of the toxic class is highest."""
    order = np.argsort(-z, kind="stable")
    hit, all_ = np.cumsum((weight * toxic)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (all_ + (weight * toxic).sum())
    f1[:-1][np.diff(z[order]) == 0] = 0  # equal values can't be parted
    i = int(f1.argmax())
    return float((z[order][i] + z[order][min(i + 1, len(z) - 1)]) / 2)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton steps for weighted logistic regression with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        q = sigmoid(x @ w)
        h = (x * (weight * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, x.T @ (weight * (y - q)) - ridge * w), -2, 2)
    return w


def held_out(id_col: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text, modulo 3, is 1 (a null id isn't)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of each labelled text."""
    for batch in batches:
        doc, label, out = [], [], []
        for d, y, raw in zip(*(batch.column(c).to_pylist() for c in ("doc", "label", "text"))):
            words = words_of(raw)
            for s in starts_of(len(words)):
                doc.append(d)
                label.append(y)
                out.append(b" ".join(words[s : s + WINDOW]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(label, pa.int32()), pa.array(out, pa.binary())], ["doc", "label", "words"]
        )


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Train on a bounded sample of the labelled rows that are not held out.

    Rows with a null label or id teach nothing; of several labels of an id
    the largest counts. Without both classes the model scores all texts alike.
    """
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("i").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("i")))
    known = known.groupBy("i").agg(F.max("label").alias("label")).withColumn("o", F.xxhash64("i"))
    sample = None
    for c in (0, 1):
        some = known.where(F.col("label") == c).orderBy("o", "i").limit(SAMPLE_DOCS)
        sample = some if sample is None else sample.unionByName(some)
    share = known.agg(F.avg("label")).first()[0] or 0.0
    # at most 2 * SAMPLE_DOCS rows of ids and labels
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.join(F.broadcast(sample), "i").select(F.col("o").alias("doc"), "label", "text")
    found = rows.mapInArrow(_windows, "doc long, label int, words binary").repartition(1)
    made = found.mapInArrow(_training(float(share)), "model binary").first()
    return train([], share) if made is None else pickle.loads(made.model)


def _training(share: float):
    """Train in one task, whose input the sample bounds; the result is the pickled model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("doc", "label", "words"))))
        model = train(((d, y, w.split()) for d, y, w in rows), share)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return run


class _Scorer:
    """Scores a stream of texts; windows wait until a chunk is full, words' inputs are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {b"": 0}
        self.table = np.zeros((1, 6 * HIDDEN), np.float32)
        self.new: list[bytes] = []

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        waiting: list[tuple[int, np.ndarray]] = []
        size = 0
        for d, raw in enumerate(texts):
            words = words_of(raw)
            known = self.known
            for w in set(words).difference(known):
                known[w] = len(known)
                self.new.append(w)
            ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            n = len(starts_of(len(ids)))
            count[d] = n
            if n:
                waiting.append((d, ids))
                size += n
            if size >= CHUNK:
                self._flush(waiting, total)
                waiting, size = [], 0
                if len(self.known) > CACHE_WORDS:
                    self._forget()
        self._flush(waiting, total)
        if len(self.known) > CACHE_WORDS:
            self._forget()
        return self.model.score(total / np.maximum(count, 1), count)

    def _flush(self, waiting: list[tuple[int, np.ndarray]], total: np.ndarray) -> None:
        if self.new:
            self.table = np.concatenate([self.table, self.model.inputs(self.new)])
            self.new = []
        owner, rows = [], []
        for d, ids in waiting:
            n = len(starts_of(len(ids)))
            owner.append(np.full(n, d))
            padded = np.zeros((n - 1) * STRIDE + WINDOW, np.int64)
            padded[: len(ids)] = ids
            rows.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE])
        for i in range(0, len(rows), CHUNK):
            part, who = np.concatenate(rows[i : i + CHUNK]), np.concatenate(owner[i : i + CHUNK])
            for j in range(0, len(part), CHUNK):
                ids = part[j : j + CHUNK]
                prob = self.model.windows(self.table, ids, (ids > 0).astype(np.float32))
                np.add.at(total, who[j : j + CHUNK], prob)


def _scoring(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model.value)
        for batch in batches:
            scores = scorer(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

    return run


def score(docs: DataFrame, model: Model, carry: list[str], text_col: str = "text") -> DataFrame:
    """One row per input row: ``row`` (a struct of the ``carry`` columns) and ``score`` between 0 and 1.

    Only the text is an input of the score. Null and empty texts have no
    windows and score as a document without any toxic window. The model is
    broadcast; its size is fixed by the constants above.
    """
    rows = docs.select(F.struct(*carry).alias("row"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_scoring(docs.sparkSession.sparkContext.broadcast(model)), schema)
