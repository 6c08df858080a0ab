"""Importance resampling against zlib and a plain loop over texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from claimflow.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def features(text, longest):
    w = WORD.findall(fold(text))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=10, least_words=20, longest=1, buckets=10_000, seed=2024):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    cut = [(i, *features(t, longest)) for i, t in docs]
    s = Counter(bucket(f) for *_, fs in cut for f in fs)
    t = Counter(bucket(f) for x in target for f in features(x, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for i, n, fs in cut:
        w = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = k
    return sorted(map(tuple, rows), key=str)


def run(spark, docs, target, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([(x,) for x in target], "text string")
    return sorted((tuple(r) for r in R.resample(d, t, **kw).collect()), key=str)


def test_crc_matrices_equal_zlib():
    rng = random.Random(3)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 3, 7, 7, 7, 30, 400]))) for _ in range(3000)]
    words += [b"", b"a", b"\xff" * 5000]
    assert R.crc32_all(words).tolist() == [zlib.crc32(w) for w in words]
    assert R.crc32_all([]).tolist() == []


def test_words_are_those_of_the_pattern():
    text = "Ab-C9 x_y éÀ 漢字 z\x7fq\x00r{s}|t:u@v[w`"
    assert [w.decode() for w in R.words_of(text.encode())] == WORD.findall(fold(text))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    vocabulary = [f"{w}{i}" for i in range(60) for w in ("Ka", "lo", "Übe")] + ["the", "of", "x" * 300]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(300)]
    docs += [(500 + i, docs[3][1]) for i in range(100)]  # a group of copies
    docs += [(900, None), (901, ""), (902, " \n#"), (903, "word " * 40_000)]
    target = [" ".join(rng.choices(vocabulary[:30], k=20)) for _ in range(10)] + [None, ""]
    return docs, target


@pytest.mark.parametrize("kw", [{}, {"percent": 50, "least_words": 0, "longest": 3}, {"buckets": 100_000, "seed": 5}, {"percent": 100}, {"percent": 0}])
def test_draws_equal_brute_force(spark, corpus, kw):
    docs, target = corpus
    assert run(spark, docs, target, **kw) == brute(docs, target, **kw)


def test_slices_do_not_change_the_result(spark, corpus, monkeypatch):
    docs, target = corpus
    hashed = R._hashing(2, 1000, np.uint16)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([(t or "").encode() for _, t in docs], pa.binary())], ["id", "text"])
    whole = pa.Table.from_batches(hashed([batch])).to_pylist()
    monkeypatch.setattr(R, "SLICE_BYTES", 100)
    assert pa.Table.from_batches(hashed([batch])).to_pylist() == whole


def test_ties_repeated_rows_and_null_ids(spark):
    text = "the river of stones " * 10
    docs = [(7, text)] * 30 + [(None, text)] * 5 + [(i, text) for i in range(65)]
    got = run(spark, docs, [text], percent=50)
    assert got == brute(docs, [text], percent=50)
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 51))


def test_empty_tables_and_other_columns(spark):
    assert run(spark, [], ["a b c"]) == []
    docs = [(i, "some words of it " * 10) for i in range(20)]
    assert run(spark, docs, []) == brute(docs, [])
    d = spark.createDataFrame([(i, t, 1, 2, 3.0, 9) for i, t in docs], "doc_id long, text string, id int, rid int, score double, rank int")
    got = R.resample(d, spark.createDataFrame([("a",)], "text string"))
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, ["a"])
