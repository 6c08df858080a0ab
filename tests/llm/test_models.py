"""Toxicity, mixing and the pipeline: held-out accuracy, brute force, and the stages' effects."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from pyspark.sql import functions as F

import corpus_pipeline
from claimflow.llm import minhash, mixing, toxicity
from claimflow.llm.common import table


def make_texts(n, seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.3
        w = rng.choices(vocab, k=rng.choice([8, 40, 150, 400]))
        if toxic:
            for _ in range(max(2, len(w) // 30)):
                w[rng.randrange(len(w))] = rng.choice(["Zorkish", "zorkan!", "ZORKELL", "vile"])
        rows.append((i, " ".join(w), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = [r for r in make_texts(900) if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    windows = []
    for i, t, y in rows:
        w = toxicity.words_of(t.encode())
        windows += [(i, y, w[s : s + toxicity.WINDOW]) for s in toxicity.starts_of(len(w))][: toxicity.SAMPLE_WINDOWS]
    return toxicity.train(windows, 0.3)


def test_held_out_accuracy_and_whole_texts(model):
    scorer = toxicity._Scorer(model)
    rows = [r for r in make_texts(900) if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    got = scorer([t.encode() for _, t, _ in rows]) >= toxicity.THRESHOLD
    assert (got == np.array([y == 1 for _, _, y in rows])).mean() > 0.93
    clean = " ".join(["abc", "def", "gah"] * 3000)
    late = clean + " zorkish vile zorkan" * 300
    scores = scorer([clean.encode(), late.encode(), None, b"", b"  "])
    assert scores[0] < 0.5 and scores[1] > scores[0] and np.isfinite(scores).all() and ((scores >= 0) & (scores <= 1)).all()


def test_windows_overlap_and_cover():
    for n in [0, 1, 15, 16, 17, 63, 64, 65, 112, 113, 500]:
        starts = list(toxicity.starts_of(n))
        assert {i for s in starts for i in range(s, min(s + toxicity.WINDOW, n))} == set(range(n))
        assert all(b - a == toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_long_runs_are_read_whole():
    rng = random.Random(4)
    for text in ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n)) for n in (13, 14, 25, 300)] + ["x" * 40, "ab—cd\u00a0ef，" * 30]:
        raw = text.encode()
        words = toxicity.words_of(raw)
        assert max(map(len, words)) <= toxicity.WIDTH
        for n in (1, *toxicity.GRAMS):
            assert {raw[i : i + n] for i in range(len(raw) - n + 1)} == {w[i : i + n] for w in words for i in range(len(w) - n + 1)}
        toxicity.features(words)
    long = "漢字仮名交文" * 400
    assert len(toxicity.starts_of(len(toxicity.words_of(long.encode())))) > 1


def test_training_and_threshold_read_whole_texts(monkeypatch):
    rows = make_texts(60, 8) + [(1000 + i, " ".join(["abc", "def", "gah", "zorkish" if i % 2 else "beh"] * 700), i % 2) for i in range(12)]
    columns = [pa.array(c, kind) for c, kind in zip(zip(*[(i, y, t.encode()) for i, t, y in rows]), (pa.int64(), pa.int32(), pa.binary()))]
    batch = pa.RecordBatch.from_arrays(columns, ["doc", "label", "text"])
    found = [r for b in toxicity._windows([batch]) for r in zip(*(b.column(c).to_pylist() for c in ("doc", "label", "words")))]
    sizes = {i: len(toxicity.starts_of(len(toxicity.words_of(t.encode())))) for i, t, _ in rows}
    assert {i: sum(d == i for d, _, _ in found) for i in sizes} == sizes and max(sizes.values()) > 50
    seen, plain = [], toxicity._doc_features
    monkeypatch.setattr(toxicity, "STEPS", 2)
    monkeypatch.setattr(toxicity, "_doc_features", lambda mean, count: seen.append(sorted(count)) or plain(mean, count))
    windows = [(d, y, w.split()) for d, y, w in found]
    fitted = toxicity.train(windows, 0.3)
    assert seen[0] == sorted(n for i, n in sizes.items() if i % 4 == 0)
    again = toxicity.train(windows[::-1], 0.3)  # in any order of arrival
    assert all(np.array_equal(v, again.p[k]) for k, v in fitted.p.items()) and np.array_equal(fitted.doc, again.doc)


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    h = toxicity.HIDDEN
    p = {
        "u": rng.standard_normal((2, h, 3 * h)) * 0.3, "wa": rng.standard_normal((2 * h, h)) * 0.3, "ba": rng.standard_normal(h),
        "va": rng.standard_normal(h), "wo": rng.standard_normal(2 * h), "bo": rng.standard_normal(1),
    }
    x = rng.standard_normal((3, 7, 6 * h)) * 0.5
    mask = np.ones((3, 7))
    mask[1, 4:] = 0
    d = rng.standard_normal(3)
    loss = lambda: float(toxicity._forward(p, x, mask)[0] @ d)
    g, dx = toxicity._backward(p, toxicity._forward(p, x, mask)[1], d)
    for name, v, gv in [*((k, p[k], g[k]) for k in p), ("x", x, dx)]:
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in v.shape)
            old, e = v[at], 1e-6
            v[at] = old + e
            up = loss()
            v[at] = old - e
            assert abs((up - loss()) / (2 * e) - gv[at]) < 1e-6, name
            v[at] = old


def plain_window(p, x, real):
    """Log odds of one window, word by word: two gated recurrences, then attention over their states."""
    size = toxicity.HIDDEN
    squash = lambda v: 1 / (1 + np.exp(-v))

    def read(d, order):
        h, states = np.zeros(size), {}
        for t in order:
            if real[t]:
                own, past = x[t, d * 3 * size : (d + 1) * 3 * size], h @ p["u"][d]
                keep = squash(own[:size] + past[:size])
                reset = squash(own[size : 2 * size] + past[size : 2 * size])
                h = keep * h + (1 - keep) * np.tanh(own[2 * size :] + reset * past[2 * size :])
            states[t] = h
        return states

    forth, back = read(0, range(len(x))), read(1, reversed(range(len(x))))
    states = [np.concatenate([forth[t], back[t]]) for t in range(len(x)) if real[t]]
    weight = np.exp([np.tanh(s @ p["wa"] + p["ba"]) @ p["va"] for s in states])
    return sum(w * s for w, s in zip(weight / weight.sum(), states)) @ p["wo"] + p["bo"][0]


def test_windows_equal_a_plain_loop_over_gates_and_attention(model):
    words = sorted({w for _, t, _ in make_texts(60, seed=8) for w in toxicity.words_of(t.encode())})
    inputs = model.inputs(words)
    rng = np.random.default_rng(3)
    ids = rng.integers(0, len(words), (40, toxicity.WINDOW))
    real = (np.arange(toxicity.WINDOW) < rng.integers(1, toxicity.WINDOW + 1, 40)[:, None]).astype(np.float32)
    got = model.windows(inputs, ids, real)
    want = [1 / (1 + np.exp(-plain_window(model.p, inputs[i].astype(float), m))) for i, m in zip(ids, real)]
    assert np.abs(got - want).max() < 1e-4 and np.ptp(got) > 0.1


def test_a_null_id_is_not_held_out(spark):
    ids = spark.createDataFrame([(None,), (1,), (2,), (3,)], "i long")
    got = {r.i: r.h for r in ids.select("i", toxicity.held_out(F.col("i")).alias("h")).collect()}
    assert got == {None: False} | {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in (1, 2, 3)}


def test_the_shard_stage_keeps_every_column(spark):
    rows = [(i % 7, f"text {i % 3}", i, 5, 6, "s") for i in range(40)] + [(None, None, 99, 5, 6, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _b long, shard int, h1 int, slot string")
    out = corpus_pipeline.shard(spark, docs, SF001)
    assert out.columns == ["doc_id", "text", "_b", "shard_in", "h1", "slot_in", "shard", "slot"]
    got = out.collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(rows, key=str)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_scores_need_only_the_text_and_chunks_do_not_matter(spark, model, monkeypatch):
    rows = make_texts(120, 5) + [(900, None, 0), (901, "", 0), (902, "zorkish " * 9000, 1)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string").repartition(4)
    got = {r.row.doc_id: r["score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 50)
    alone = toxicity._Scorer(model)([None if t is None else t.encode() for _, t, _ in rows])
    assert np.allclose([got[i] for i, _, _ in rows], alone, atol=1e-5)


def test_fit_without_labels_or_with_one_class(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 0), (3, None)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        m = toxicity.fit(docs, known)
        assert all(r["score"] < 0.1 for r in toxicity.score(docs, m, ["doc_id"]).collect())
    assert toxicity.score(docs.limit(0), m, ["doc_id"]).count() == 0


# -- mixing ---------------------------------------------------------------------------------------


def brute_rates(n, p, target, steps=4000):
    """Plain projected gradient in the same metric, without preconditioning."""
    r = np.ones(len(n))
    g = (p * n[:, None]).T @ p
    step = 1 / np.linalg.eigvalsh(g).max()
    for _ in range(steps):
        r = np.maximum(0, r - step * (p @ ((n * r) @ p - target)))
    return r


def test_rates_meet_targets_and_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 500, 400).astype(float)
    known = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens long, p array<double>")
    for weights in ([0.2, 0.5, 0.3], [0.8, 0.15, 0.05], [0.0, 0.0, 1.0]):
        steps = mixing.fit_rates(known, weights)
        rates = np.array([r.r for r in known.select(mixing.rate_of(steps, 3).alias("r")).collect()])
        target = np.array(weights) * n.sum()
        inverse = np.linalg.inv((p * n[:, None]).T @ p)

        def squares(r, inverse=inverse, target=target):
            off = (n * r) @ p - target
            return off @ inverse @ off / n.sum()

        assert rates.min() >= 0
        assert squares(rates) <= squares(brute_rates(n, p, target)) + 3e-3  # targets out of reach are approached slowly
        if weights[0]:  # within reach
            assert np.abs((n * rates) @ p - target).sum() / n.sum() < 1e-3
    weights = [0.3, 0.4, 0.3]
    rates = np.array([r.r for r in known.select(mixing.rate_of(mixing.fit_rates(known, weights), 3).alias("r")).collect()])
    assert np.allclose(rates, brute_rates(n, p, np.array(weights) * n.sum()), atol=0.02)


def test_mix_of_a_table(spark):
    rng = random.Random(3)
    kinds = {"good": ["clear", "prose", "reads", "well"], "bad": ["###", "|", "junk", "spam"]}
    rows = [(i, (k := rng.choice(list(kinds))), " ".join(rng.choices(kinds[k], k=rng.randint(5, 60)))) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "c") for i, _, t in rows] + [(900, None, "c"), (901, "", "c")], "doc_id long, text string, rate string")
    labelled = spark.createDataFrame([(i, k) for i, k, _ in rows if i % 2] + [(0, None), (5000, "good")], "doc_id long, domain string")
    got = mixing.mix(docs, labelled, {"good": 0.8, "bad": 0.2}, ["doc_id"]).collect()
    assert len(got) == 302 and {r.n_tokens for r in got if r.row.doc_id >= 900} == {0}
    by = {r.row.doc_id: r for r in got}
    assert sum((by[i].p[0] > 0.5) == (k == "good") for i, k, _ in rows) > 290
    total = sum(r.n_tokens for r in got)
    good = sum(r.rate * r.n_tokens * r.p[0] for r in got)
    assert abs(good / total - 0.8) < 1e-3 and abs(sum(r.rate * r.n_tokens for r in got) / total - 1) < 1e-3
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    out = mixing.mixed(docs, labelled, {"good": 0.8, "bad": 0.2})
    assert out.columns == docs.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {i: r.copies for i, r in by.items() if r.copies}
    assert mixing.mix(docs.limit(0), labelled, {"good": 0.8, "bad": 0.2}, ["doc_id"]).count() == 0


def test_shares_are_those_of_the_documents_at_hand(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "good words" if i % 4 else "bad junk") for i in range(40)], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "good" if i % 4 else "bad") for i in range(40)] + [(i, "bad") for i in range(100, 400)], "doc_id long, domain string")
    seen = []
    monkeypatch.setattr(mixing, "train", lambda rows, domains, prior: seen.append((len(rows), prior)))
    mixing.fit(docs, labelled, ["good", "bad"])
    assert seen == [(40, {"good": 0.75, "bad": 0.25})]


# -- the pipeline ---------------------------------------------------------------------------------


def test_mixing_stage_meets_targets_of_the_domains_left(spark, monkeypatch):
    asked, plain = [], mixing.mix

    def mix(docs, labelled, targets, *rest):
        found = corpus_pipeline.stored(plain(docs, labelled, targets, *rest), "mix")
        asked.append((targets, found))
        return found

    monkeypatch.setattr(mixing, "mix", mix)
    labels = table(spark, SF001, "labels")
    toxic = [r.doc_id for r in labels.where("toxic = 1").select("doc_id").collect()]
    missed = toxic[0]  # the stage before has missed one
    docs = table(spark, SF001, "documents").where(~F.col("doc_id").isin(toxic[1:]))
    out = corpus_pipeline.mix_domains(spark, docs, SF001)
    (targets, found), = asked
    assert set(targets) == {"high", "low"} and missed in toxic
    rows = found.select("n_tokens", "p", "rate", "copies").collect()
    total = sum(r.n_tokens for r in rows)
    for i, d in enumerate(targets):
        want = targets[d] / sum(targets.values())
        assert abs(sum(r.rate * r.n_tokens * r.p[i] for r in rows) / total - want) < 1e-2
    assert out.count() == sum(r.copies for r in rows) > 0


def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SF001, "documents")
    seen = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = seen[name] = corpus_pipeline.stored(stage(spark, docs, SF001), name)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    before = None
    for name, df in seen.items():
        if name != "sharding":
            assert df.columns == seen["documents"].columns
        ids = {r.doc_id for r in df.select("doc_id").collect()}
        assert before is None or ids <= before
        before = ids
    kept = {r.doc_id for r in seen["near_duplicates"].select("doc_id").collect()}
    groups = minhash.near_duplicates(seen["toxicity"], size=5).collect()
    assert kept == {r.id for r in groups if r.id == r.component_id}
    from claimflow.llm import decontaminate

    bench = table(spark, SF001, "benchmark")
    dirty = {r.doc_id for r in decontaminate.scan(seen["near_duplicates"], bench, ["doc_id"]).where("n_hit > 0").select("row.doc_id").collect()}
    assert {r.doc_id for r in seen["decontamination"].select("doc_id").collect()} == kept - dirty and dirty
    final = seen["sharding"].groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert all(r.n == r.d == r.m + 1 and 0 <= r.shard < corpus_pipeline.SHARDS for r in final)
    assert sum(r.n for r in final) == seen["mixing"].count()


def test_pipeline_of_no_documents(spark):
    docs = table(spark, SF001, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF001), "none")
    assert docs.count() == 0 and {"shard", "slot"} <= set(docs.columns)
