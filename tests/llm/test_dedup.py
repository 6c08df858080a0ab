"""Exact dedup, MinHash near-dedup, components and line dedup against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from claimflow.llm import components, exact_dedup, lines, minhash

DOCS = "doc_id long, text string, digest string, kept int, bucket long, row string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in rows], DOCS).repartition(5)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def exact_rows():
    rng = random.Random(1)
    words = ["a", "b  b", "c\tc", "d\n\nd", "é", "x" * 5000]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 3)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, None), (7, "twin"), (7, "twin"), (None, "twin"), (None, "only")] + [(1000 + i, "hot text") for i in range(300)]


def expected_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        g = groups[norm(t)]
        ids = [x for x in g if x is not None]
        out.append((i, min(ids) if ids else None, len(g), i == (min(ids) if ids else None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda c: F.lit("same")])
def test_exact_dedup_equals_brute_force_even_with_a_useless_digest(spark, digest):
    rows = exact_rows()
    got = exact_dedup.exact_dedup(frame(spark, rows), salts=3, digest=digest).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got], key=str) == expected_exact(rows)


def test_exact_dedup_empty_and_digest(spark):
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0
    r = exact_dedup.exact_dedup(frame(spark, [(1, "a \t b")])).first()
    assert r.digest == hashlib.sha256(b"a b").hexdigest()


def shingles(text, size):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def expected_near(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                top[find(a)] = find(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[find(x)] = min(least.get(find(x), i), i)
    return sorted((i, len(sets[x]), least[find(x)] if sets[x] else i) for x, (i, _) in enumerate(rows))


def near_rows():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choices(vocab, k=rng.randint(30, 120)) for _ in range(6)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i * 3, " ".join(w)))
    rows += [(1000 + i, " ".join(rng.choices(vocab, k=40))) for i in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "One"), (2004, "one"), (2005, "one two"), (2006, "x " * 30000)]
    return rows + [(3, rows[1][1]), (3, rows[1][1])]


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    rows = near_rows()
    got = minhash.near_duplicates(frame(spark, rows), size=size).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == expected_near(rows, size)


def test_near_dedup_keeps_one_of_each_group(spark):
    rows = near_rows()
    kept = minhash.near_dedup(frame(spark, rows)).collect()
    want = sorted({i for i, n, c in expected_near(rows, 5) if i == c})
    assert sorted(r.doc_id for r in kept) == want
    assert set(kept[0].asDict()) == {"doc_id", "text", "digest", "kept", "bucket", "row"}
    assert minhash.near_dedup(frame(spark, [])).count() == 0


def test_estimate_is_close_and_unbiased():
    import numpy as np

    rng = np.random.default_rng(3)
    for j in (0.5, 0.8, 0.95):
        n = 2000
        same = int(2 * n * j / (1 + j))
        x = rng.integers(0, 2**63, 2 * n - same, dtype=np.uint64)
        a, b = x[:n], np.concatenate([x[:same], x[n:]])
        pa, pb = (minhash.packed(minhash.minima(s, minhash.HASHES)).view(np.uint64) for s in (a, b))
        d = pa ^ pb
        lanes = (d | (d >> np.uint64(1))) & np.uint64(0x5555555555555555)
        agree = 1 - sum(int(v).bit_count() for v in lanes) / minhash.HASHES
        assert abs((agree - 0.25) / 0.75 - j) < 0.08


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 300), (7, 3), (7, 3)]
    links += [(rng.randint(400, 440), rng.randint(400, 440)) for _ in range(25)]
    rng.shuffle(links)
    got = {r.node: r.comp for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    top = {x: x for e in links for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(top[a], top[b])
            changed |= top[a] != m or top[b] != m
            top[a] = top[b] = m
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: top[x] for x in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def expected_lines(rows, least=lines.LEAST_CHARS):
    place, first = [], {}
    for i, t in sorted(((i, t) for i, t in rows if t is not None), key=lambda r: r[0]):
        for k, raw in enumerate(t.split("\n")):
            s = raw.strip(" \t\r\x0b\x0c")
            if s:
                place.append((i, k, s))
                first.setdefault(s, (i, k))
    long = [s for s in first if len(s) >= least]
    near = {s for s in long if any(first[u] < first[s] and one_edit(s, u) for u in long)}
    out = {i: (0 if t is None else len(t.split("\n")), [], []) for i, t in rows}
    for i, k, s in place:
        if s in near:
            out[i][2].append(k)
        elif (i, k) != first[s]:
            out[i][1].append(k)
    return {i: (n, len(e), len(x), sorted(e + x)) for i, (n, e, x) in out.items()}


def line_rows():
    rng = random.Random(5)
    pool = ["".join(rng.choices("abé", k=rng.randint(8, 40))) for _ in range(30)] + ["aaaaaaaaaaaa", "z" * 3000, "z" * 1500 + "y" + "z" * 1500]

    def edit(s):
        p = rng.randrange(len(s) + 1)
        return rng.choice([s, s[:p] + "b" + s[p:], s[:p] + s[p + 1 :], s[:p] + "c" + s[p + 1 :], s])

    rows = [(i, "\n".join(rng.choice(["", "  ", "\t"]) + edit(rng.choice(pool)) for _ in range(rng.randint(0, 8)))) for i in range(80)]
    rows += [(150 + i, rng.choice(["menu\nhome", "home", "menu \n\n}", "hone"])) for i in range(20)]  # short lines repeat, none is near
    rows += [(200 + i, f"item number {i:03d} of the list") for i in range(120)]  # a large group sharing variants
    return rows + [(900, None), (901, ""), (902, "\n\n"), (903, "x" * 20000), (904, "x" * 20001)]


def test_line_dedup_equals_brute_force(spark):
    rows = line_rows()
    got = {r.id: (r.n_lines, r.n_exact, r.n_near, r.dropped) for r in lines.line_dedup(frame(spark, rows)).collect()}
    assert got == expected_lines(rows)
    assert sum(x[2] for x in got.values()) > 100


def test_line_dedup_text_and_empty_table(spark):
    docs = frame(spark, [(1, "the same long line\nshort"), (2, "another line here\nthe same long lime"), (3, None)])
    out = {r.doc_id: r.text for r in lines.without_lines(docs, lines.line_dedup(docs)).collect()}
    assert out == {1: "the same long line\nshort", 2: "another line here", 3: None}
    # repeated rows share their decisions, a null id comes first
    docs = frame(spark, [(None, "a line of some length"), (4, "a line of some length\nown line of it"), (4, "a line of some length\nown line of it"), (5, "own line of if")])
    got = sorted(((r.id, r.n_exact, r.n_near, r.dropped) for r in lines.line_dedup(docs).collect()), key=str)
    assert got == [(4, 1, 0, [0]), (4, 1, 0, [0]), (5, 0, 1, [0]), (None, 0, 0, [])]
    assert lines.line_dedup(frame(spark, [])).count() == 0
