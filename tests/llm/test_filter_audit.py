"""The filter audit against filters applied one after the other to the documents themselves."""

import itertools
import random
import re
from collections import Counter, defaultdict

from claimflow.llm import filter_audit as A


def masks(docs):
    """The failed letters of each (doc_id, text, part)."""
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    out = []
    for i, t, _ in docs:
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        f = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w))
        f += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        out.append(f + "E" * (t in smallest and i != smallest[t]))
    return out


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for (i, _, part), f in zip(docs, masks(docs)):
        parts[part or ""].append((i, f))
    rows = []
    for part, members in parts.items():
        per, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, x in enumerate(order, 1):
                gone, left = [m for m in left if x in m[1]], [m for m in left if x not in m[1]]
                shapley[x] += len(gone)
                failing = sum(x in f for _, f in members)
                alone = sum(f == x for _, f in members)
                per.append((x, (part, "".join(order), step, len(left), len(gone), failing - len(gone), alone,
                                sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))))
        rows += [(*r, shapley[x]) for x, r in per]
    return sorted(rows)


def run(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(tuple(r) for r in A.filter_audit(d, lab).collect())


def test_plain_changes_meet_all_orders_once():
    for n in range(6):
        order = list(range(n))
        seen = {tuple(order)}
        for level in A.plain_changes(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert seen == set(itertools.permutations(range(n)))


def test_swapped_diagrams_equal_diagrams_built_in_that_order():
    rng = random.Random(2)
    for n in (1, 2, 3, 4, 5):
        counts = {m: (rng.choice([0, 1, 1, 7]), rng.randint(0, 2)) for m in range(1 << n) if rng.random() < 0.6}
        d = A.Diagram(counts, n)
        for level in [*A.plain_changes(n), *(rng.randrange(n - 1) for _ in range(30 if n > 1 else 0))]:
            d.swap(level)
            again = {sum((m >> v & 1) << i for i, v in enumerate(d.order)): w for m, w in counts.items()}
            fresh = A.Diagram(again, n)
            assert [(k, r) for _, k, r in d.steps()] == [(k, r) for _, k, r in fresh.steps()]
            assert [len(x) for x in d.levels] == [len(x) for x in fresh.levels]  # as much shared as in a new one


def text(rng):
    w = rng.choices(["river", "Of", "AB", "x1", "$5", "dog", "é"] + [f"w{i}" for i in range(200)], k=rng.choice([0, 5, 99, 100, 130]))
    return rng.choice([" ", "\n", "\t  "]).join(w)


def test_audit_equals_filters_applied_in_turn(spark):
    rng = random.Random(4)
    texts = [text(rng) for _ in range(25)] + [None, "", " "]
    docs = [(rng.randint(0, 60), rng.choice(texts), rng.choice(["en", "fr", "", None])) for _ in range(300)]
    docs += [(1000 + i, texts[0], "en") for i in range(150)] + [(None, texts[1], "fr"), (None, "only here", "fr"), (None, "only here", "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(50)] + [(3, 1, 1), (None, 1, 1)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_ties_of_the_smallest_id_pass(spark):
    docs = [(1, "same text", "en"), (1, "same text", "en"), (2, "same text", "en"), (None, "same text", "en")]
    got = {(r[1], r[2]): r for r in run(spark, docs, [])}
    assert got["EABCD", 1][3:5] == (2, 2)
    assert got["ABCDE", 1][3:5] == (0, 4) and got["ABCDE", 5][3:6] == (0, 0, 2)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, [], [(1, 1, 1)]) == []
    rows = [(1, "a b", "en", 5, 1, 1, "x"), (2, "a b", "en", 6, 0, 0, "y")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, mask int, quality int, toxic int, part string")
    lab = spark.createDataFrame([(1, 1, 0, "z")], "doc_id long, quality int, toxic int, lang string")
    got = sorted(tuple(r) for r in A.filter_audit(d, lab).collect())
    assert got == brute([(1, "a b", "en"), (2, "a b", "en")], [(1, 1, 0)])
