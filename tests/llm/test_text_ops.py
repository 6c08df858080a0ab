"""Token counts, decontamination, sharding, WARC and secrets against brute force and round trips."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib

import duckdb
import pyarrow.fs
import numpy as np
import pytest
from pyspark.sql import functions as F

from claimflow.llm import decontaminate, queries, secrets, sharding, tokens, warc

# -- token counts ---------------------------------------------------------------------------------


def viterbi(word, pieces, unknown):
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        found = []
        for start in range(end):
            s, n = best[start]
            if word[start:end] in pieces:
                found.append((-(s + pieces[word[start:end]]), n + 1))
            elif end - start == 1:
                found.append((-(s + unknown), n + len(word[start].encode())))
        score, n = min(found)
        best[end] = (-score, n)
    return best[-1][1]


def test_trie_counts_equal_plain_dynamic_programming():
    rng = random.Random(1)
    pieces = {c: -10.0 - i for i, c in enumerate("▁abc")} | {"ab": -8.0, "▁a": -3.0, "abc": -12.5, "bca": -9.0, "▁ab": -11.0, "cc": -15.0}
    counter = tokens.TrieCounter(pieces)
    texts = [" ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(rng.randint(0, 20))) for _ in range(200)]
    for t in [*texts, "", " \n ", "a" * 3000 + " é" * 3]:
        want = sum(viterbi("▁" + w, pieces, counter.unknown) for w in t.split())
        assert counter.count(t.encode()) == (len(t.split()), want)


def test_a_trie_that_is_dropped_counts_alike(monkeypatch):
    pieces = {"▁": -1.0, "a": -2.0, "ab": -2.5, "b": -2.0}
    texts = [f"{'ab' * i} b{'a' * i}".encode() for i in range(50)]
    whole = tokens.TrieCounter(pieces)
    want = [whole.count(t) for t in texts]
    monkeypatch.setattr(tokens, "TRIE_NODES", 10)
    small = tokens.TrieCounter(pieces)
    assert [small.count(t) for t in texts] == want


def test_token_counts_of_a_table(spark):
    docs = spark.createDataFrame([(1, "Hello world", 5), (2, None, 5), (3, "", 5), (1, "Hello world", 5)], "doc_id long, text string, n_tokens int")
    got = tokens.token_counts(docs, ["doc_id"]).select("row.doc_id", "n_pretokens", "n_tokens").collect()
    pieces = tokens.load_pieces(tokens.VOCABULARY)
    assert len(pieces) > 30000
    n = sum(viterbi("▁" + w, pieces, min(pieces.values()) - tokens.UNKNOWN_PENALTY) for w in ("Hello", "world"))
    assert sorted(map(tuple, got)) == [(1, 2, n), (1, 2, n), (2, 0, 0), (3, 0, 0)]
    assert tokens.token_counts(docs.limit(0), ["doc_id"]).count() == 0


def test_bytes_that_are_no_utf8_are_counted(spark):
    docs = spark.createDataFrame([(1, bytearray(b"ok \xff\xfe bad\xc3"))], "doc_id long, text binary")
    pieces = {"▁": -1.0, "ok": -2.0, "bad": -2.0, "\ufffd": -9.0}
    r = tokens.token_counts(docs, ["doc_id"], scores=pieces).first()
    assert (r.n_pretokens, r.n_tokens) == (3, 2 + 3 + 3)


def test_suffix_links_find_all_pieces_that_end():
    rng = random.Random(2)
    for _ in range(40):
        pieces = {"".join(rng.choices("ab", k=rng.randint(1, 6))): -float(i) for i in range(rng.randint(0, 12))}
        links = tokens.PieceSuffixes(pieces)
        word, state = "".join(rng.choices("abc", k=60)), 0
        for end, ch in enumerate(word, 1):
            state = links.step(state, ch)
            want = {(len(p), s) for p, s in pieces.items() if word[:end].endswith(p)}
            assert set(links.ends[state]) == want


def test_unigram_scores_are_log_probabilities_of_the_corpus(spark, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(tokens, "HELD_WORDS", 3)
    texts = ["the government gives information about the world", "information on world government\nand zxqv 漢", None, "", "the information"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    scores = tokens.unigram_pieces(docs)
    assert len(scores) > 30000 and abs(sum(np.exp(list(scores.values()))) - 1) < 1e-9
    assert scores["▁the"] == scores["▁information"] > scores["▁about"] > scores["▁never"]
    got = {r.row.doc_id: r.n_tokens for r in tokens.token_counts(docs, ["doc_id"], scores=scores).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.VOCABULARY)
    assert got[4] == 2 and got[0] == 7  # every word a piece: one token each
    for i, t in enumerate(texts):
        own = sum(len(sp.encode(w)) for w in (t or "").split())
        assert abs(got[i] - own) <= 1


# -- decontamination ------------------------------------------------------------------------------


def brute_hits(words, items, window):
    hit, found = set(), set()
    for item, iw in items:
        if not iw:
            continue
        m = min(window, len(iw))
        grams = {tuple(iw[i : i + m]) for i in range(len(iw) - m + 1)}
        for i in range(len(words) - m + 1):
            if tuple(words[i : i + m]) in grams:
                hit |= set(range(i, i + m))
                found.add(item)
    return hit, found


def random_case(seed, window):
    rng = random.Random(seed)
    vocab = [b"w%d" % i for i in range(4)]
    items = [(str(i), rng.choices(vocab, k=rng.randint(0, 3 * window))) for i in range(8)]
    docs = []
    for _ in range(30):
        w = rng.choices([*vocab, b"other"], k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            it = rng.choice(items)[1]
            p = rng.randint(0, len(w))
            w[p:p] = it
        docs.append(w)
    return items, docs


@pytest.mark.parametrize("window", [3, 5, 10])
def test_automaton_equals_brute_force(window):
    for seed in range(25):
        items, docs = random_case(seed, window)
        sam = decontaminate.SuffixAutomaton(items, window)
        for w in docs:
            hits, found = sam.stream(w)
            marked = {i for a, b in hits for i in range(a, b)}
            assert (marked, found) == brute_hits(w, items, window)
            assert all(a[1] < b[0] for a, b in zip(hits, hits[1:]))


def test_scan_in_one_and_many_blocks(spark):
    items, docs = random_case(99, 4)
    text = [b" ".join(w).decode() for w in docs]
    table = spark.createDataFrame([(i, t, "c") for i, t in enumerate(text)] + [(1000, None, "c"), (1001, "", "c"), (1002, "É,È! W0", "c")], "doc_id long, text string, hits string")
    bench = spark.createDataFrame([(int(i), b" ".join(w).decode().upper()) for i, w in items] + [(77, None)], "item_id long, text string")
    one = decontaminate.scan(table, bench, table.columns, window=4)
    many = decontaminate.scan(table, bench, table.columns, window=4, block_words=10)
    pick = lambda df: {r.row.doc_id: (r.n_words, r.n_hit, sorted(map(tuple, r.hits)), sorted(r["items"])) for r in df.collect()}
    got = pick(one)
    assert got == pick(many)
    for i, w in enumerate(docs):
        hit, found = brute_hits(w, items, 4)
        assert (got[i][1], got[i][3]) == (len(hit), sorted(found))
    assert got[1000][:2] == got[1001][:2] == (0, 0) and got[1002][0] == 3
    assert decontaminate.scan(table, bench.limit(0), ["doc_id"]).where("n_hit > 0").count() == 0


def test_items_without_an_id_are_hit_and_repeated_rows_scanned_each(spark):
    docs = spark.createDataFrame([(1, "x a b c d y"), (1, "x a b c d y"), (None, "a b c d"), (2, "e f g h")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "a b c d"), (5, "b c d y"), (5, "b c d y"), (6, None)], "item_id long, text string")
    for words in (1000, 4):
        found = decontaminate.scan(docs, bench, ["doc_id"], window=3, block_words=words)
        got = sorted(((r.row.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=str)
        assert got == [(1, 6, 5, ["5"]), (1, 6, 5, ["5"]), (2, 4, 0, []), (None, 4, 4, ["5"])]


def test_decontaminate_cuts_and_drops(spark):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    docs = spark.createDataFrame(
        [
            (1, "É clean text; stays\tas it is!", "a"),
            (2, "Start é " + "word " * 40 + "ONE, two-three four (five) six; end ü.", "b"),
            (3, "one two three four five", "c"),
            (4, None, "d"),
        ],
        "doc_id long, text string, items string",
    )
    out = {r.doc_id: r for r in decontaminate.decontaminate(docs, bench, window=5, max_coverage=0.5).collect()}
    assert set(out) == {1, 2, 4} and out[1].text == "É clean text; stays\tas it is!" and out[4].text is None
    assert out[2].text == "Start é " + "word " * 40 + "; end ü." and out[2]["items"] == "b"
    dropped = decontaminate.decontaminate(docs, bench, window=5, max_coverage=0.0)
    assert sorted(r.doc_id for r in dropped.collect()) == [1, 4] and dropped.columns == docs.columns
    kept = decontaminate.decontaminate(docs, bench, window=5, max_coverage=0.5, max_span=6).where("doc_id = 2").first()
    assert kept.text.startswith("Start") and "three" in kept.text


# -- sharding -------------------------------------------------------------------------------------


def brute_shard(key, node, path=""):
    if node.shard is not None:
        return node.shard
    live = [c for c in node.children if c.weight > 0]

    def draw(c):
        bits = int(hashlib.md5(f"{path}/{c.name}:{key}".encode()).hexdigest()[:13], 16)
        return -math.log((bits + 0.5) / (1 << 52)) / c.weight

    best = live[0] if len(live) == 1 else min(live, key=draw)
    return brute_shard(key, best, f"{path}/{best.name}")


def test_shards_slots_and_growth(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("té"), "id")).alias("text"), F.lit(9).alias("shard"))
    rows = sharding.place(docs).collect()
    tree, more = sharding.default_tree(8), sharding.default_tree(9)
    per = {}
    for r in rows:
        text = f"té{r.doc_id}" if r.doc_id % 3 else ""
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        assert r.shard == brute_shard(str(r.doc_id), tree)
        assert r.grown_shard == brute_shard(str(r.doc_id), more)
        assert r.grown_shard in (r.shard, 8)
        per.setdefault(r.shard, []).append(r.slot)
    assert sorted(per) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in per.values())
    assert all(400 < len(s) < 600 for s in per.values())
    assert 330 < sum(r.grown_shard == 8 for r in rows) < 560


def test_weights_steer_and_movement_stays_in_changed_subtrees(spark):
    def tree(w):
        rack = lambda n, a, b, wa=1.0, wb=1.0: sharding.inner(n, [sharding.Node(f"s{a}", wa, a), sharding.Node(f"s{b}", wb, b)])
        return sharding.inner("root", [sharding.inner("r0", [rack("k0", 0, 1), rack("k1", 2, 3)]), sharding.inner("r1", [rack("k2", 4, 5, w, 2.0 - w)])])

    docs = spark.range(6000).select("id", sharding.shard_of("id", tree(1.0)).alias("old"), sharding.shard_of("id", tree(0.5)).alias("new"))
    rows = docs.collect()
    moved = [(r.old, r.new) for r in rows if r.old != r.new]
    assert moved and set(moved) == {(4, 5)}
    assert sharding.shard_of("id", tree(0.0)) is not None and 0.2 < sum(r.new == 4 for r in rows) / sum(r.new in (4, 5) for r in rows) < 0.3


def test_sharding_of_repeats_nulls_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (None, "b"), (None, None)], "doc_id long, text string")
    rows = sharding.place(docs).collect()
    assert len(rows) == 5 and len({(r.shard, r.slot) for r in rows}) == 5
    assert sharding.place(docs.limit(0)).count() == 0


# -- WARC -----------------------------------------------------------------------------------------


def test_round_trip(spark, tmp_path):
    rng = random.Random(3)
    bodies = [None, "", "<p>é</p>", "x" * 300000, "WARC/1.1\r\n\r\n", "\r\n\r\n" * 5] + ["".join(rng.choices("ab<>\r\n", k=50)) for _ in range(5)]
    rows = [(i, None if i % 7 == 0 else f"http://e.x/{i}\né", bodies[i % len(bodies)], "z") for i in range(60)] + [(70, "u", "hot", "z")] + [(100 + i, "u", "hot", "z") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes string").repartition(3)
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    first = {}
    for i, _, h, _ in sorted(rows, key=lambda r: r[0]):
        first.setdefault(h or "", i)
    assert len(got) == len(rows)
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if first[h or ""] == i else ("revisit", first[h or ""]))
    r = got[3]
    fs, path = pyarrow.fs.FileSystem.from_uri(r.archive)
    with fs.open_input_file(path) as f:
        f.seek(r.offset)
        member = gzip.decompress(f.read(r.length))
    assert member.startswith(b"WARC/1.1\r\n") and member.rstrip().endswith(b"x" * 100)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_small_payloads_are_all_responses_and_ids_may_be_null(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef"), (None, "u", "abcdef")], "page_id long, url string, html string")
    got = warc.round_trip(pages, least_bytes=3).collect()
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds[1] == kinds[2] == kinds[3] == ("response", None) and kinds[4] == ("revisit", 3) and len(got) == 5


def test_ids_of_any_text_come_back(spark):
    ids = ["null", "a\nb", "", " ", "x\r\n\r\ny", "100%", "é<>", "urn:nil", None, "rep", "rep"]
    rows = [(i, "u", f"p{k}") for k, i in enumerate(ids)] + [("zz", "u", "p1"), ("yy", "u", "p2")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = warc.round_trip(pages).collect()
    assert sorted((r.page_id for r in got), key=str) == sorted((r[0] for r in rows), key=str)
    refers = {r.page_id: r.refers_to for r in got if r.record_type == "revisit"}
    assert refers == {"zz": "a\nb", "yy": ""}


def test_damaged_archives_are_errors():
    rec = warc.record("1", "u", b"payload", None)
    assert [bytes(r) for r in warc.records_of([rec[:10], rec[10:] + rec])] == [rec, rec]
    with pytest.raises(ValueError):
        list(warc.records_of([rec[:-9]]))
    with pytest.raises(ValueError):
        warc.parse(rec.replace(b"payload", b"paxload"))


# -- secrets --------------------------------------------------------------------------------------


def brute_base(text):
    out = []
    key = r"(?a:(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
    for m in re.finditer(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_base_spans_equal_plain_patterns_and_ownership_parts_them(spark):
    rng = random.Random(6)
    bits = ["Password: ", "passwd=", "toKen = '", 'api_key":"', "APIKEY=", "AKIA", "é ", "secret:", "ſecret=abcdefghijklmnop", "K", "0123456789abcdef" * 2, "\n"]
    def piece():
        return rng.choice(bits) + "".join(rng.choices("abcdefABCDEFXYZ0123456789_./", k=rng.randint(0, 30)))
    texts = ["".join(piece() for _ in range(rng.randint(0, 12))) for _ in range(150)] + [None, "", "a" * 200000]
    rows = [(i, t, f"s{i % 9}") for i, t in enumerate(texts)]
    shared = "token = 'abcdefghij0123456789XYZ'"
    own = "key Zx9Qw8Er7Ty6Ui5Op4As3Df2"
    rows += [(1000 + i, shared, f"s{i % 9}") for i in range(30)] + [(2000, own, "s1"), (2001, own, "s1"), (2002, "x", None)]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, source string, spans string")
    got = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert got[i].base == brute_base(t or "")
        kinds = [x.split(":")[0] for x in got[i].base.split(",") if x]
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(kinds.count(k) for k in secrets.KINDS[:3])
        assert [x for x in got[i].spans.split(",") if x and not x.startswith("dense")] == [x for x in got[i].base.split(",") if x]
    assert got[1000].n_example >= 1 and got[1000].n_live == 0 and got[1000].max_owners == 9
    assert got[2000].spans == "dense:4:28" and got[2000].n_live == 1 and got[2000].max_uses == 2
    assert secrets.scan_secrets(docs.limit(0)).count() == 0


# -- queries against their SQL on planted rows ----------------------------------------------------


def planted_secrets():
    rng = random.Random(7)
    key = lambda n, letters="abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/_-": "".join(rng.choices(letters, k=n))
    keys = [key(n) for n in (12, 20, 24, 32, 40, 40, 64)]
    hexes = [key(n, "0123456789abcdef") for n in (15, 16, 32, 64)]
    forms = ["PassWord = {}", 'token:"{}"', "api_key={}", "apikey='{}' x", "AKIA{}", "{}", "é{}é", "\u212aey toKen={}", "secret={}=password={}", "x/{}/y"]
    rows = [(0, "", "a", "en"), (1, None, "a", "en"), (1, None, "a", "en"), (2, "token=abcdefghijk", None, None), (3, "k" * 50 + "1" * 25, "b", "de")]
    for i in range(4, 160):
        parts = []
        for _ in range(rng.randint(1, 6)):
            form = rng.choice(forms)
            value = rng.choice([*keys, *hexes, key(30), key(18, "ABCDEFGHIJ0123456789")])
            parts.append(form.replace("{}", value) + rng.choice([" ", "\n", "日本 ", "", "; "]))
        rows.append((i, "".join(parts), rng.choice(["a", "b", "c", "d", None]), rng.choice(["en", "fr", None])))
    return rows


@pytest.mark.parametrize("name", ["op3_sharding", "op10_secret_scan"])
def test_query_equals_its_sql_on_planted_rows(spark, tmp_path, name):
    rows = planted_secrets()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(queries.oracle_sql()[name])
    columns = sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in columns]
    want = sorted(tuple(r[i] for i in order) for r in want.fetchall())
    got = queries.queries()[name](spark, str(tmp_path)).select(*columns).collect()
    assert len(want) == len(rows) and sorted(map(tuple, got)) == want
