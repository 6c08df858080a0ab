"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import (
    decontaminate,
    exact_dedup,
    filter_audit,
    html_text,
    lines,
    minhash,
    mixing,
    resampling,
    secrets,
    sharding,
    tokens,
    toxicity,
    warc,
)
from claimflow.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and unigram tokens of every document, the pieces' probabilities learnt from all of them."""
    docs = table(spark, sf_dir, "documents")
    found = tokens.token_counts(docs, ["doc_id", "n_chars"], scores=tokens.unigram_pieces(docs))
    return found.select("row.doc_id", "row.n_chars", "n_pretokens", "n_tokens")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a 10-word window of a benchmark item."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_aggregate(w[i:i + least(len(w), 10) - 1], 'string_agg', ' ') AS g, least(len(w), 10) AS m
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
hit AS (
  SELECT p.doc_id, p.i, s.m, x.item_id
  FROM (SELECT doc_id, i, m, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS g FROM pos, sizes WHERE i + m - 1 <= len(w)) p
  JOIN sizes s USING (m) JOIN win x ON x.m = p.m AND x.g = p.g),
marked AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS j FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(k, ',' ORDER BY k) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(m.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.s, '')) AS items_sha256,
       coalesce(m.n, 0) > 0 AS contaminated
FROM d LEFT JOIN marked m USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of the hash tree, and where they go with a ninth shard."""
    placed = sharding.place(table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


#: The tree by its paths and weights: two regions of two racks of two shards, and the region that the ninth shard opens.
OP3_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t),
texts AS (
  SELECT text, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)),
summed AS (
  SELECT text, CAST(len(bytes) + 1 AS BIGINT) AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM texts, crc),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(CAST(doc_id AS VARCHAR), chr(0) || 'null') AS key, size, text_crc32
  FROM documents JOIN summed ON coalesce(documents.text, '') = summed.text),
child(parent, path, weight) AS (VALUES
  ('', '/r0', 4), ('', '/r1', 4), ('', '/r+8', 1),
  ('/r0', '/r0/k0', 2), ('/r0', '/r0/k1', 2), ('/r1', '/r1/k2', 2), ('/r1', '/r1/k3', 2),
  ('/r0/k0', '/r0/k0/s0', 1), ('/r0/k0', '/r0/k0/s1', 1), ('/r0/k1', '/r0/k1/s2', 1), ('/r0/k1', '/r0/k1/s3', 1),
  ('/r1/k2', '/r1/k2/s4', 1), ('/r1/k2', '/r1/k2/s5', 1), ('/r1/k3', '/r1/k3/s6', 1), ('/r1/k3', '/r1/k3/s7', 1)),
drawn AS (
  SELECT rid, parent, path, -ln((CAST('0x' || left(md5(path || ':' || key), 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / weight AS draw
  FROM d, child),
taken AS (SELECT rid, parent, arg_min(path, draw) FILTER (path <> '/r+8') AS path, arg_min(path, draw) AS grown FROM drawn GROUP BY rid, parent),
placed AS (
  SELECT d.*, CAST(right(leaf.path, 1) AS INT) AS shard, CASE WHEN region.grown = '/r+8' THEN 8 ELSE CAST(right(leaf.path, 1) AS INT) END AS grown_shard,
    CAST('0x' || left(md5(concat_ws(':', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR), CAST(text_crc32 AS VARCHAR))), 8) AS BIGINT) % 1024 AS b
  FROM d JOIN taken region ON region.rid = d.rid AND region.parent = ''
  JOIN taken rack ON rack.rid = d.rid AND rack.parent = region.path
  JOIN taken leaf ON leaf.rid = d.rid AND leaf.parent = rack.path)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY b, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM placed
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat an earlier line or lie one edit from one."""
    found = lines.line_dedup(table(spark, sf_dir, "documents"))
    dropped = F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped")
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_exact", "n_near", dropped)


OP4_SQL = r"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
pos AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM raw),
s AS (SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS t FROM pos),
o AS (SELECT doc_id, i, t, row_number() OVER (ORDER BY doc_id, i) AS r FROM s WHERE t <> ''),
d AS (SELECT t, min(r) AS r, length(t) AS n FROM o GROUP BY t),
h AS (
  SELECT t, r, n, unnest([{'k': n, 'm': 'h', 'x': left(t, n // 2)}, {'k': n, 'm': 't', 'x': right(t, n - n // 2)},
    {'k': n + 1, 'm': 'h', 'x': left(t, (n + 1) // 2)}, {'k': n + 1, 'm': 't', 'x': right(t, n + 1 - (n + 1) // 2)}], recursive := true) FROM d WHERE n >= 10),
p AS (SELECT DISTINCT y.t AS t, x.t AS u FROM h x JOIN h y ON x.k = y.k AND x.m = y.m AND x.x = y.x WHERE x.r < y.r),
near AS (SELECT DISTINCT t FROM p WHERE abs(length(t) - length(u)) <= 1 AND levenshtein(t, u) = 1),
gone AS (
  SELECT o.doc_id, o.i, near.t IS NOT NULL AS near FROM o JOIN d USING (t) LEFT JOIN near USING (t) WHERE near.t IS NOT NULL OR o.r <> d.r),
g AS (
  SELECT doc_id, count(*) FILTER (NOT near) AS n_exact, count(*) FILTER (near) AS n_near, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS dropped
  FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
       coalesce(dropped, '') AS dropped
FROM raw LEFT JOIN g USING (doc_id)
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back at its offset in the normalised archives."""
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT page_id, h, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(x, CAST((i // 4) * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INT) + 1, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learnt from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, ["doc_id"]).select(
        "row.doc_id",
        toxicity.held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document of equal text that stays."""
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP7_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over 4-word shingles at a similarity of 0.8."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + 3], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, x) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.x AS component_id, d.doc_id = m.x AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(x) AS x FROM r GROUP BY doc_id) m USING (doc_id)
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and copies of every document for the target shares of quality domains."""
    labels = table(spark, sf_dir, "labels")
    domain = mixing.label_domain(F.col("quality"), F.col("toxic")).alias("domain")
    found = mixing.mix(table(spark, sf_dir, "documents"), labels.select("doc_id", domain), mixing.TARGETS, ["doc_id"])
    shares = [F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(mixing.TARGETS)]
    return found.select("row.doc_id", "n_tokens", *shares, "rate", "copies")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with how widely their values are owned across sources."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", F.concat_ws("/", "source", "lang").alias("repository")
    )
    found = secrets.scan_secrets(docs, repo_col="repository", owner_col="source")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans",
        "n_live", "n_shared", "n_example", "max_owners", "max_repos", "max_uses",
    )


#: A match starts after the pieces between matches and the matches before it. The first pattern spells both cases
#: out, as case folding would take in letters beyond ASCII. Ownership counts the values of all candidates.
OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, chr(0) || 'null') AS owner,
    concat_ws('/', source, lang) AS repo,
    '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])'
    || '["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS assign
  FROM documents),
matched AS (
  SELECT rid, 0 AS kind, regexp_extract_all(text, assign) AS m, regexp_extract_all(text, assign, 2) AS v, regexp_split_to_array(text, assign) AS gap FROM d
  UNION ALL SELECT rid, 1, regexp_extract_all(text, 'AKIA[A-Z0-9]+') AS m, m, regexp_split_to_array(text, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT rid, 2, regexp_extract_all(text, '[0-9a-f]+') AS m, m, regexp_split_to_array(text, '[0-9a-f]+') FROM d
  UNION ALL SELECT rid, 3, regexp_extract_all(text, '[A-Za-z0-9+/_-]{20,}') AS m, m, regexp_split_to_array(text, '[A-Za-z0-9+/_-]{20,}') FROM d),
each AS (SELECT rid, kind, unnest(m) AS m, unnest(v) AS v, unnest(gap[1:len(m)]) AS gap, unnest(range(len(m))) AS i FROM matched),
placed AS (SELECT rid, kind, v, length(m) AS n, sum(length(gap) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i) AS upto FROM each),
long AS (
  SELECT rid, kind, v, CAST(upto - n AS BIGINT) AS first, CAST(upto AS BIGINT) AS upto FROM placed
  WHERE length(v) >= CASE kind WHEN 0 THEN 12 WHEN 1 THEN 18 WHEN 2 THEN 16 ELSE 20 END),
chars AS (SELECT v, c, count(*) AS n FROM (SELECT v, unnest(string_split(v, '')) AS c FROM (SELECT DISTINCT v FROM long WHERE kind = 3)) GROUP BY v, c),
rich AS (
  SELECT v FROM chars GROUP BY v
  HAVING sum(CASE WHEN c BETWEEN '0' AND '9' THEN n ELSE 0 END) >= 3 AND sum(CASE WHEN c BETWEEN '0' AND '9' THEN 0 ELSE n END) >= 3
    AND -sum(CAST(n AS DOUBLE) / length(v) * log2(CAST(n AS DOUBLE) / length(v))) >= 3.5),
candidates AS (
  SELECT rid, kind, v, first, upto FROM long WHERE kind < 3
  UNION ALL SELECT rid, kind, v, first, upto FROM long t WHERE kind = 3 AND v IN (SELECT v FROM rich)
    AND NOT EXISTS (SELECT 1 FROM long b WHERE b.rid = t.rid AND b.kind < 3 AND b.first < t.upto AND t.first < b.upto)),
owned AS (
  SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT repo) AS repos, count(*) AS uses
  FROM candidates JOIN d USING (rid) GROUP BY v),
judged AS (
  SELECT rid, kind, first, concat_ws(':', ['assign', 'access', 'hex', 'dense'][kind + 1], CAST(first AS VARCHAR), CAST(upto AS VARCHAR)) AS span,
    owners, repos, uses, CASE WHEN owners >= 3 THEN 'example' WHEN owners = 1 THEN 'live' ELSE 'shared' END AS verdict
  FROM candidates JOIN owned USING (v)),
told AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY first, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY first, kind) AS spans,
    count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'shared') AS n_shared, count(*) FILTER (verdict = 'example') AS n_example,
    max(owners) AS max_owners, max(repos) AS max_repos, max(uses) AS max_uses
  FROM judged WHERE kind < 3 OR verdict = 'live' GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared,
  coalesce(n_example, 0) AS n_example, coalesce(max_owners, 0) AS max_owners, coalesce(max_repos, 0) AS max_repos, coalesce(max_uses, 0) AS max_uses
FROM d LEFT JOIN told USING (rid)
"""


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights, scores and draws of all documents towards the words of the benchmark."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = resampling.resample(docs, target, percent=10, least_words=20, longest=1, buckets=10_000, seed=2024)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


OP11_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS f FROM d),
bw AS (SELECT unnest(w) AS f FROM b),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM dw UNION SELECT f FROM bw)),
coded AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h), 2), lambda i: CAST('0x' || substr(h, CAST(i + 1 AS INT), 2) AS BIGINT))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS k FROM hexed, crc),
db AS (SELECT doc_id, k FROM dw JOIN coded USING (f)),
s AS (SELECT k, count(*) AS n FROM db GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bw JOIN coded USING (f) GROUP BY k),
whole AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) + 10000 AS s, (SELECT coalesce(sum(n), 0) FROM t) + 10000 AS t),
gain AS (
  SELECT k, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1) * CAST(whole.s AS DOUBLE) / ((coalesce(s.n, 0) + 1) * CAST(whole.t AS DOUBLE)))) AS BIGINT) AS g
  FROM s FULL JOIN t USING (k), whole),
w AS (SELECT doc_id, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM db JOIN gain USING (k) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_features, coalesce(w.weight, 0) AS weight,
    coalesce(w.weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", "n_chars")


#: The given pages hold one article of a heading and paragraphs, with b, br and a few character references inside;
#: for such pages the article is plain SQL. Other forms are compared with known articles in the tests.
OP12_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS h FROM pages),
cut AS (SELECT page_id, url, string_split_regex(regexp_replace(replace(replace(h, '<b>', ''), '</b>', ''), '<br>', ' ', 'g'), '</?(?:h1|p)>') AS raw FROM a),
b AS (
  SELECT page_id, url, list_transform(raw, lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(x, '&quot;', '"'), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) AS b FROM cut),
j AS (SELECT page_id, url, coalesce(array_to_string(list_filter(b, lambda x: x <> ''), chr(10) || chr(10)), '') AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM j
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in all 120 orders, by language."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM f a, f b, f c, f d, f e
  WHERE a.x <> b.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT t.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM t LEFT JOIN l USING (doc_id)),
n AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
r AS (
  SELECT part, o, step, substr(o, CAST(step AS INT), 1) AS x,
    sum(n) FILTER (contains(fails, substr(o, CAST(step AS INT), 1)) AND NOT regexp_matches(fails, '[' || left(o, CAST(step AS INT) - 1) || '0]')) AS removed,
    sum(good) FILTER (contains(fails, substr(o, CAST(step AS INT), 1)) AND NOT regexp_matches(fails, '[' || left(o, CAST(step AS INT) - 1) || '0]')) AS good_lost,
    sum(toxic) FILTER (contains(fails, substr(o, CAST(step AS INT), 1)) AND NOT regexp_matches(fails, '[' || left(o, CAST(step AS INT) - 1) || '0]')) AS toxic_lost,
    sum(n) FILTER (NOT regexp_matches(fails, '[' || left(o, CAST(step AS INT)) || '0]')) AS kept,
    sum(n) FILTER (contains(fails, substr(o, CAST(step AS INT), 1))) AS failing,
    sum(n) FILTER (fails = substr(o, CAST(step AS INT), 1)) AS alone
  FROM n, steps GROUP BY part, o, step)
SELECT part, o AS filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(failing, 0) - coalesce(removed, 0) AS BIGINT) AS redundant, CAST(coalesce(alone, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_decontamination": op2_decontamination,
        "op3_sharding": op3_sharding,
        "op4_line_dedup": op4_line_dedup,
        "op5_warc": op5_warc,
        "op6_toxicity": op6_toxicity,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_minhash_near_dedup": op8_minhash_near_dedup,
        "op9_mixing": op9_mixing,
        "op10_secret_scan": op10_secret_scan,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_html_extraction": op12_html_extraction,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": OP2_SQL,
        "op3_sharding": OP3_SQL,
        "op4_line_dedup": OP4_SQL,
        "op5_warc": OP5_SQL,
        "op7_exact_dedup": OP7_SQL,
        "op8_minhash_near_dedup": OP8_SQL,
        "op10_secret_scan": OP10_SQL,
        "op11_importance_resampling": OP11_SQL,
        "op12_html_extraction": OP12_SQL,
        "op13_filter_audit": OP13_SQL,
    }
