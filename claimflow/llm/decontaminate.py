"""Benchmark decontamination with a generalised suffix automaton over words.

The normalised benchmark items are inserted into one automaton (states hold
transitions by word, a suffix link and the longest length). Every document's
words are streamed through it once: each step keeps the longest suffix read so
far that occurs in some item. Where that length reaches the window, the state
of the last ``window`` words names the items that hold them, and the words are
marked. An item shorter than the window is one window as a whole.

The items are dealt to blocks of about ``BLOCK_WORDS`` words. A block's
automaton is built in a task and broadcast; with several blocks the documents
are streamed once per block, one block after the other, so that one automaton
at a time is held, and the findings are united.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.llm.common import ascii_lower, stored

#: Words of a block of items, and so of one broadcast automaton.
BLOCK_WORDS = 200_000
#: Word bytes stay (letters lower-cased), all other ASCII becomes a space. Bytes from 0x80 are letters.
_WORD_BYTES = bytes(
    i + 32 if 0x41 <= i <= 0x5A else i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20
    for i in range(256)
)
_RUN = re.compile(rb"[^ ]+")
#: The same words in SQL, for counting those of the items.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str | None) -> list[bytes]:
    """The normalised words of a text (null: none)."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items of every window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link: list[int] = [-1]
        self.len: list[int] = [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        #: state of a window -> items that hold it; state of a short item -> its (length, item)s
        self.full: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, words in items:
            self._register(item, words)
        #: nearest state up the links (itself included) that ends a short item, or 0
        self.up_short = [0] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.len.__getitem__):
            self.up_short[v] = v if v in self.short else self.up_short[self.link[v]]
        lengths = [m for x in self.short.values() for m, _ in x] + ([window] if self.full else [])
        self.least = min(lengths, default=1 << 60)

    def _clone(self, p: int, w: bytes, q: int) -> int:
        c = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, w, q)
        cur = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.len.append(self.len[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, w, q)
        return cur

    def _register(self, item: str, words: list[bytes]) -> None:
        v, n = 0, 0
        for w in words:
            v, n = self.next[v][w], n + 1
            if n >= self.window:
                while self.len[self.link[v]] >= self.window:
                    v = self.link[v]
                n = min(n, self.len[v])
                self.full.setdefault(v, set()).add(item)
        if 0 < len(words) < self.window:
            while self.len[self.link[v]] >= len(words):
                v = self.link[v]
            self.short.setdefault(v, []).append((len(words), item))

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges (merged, end exclusive) and the items with occurring windows."""
        nxt, link, length, least, window = self.next, self.link, self.len, self.least, self.window
        v = n = 0
        hits: list[tuple[int, int]] = []
        items: set[str] = set()
        for i, w in enumerate(words):
            to = nxt[v].get(w)
            if to is not None:
                v, n = to, n + 1
            else:
                while v and to is None:
                    v = link[v]
                    to = nxt[v].get(w)
                if to is None:
                    n = 0
                    continue
                n = length[v] + 1
                v = to
            if n < least:
                continue
            widest = 0
            if n >= window:
                u = v
                while length[link[u]] >= window:
                    u = link[u]
                items |= self.full[u]
                widest = window
            u = self.up_short[v]
            while u:
                for m, item in self.short[u]:
                    if m <= n:
                        items.add(item)
                        widest = max(widest, m)
                u = self.up_short[link[u]]
            if widest:
                start = i + 1 - widest
                while hits and hits[-1][1] >= start:
                    start = min(start, hits.pop()[0])
                hits.append((start, i + 1))
        return hits, items


_HIT = T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "end", "words")])
_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hits", T.ArrayType(_HIT)),
    T.StructField("items", T.ArrayType(T.StringType())),
]
_HITS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32())]))


def _result(row: pa.Array, name: str, found: list[tuple[int, list, list]]) -> pa.RecordBatch:
    """A batch of results: words of the text, hit ranges as byte offsets, and items."""
    hits = [[{"start": a, "end": b, "words": n} for a, b, n in h] for _, h, _ in found]
    return pa.RecordBatch.from_arrays(
        [
            row,
            pa.array([n for n, _, _ in found], pa.int64()),
            pa.array([sum(x["words"] for x in h) for h in hits], pa.int64()),
            pa.array(hits, _HITS),
            pa.array([items for _, _, items in found], pa.list_(pa.string())),
        ],
        [name, "n_words", "n_hit", "hits", "items"],
    )


def _scanner(automaton, name: str):
    """An Arrow pass streaming each text through the automaton; ``name`` is the column carried along."""

    def one(raw: bytes | None, sam: SuffixAutomaton) -> tuple[int, list, list]:
        flat = (raw or b"").translate(_WORD_BYTES)
        words = flat.split()
        hits, items = sam.stream(words)
        at = [m.span() for m in _RUN.finditer(flat)] if hits else []
        return len(words), [(at[a][0], at[b - 1][1], b - a) for a, b in hits], sorted(i for i in items if i is not None)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sam: SuffixAutomaton = automaton.value
        for batch in batches:
            yield _result(batch.column(name), name, [one(raw, sam) for raw in batch.column("text").to_pylist()])

    return scan


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unite the ranges that several blocks found in a row; ranges that touch or overlap become one."""
    for batch in batches:
        found = []
        cols = (batch.column(c).to_pylist() for c in ("text", "hits", "items"))
        for raw, hits, items in zip(*cols):
            at = [m.span() for m in _RUN.finditer((raw or b"").translate(_WORD_BYTES))]
            index = {a: i for i, (a, _) in enumerate(at)} if hits else {}
            ranges: list[tuple[int, int]] = []
            for h in sorted(hits or [], key=lambda h: h["start"]):
                a = index[h["start"]]
                b = a + h["words"]
                if ranges and ranges[-1][1] >= a:
                    ranges[-1] = (ranges[-1][0], max(ranges[-1][1], b))
                else:
                    ranges.append((a, b))
            found.append((len(at), [(at[a][0], at[b - 1][1], b - a) for a, b in ranges], items or []))
        yield _result(batch.column("row"), "row", found)


def _building(window: int):
    """Build the automaton of a block's items in a task; the result is the pickled automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [(i, words_of(t)) for b in batches for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist())]
        made = pickle.dumps(SuffixAutomaton(items, window))
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["automaton"])

    return run


def _automata(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> Iterator[SuffixAutomaton]:
    """The automata of the items in blocks of about ``block_words`` words, one at a time."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = F.size(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD_PATTERN), F.lit(0)))
    total = items.agg(F.sum(n)).first()[0] or 0
    blocks = -(-total // block_words)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(blocks, 1)))
    for b in range(blocks):
        made = items.where(part == b).repartition(1).mapInArrow(_building(window), "automaton binary").first()
        yield pickle.loads(made.automaton)


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    carry: list[str],
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per input row: ``row`` (a struct of the ``carry`` columns), ``n_words``, ``n_hit``, ``hits``, ``items``.

    ``hits`` are byte ranges of the UTF-8 text, cut at words, with their
    number of words; ``n_hit`` is their sum. Texts without words (null,
    empty) have no hits; items without words have no windows. Windows of items
    without an id are hit like others, but name no item; items sharing an id
    count as one. An empty benchmark marks nothing. Repeated rows are scanned
    each. Columns other than ``carry`` and the text are not read.
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.struct(*carry).alias("row"), F.col(text_col).cast("binary").alias("text"))
    automata = _automata(benchmark, item_col, item_text_col, window, block_words)
    first = next(automata, None) or SuffixAutomaton([], window)
    second = next(automata, None)
    if second is None:
        return rows.mapInArrow(_scanner(sc.broadcast(first), "row"), T.StructType([rows.schema["row"], *_FOUND]))
    kept = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "decontaminate-rows")
    by_rid = T.StructType([kept.schema["rid"], *_FOUND])
    found = None
    for automaton in chain([first, second], automata):
        shared = sc.broadcast(automaton)
        hits = stored(kept.select("rid", "text").mapInArrow(_scanner(shared, "rid"), by_rid).where("n_hit > 0"), "decontaminate-hits")
        shared.destroy()
        found = hits if found is None else found.unionByName(hits)
    united = found.groupBy("rid").agg(
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    both = kept.join(united, "rid", "left").select("row", "text", "hits", "items")
    return both.mapInArrow(_merge, T.StructType([kept.schema["row"], *_FOUND]))


def _cutter(max_span: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, hits in enumerate(batch.column("hits").to_pylist()):
                long = [h for h in hits if h["words"] > max_span]
                if long:
                    raw = texts[i].encode("utf-8", "surrogatepass")
                    ends = [0, *(h["end"] for h in long)]
                    starts = [*(h["start"] for h in long), len(raw)]
                    texts[i] = b"".join(raw[a:b] for a, b in zip(ends, starts)).decode("utf-8", "surrogatepass")
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return cut


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    max_span: int = 0,
    max_coverage: float = 0.1,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents without benchmark passages; same columns.

    A document is dropped when more than ``max_coverage`` of its words are
    hit (0: any hit). In the others, hit spans of more than ``max_span``
    words are cut out of the text and nothing else is touched. Null, empty
    and clean texts pass unchanged.
    """
    found = scan(docs, benchmark, docs.columns, text_col, item_col, item_text_col, window, block_words)
    kept = found.where(F.col("n_hit") <= F.lit(max_coverage) * F.col("n_words"))
    if max_coverage <= 0:
        return kept.select("row.*")
    source = kept.select("row", F.col("row")[text_col].alias("text"), "hits")
    schema = T.StructType([kept.schema["row"], T.StructField("text", T.StringType())])
    cut = source.mapInArrow(_cutter(max_span), schema)
    return cut.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
