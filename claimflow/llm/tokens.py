"""Token counts of a unigram vocabulary by dynamic programming over a shared trie.

Distinct pre-tokens are inserted in a trie. A node stands for a prefix and
holds the best score of cutting that prefix into pieces and the number of
tokens of that cut; both follow from the nodes above it, so a prefix shared by
many pre-tokens is scored once. The pieces that end at a node come from suffix
links over the piece set, so only real pieces are weighed. A pre-token's count
is that of its last node (its terminal). A text's count is the sum over its
pre-tokens.

Each task grows its own trie, so no text is shuffled; a trie of ``TRIE_NODES``
nodes (about 300 MB) is dropped and begun anew, which costs time and changes
no count.

The installed vocabulary is a byte-pair model, whose scores are merge ranks and
no log probabilities. ``unigram_pieces`` gives its pieces unigram scores: the
smoothed log shares of the pieces in the model's own cut of the whole corpus.
White space parts pre-tokens and is no token itself.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Vocabulary file (a parameter of the query; the file is read, never copied).
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Nodes of a task's trie at most; longer pre-tokens than LONG characters are scored without it.
TRIE_NODES, LONG = 1_500_000, 200
#: Distinct pre-tokens that a task of the piece counts holds before it cuts them.
HELD_WORDS = 200_000
#: Added to the count of every piece.
SMOOTHING = 0.5
#: Marks the beginning of a pre-token.
MARK = "▁"
#: How much worse than the worst piece an unknown character scores.
UNKNOWN_PENALTY = 10.0


def load_pieces(path: str) -> dict[str, float]:
    """The ordinary pieces of a sentencepiece model and their scores (of a byte-pair model: minus the merge rank)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = (i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)))
    return {sp.id_to_piece(i): sp.get_score(i) for i in ids}


def _piece_counts(model):
    """How often each piece is in the model's cuts of a task's pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        total = np.zeros(sp.get_piece_size(), np.int64)
        held: Counter[bytes] = Counter()

        def cut() -> None:
            found = sp.encode([w.decode("utf-8", "replace") for w in held])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter((i for f in found for i in f), np.int64, int(sizes.sum()))
            np.add.at(total, ids, np.repeat(np.fromiter(held.values(), np.int64, len(held)), sizes))
            held.clear()

        for batch in batches:
            for raw in batch.column("text").to_pylist():
                held.update((raw or b"").split())
                if len(held) > HELD_WORDS:
                    cut()
        if held:
            cut()
        ids = np.flatnonzero(total)
        pieces = [sp.id_to_piece(int(i)) for i in ids]
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(total[ids], pa.int64())], ["piece", "n"])

    return run


def unigram_pieces(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> dict[str, float]:
    """The vocabulary's ordinary pieces with log probabilities from the whole corpus.

    One pass; the driver gets a row a piece, tens of thousands whatever the data.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    model = docs.sparkSession.sparkContext.broadcast(sp.serialized_model_proto())
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    counts = texts.mapInArrow(_piece_counts(model), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    seen = {r.piece: r.n for r in counts.toLocalIterator()}
    pieces = [*load_pieces(vocabulary)]
    total = sum(seen.get(p, 0) for p in pieces) + SMOOTHING * len(pieces)
    return {p: math.log((seen.get(p, 0) + SMOOTHING) / total) for p in pieces}


class PieceSuffixes:
    """The pieces that end at a place of a word, found by suffix links over the piece set.

    A state stands for the longest suffix read so far that begins some piece;
    its suffix link is the next shorter one. ``ends`` has, for every state, the
    lengths and scores of the pieces that end there.
    """

    def __init__(self, pieces: dict[str, float]):
        self.next: dict[int, int] = {}  # state and character -> state
        self.ends: list[tuple[tuple[int, float], ...]] = [()]
        link, own, queue = [0], [None], []
        for piece, score in pieces.items():
            state = 0
            for ch in piece:
                key = state << 21 | ord(ch)
                below = self.next.get(key)
                if below is None:
                    below = self.next[key] = len(own)
                    own.append(None)
                    link.append(0)
                    self.ends.append(())
                    queue.append((state, ch, below))
                state = below
            if piece:
                own[state] = (len(piece), score)
        self.link = link
        depth = [0] * len(own)
        for up, _, below in queue:
            depth[below] = depth[up] + 1
        for up, ch, below in sorted(queue, key=lambda q: depth[q[2]]):  # links lead to shorter suffixes
            if up:
                link[below] = self.step(link[up], ch)
            self.ends[below] = (() if own[below] is None else (own[below],)) + self.ends[link[below]]

    def step(self, state: int, ch: str) -> int:
        """The state after one more character; remembered, so that a link is followed once."""
        key = state << 21 | ord(ch)
        found = self.next.get(key)
        if found is None:
            found = self.step(self.link[state], ch) if state else 0
            self.next[key] = found
        return found


class TrieCounter:
    """Token counts of pre-tokens under a unigram vocabulary.

    The best cut has the highest sum of scores, then the fewest tokens. A
    character that is no piece by itself may stand alone as its UTF-8 bytes,
    one token each. Bytes that are no UTF-8 count as replacement characters.
    """

    def __init__(self, pieces: dict[str, float]):
        self.suffixes = PieceSuffixes(pieces)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self._clear()

    def _clear(self) -> None:
        self.child: dict[int, int] = {}
        self.score: list[float] = [0.0]
        self.tokens: list[int] = [0]
        self.state: list[int] = [0]
        self.terminal: dict[bytes, int] = {}

    def _best(self, ch: str, state: int, path: list[int], score: list[float], tokens: list[int]) -> tuple[float, int]:
        """Best score and tokens of a prefix that ends with ``ch``; ``path`` has the places of all shorter ones."""
        best, fewest = float("-inf"), 0
        alone = False
        for length, s in self.suffixes.ends[state]:
            alone |= length == 1
            at = path[-length]
            s += score[at]
            n = 1 + tokens[at]
            if s > best or s == best and n < fewest:
                best, fewest = s, n
        if not alone:
            at = path[-1]
            s, n = self.unknown + score[at], len(ch.encode("utf-8", "surrogatepass")) + tokens[at]
            if s > best or s == best and n < fewest:
                best, fewest = s, n
        return best, fewest

    def insert(self, pre_token: bytes) -> int:
        """Insert a pre-token; its terminal count."""
        word = MARK + pre_token.decode("utf-8", "replace")
        step = self.suffixes.step
        if len(word) > LONG:  # scored by itself, so that one long run doesn't fill the trie
            score, tokens, state = [0.0], [0], 0
            path = [0]
            for end, ch in enumerate(word, 1):
                state = step(state, ch)
                s, n = self._best(ch, state, path, score, tokens)
                score.append(s)
                tokens.append(n)
                path.append(end)
            return tokens[-1]
        child, node = self.child, 0
        path = [0]
        for ch in word:
            key = node << 21 | ord(ch)
            below = child.get(key)
            if below is None:
                state = step(self.state[node], ch)
                s, n = self._best(ch, state, path, self.score, self.tokens)
                below = child[key] = len(self.score)
                self.score.append(s)
                self.tokens.append(n)
                self.state.append(state)
            node = below
            path.append(node)
        self.terminal[pre_token] = n = self.tokens[node]
        return n

    def count(self, raw: bytes | None) -> tuple[int, int]:
        """Pre-tokens (runs without ASCII white space) and tokens of a text."""
        words = (raw or b"").split()
        if len(self.score) > TRIE_NODES:
            self._clear()
        terminal = self.terminal
        new = {w: self.insert(w) for w in set(words).difference(terminal)}
        if all(w in terminal for w in new):
            return len(words), sum(map(terminal.__getitem__, words))
        return len(words), sum(terminal[w] if w in terminal else new[w] for w in words)


def _counting(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TrieCounter(pieces.value)
        for batch in batches:
            found = [counter.count(raw) for raw in batch.column("text").to_pylist()]
            cols = [batch.column("row"), *(pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(cols, ["row", "n_pretokens", "n_tokens"])

    return run


def token_counts(
    docs: DataFrame, carry: list[str], text_col: str = "text", vocabulary: str = VOCABULARY, scores: dict[str, float] | None = None
) -> DataFrame:
    """One row per input row: ``row`` (a struct of the ``carry`` columns), ``n_pretokens``, ``n_tokens``.

    Null, empty and blank texts have no tokens. The pieces, tens of thousands
    whatever the data, are broadcast: ``scores`` (see ``unigram_pieces``) or
    else those of the vocabulary file as they are.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary) if scores is None else scores)
    rows = docs.select(F.struct(*carry).alias("row"), F.col(text_col).cast("binary").alias("text"))
    counts = [T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return rows.mapInArrow(_counting(pieces), T.StructType([rows.schema["row"], *counts]))
