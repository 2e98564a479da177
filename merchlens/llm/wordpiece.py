"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie. Where the next letter has no edge, the failure link of a
node names the node at which matching goes on, and a precomputed count says how many
pieces longest-match has finished on the way there. Each letter moves down one edge
or pops; no letter is read twice and no piece is ever built.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from merchlens.llm.common import documents, per_batch

# Distinct words whose counts one Python worker remembers; bounds memory, not results.
REMEMBERED_WORDS = 200_000

_NONE = -1


class PieceCounter:
    """Counts of longest-match pieces. `starts` open a word, `inner` go on within it.

    A word that longest-match cannot finish counts as one unknown token.
    """

    def __init__(self, starts: Iterable[str], inner: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]  # 0: word start, 1: within a word
        self.piece: list[bool] = [False, False]
        for root, pieces in ((0, starts), (1, inner)):
            for piece in pieces:
                node = root
                for letter in piece:
                    if letter not in self.edges[node]:
                        self.edges[node][letter] = len(self.edges)
                        self.edges.append({})
                        self.piece.append(False)
                    node = self.edges[node][letter]
                self.piece[node] = node > 1
        self._link()

    def _link(self) -> None:
        """Failure links and popped counts, breadth first: a parent's come before its own."""
        size = len(self.edges)
        self.fails, self.popped = [_NONE] * size, [0] * size
        level = [0, 1]
        while level:
            below = []
            for parent in level:
                for letter, node in self.edges[parent].items():
                    below.append(node)
                    if self.piece[node]:
                        self.fails[node], self.popped[node] = 1, 1
                        continue
                    back, count = self.fails[parent], self.popped[parent]
                    while back != _NONE and letter not in self.edges[back]:
                        count += self.popped[back]
                        back = self.fails[back]
                    if back != _NONE:
                        self.fails[node], self.popped[node] = self.edges[back][letter], count
            level = below

    def count(self, word: str) -> int:
        """Number of pieces, or 0 when the word cannot be cut into pieces."""
        edges, fails, popped = self.edges, self.fails, self.popped
        node = count = 0
        for letter in word:
            while (down := edges[node].get(letter, _NONE)) == _NONE:
                count += popped[node]
                node = fails[node]
                if node == _NONE:
                    return 0
            node = down
        while node > 1:
            count += popped[node]
            node = fails[node]
        return 0 if node == _NONE else count


class _Remembered(dict):
    """Piece counts of the words met so far."""

    def __init__(self, counter: PieceCounter):
        self.counter = counter

    def __missing__(self, word: bytes) -> int:
        found = self[word] = self.counter.count(word.decode())
        return found


@lru_cache(maxsize=2)
def remembered(vocabulary: tuple[tuple[str, ...], tuple[str, ...]]) -> _Remembered:
    """One automaton per Python worker and vocabulary."""
    return _Remembered(PieceCounter(*vocabulary))


def read_vocabulary(path: str | None = None) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Word starts and inner pieces of a sentence-piece file; they travel with the tasks.

    The file marks word starts. Control, unknown and byte pieces are left out.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    starts = tuple(p[1:] for p in pieces if p[0] == "▁" and len(p) > 1)
    return starts, tuple(p for p in pieces if "▁" not in p)


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown_words of every document.

    Words are runs of anything but ASCII white space. A word that cannot be cut counts
    as one token and one unknown word. One row per row of `docs`; a null or empty text
    has counts of zero. Other columns are ignored.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def step(doc_id, texts):
        known = remembered(pieces.value)
        words, tokens, unknown = [], [], []
        for text in texts:
            if len(known) > REMEMBERED_WORDS:
                known.clear()
            counts = [known[word] for word in (text or "").encode().split()]
            missed = counts.count(0)
            words.append(len(counts))
            tokens.append(sum(counts) + missed)
            unknown.append(missed)
        return [doc_id, words, tokens, unknown]

    schema = "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown_words bigint"
    return per_batch(docs, ["doc_id", "text"], step, schema)


def op7_word_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece token counts of all documents."""
    return token_counts(documents(spark, sf_dir))
