"""Word-piece token counts by the linear longest-match automaton.

The vocabulary becomes a trie whose nodes know where to go on when no child matches (failure link) and how many pieces are
complete at that point (popped tokens). Only the number of popped tokens is kept, so a word is counted in one pass over its
characters, and no piece is ever built. Runs of characters that return are counted once per worker.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import Remembered, map_batches, one_text, table

VOCABULARY_FILE = public_tokenizers.path("word_bpe_49k.json")
PREFIX = "##"
_SIGNS = r"!-/:-@\[-`{-~\p{P}"
_WORD = regex.compile(rf"[{_SIGNS}]|[^\p{{White_Space}}{_SIGNS}]+")


class PieceCounter:
    """Automaton over a vocabulary of word starts ("ab") and continuations ("##ab")."""

    def __init__(self, vocabulary: Iterable[str]):
        self.child: dict[tuple[int, str], int] = {}
        self.start, self.rest = 0, 1  # in front of a word; behind a complete piece
        whole, edges = {self.start: False, self.rest: False}, {self.start: [], self.rest: []}
        for piece in vocabulary:
            node, letters = (self.rest, piece[len(PREFIX) :]) if piece.startswith(PREFIX) and len(piece) > len(PREFIX) else (self.start, piece)
            for letter in letters:
                following = self.child.get((node, letter))
                if following is None:
                    following = self.child[node, letter] = len(whole)
                    whole[following], edges[following] = False, []
                    edges[node].append((letter, following))
                node = following
            if letters:
                whole[node] = True
        self.fail: list[int | None] = [None] * len(whole)
        self.popped = [0] * len(whole)
        queue = deque([self.start, self.rest])
        while queue:
            node = queue.popleft()
            for letter, following in edges[node]:
                queue.append(following)
                if whole[following]:
                    self.fail[following], self.popped[following] = self.rest, 1
                    continue
                count, other = self.popped[node], self.fail[node]
                while other is not None and (other, letter) not in self.child:
                    count, other = count + self.popped[other], self.fail[other]
                if other is not None:
                    self.fail[following], self.popped[following] = self.child[other, letter], count

    def count(self, word: str) -> int | None:
        """Number of greedy pieces of a word; None if the word cannot be written in pieces."""
        child, fail, popped = self.child, self.fail, self.popped
        node, pieces = self.start, 0
        for letter in word:
            following = child.get((node, letter))
            while following is None:
                if fail[node] is None:
                    return None
                pieces += popped[node]
                node = fail[node]
                following = child.get((node, letter))
            node = following
        while node != self.rest:
            if fail[node] is None:
                return None
            pieces += popped[node]
            node = fail[node]
        return pieces


def piece_vocabulary(path: str = VOCABULARY_FILE) -> list[str]:
    """Word starts and continuations from a byte-level vocabulary file: each entry, without its word end, is both.

    Entries that are no whole characters are left out.
    """
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)["model"]["vocab"]
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    byte_of = {chr(b) if b in visible else chr(next(hidden)): b for b in range(256)}
    pieces = set()
    for entry in entries:
        raw = bytes(byte_of[c] for c in entry.removesuffix("</w>"))
        try:
            pieces.add(raw.decode())
        except UnicodeDecodeError:
            continue
    starts = sorted(p for p in pieces if p)
    return starts + [PREFIX + p for p in starts]


@lru_cache(maxsize=2)
def load_counter(path: str = VOCABULARY_FILE) -> tuple[PieceCounter, Remembered]:
    counter = PieceCounter(piece_vocabulary(path))

    def of_run(raw: bytes) -> int:
        """Tokens, unknown words and words of a run, in one number."""
        total = 0
        for word in _WORD.findall(raw.decode().lower()):
            pieces = counter.count(word)
            total += (1 + (1 << _UNKNOWN) if pieces is None else pieces) + (1 << _WORDS)
        return total

    return counter, Remembered(of_run, 250_000)


_UNKNOWN, _WORDS = 48, 96
_PART = (1 << _UNKNOWN) - 1


def count_tokens(df: DataFrame, id_column: str, text: str, vocabulary_file: str = VOCABULARY_FILE) -> DataFrame:
    """``id_column``, ``n_tokens``, ``n_words``, ``n_unknown`` of every row.

    Words are runs without white space and signs, and single signs, in lower case. A word that cannot be written in pieces
    is one unknown token. Null and empty texts have 0 tokens. Repeated rows and null ids are kept.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, runs = load_counter(vocabulary_file)
        totals = []
        for value in batch.column(1).to_pylist():
            totals.append(sum(map(runs.__getitem__, value.encode().split())))
            runs.trim()
        parts = [[t & _PART for t in totals], [t >> _WORDS for t in totals], [t >> _UNKNOWN & _PART for t in totals]]
        return pa.record_batch([batch.column(0), *[pa.array(p, pa.int64()) for p in parts]], [id_column, "n_tokens", "n_words", "n_unknown"])

    chosen = df.select(F.col(id_column), one_text(text).alias("text"))
    return map_batches(chosen, step, f"`{id_column}` {chosen.schema[0].dataType.simpleString()}, n_tokens bigint, n_words bigint, n_unknown bigint")


def document_tokens(spark: SparkSession, sf: str, vocabulary_file: str = VOCABULARY_FILE) -> DataFrame:
    return count_tokens(table(spark, sf, "documents"), "doc_id", "text", vocabulary_file)
