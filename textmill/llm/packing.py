"""Shortest-pack-first packing of documents into sequences, over the histogram of lengths.

1. Each text is tokenized once; a document's ids with the closing id are cut into pieces of at most one sequence. A piece
   gets a rank among the pieces of its length inside its task; the pieces are written without another move.
2. Only the histogram (one count per length, so at most ``max_tokens`` numbers) comes to the driver. Lengths are placed
   longest first, each into the shortest pack that still has room for it. Packs with the same content are one pattern
   with a count, so the work depends on the number of lengths and not on the number of documents.
3. Each place of a pattern takes a run of ranks of its length. The table of runs is bounded by the number of lengths, so
   it is broadcast; every piece finds its sequence and offset by its length and rank.

Tokens come from the tokenizers library. Since its normaliser and splitter work inside runs of non-space characters,
the ids of such a run are remembered, and runs of plain letters, digits and signs are split here and handed to the
library's merge model one word at a time; everything else goes through the whole library pipeline.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from tokenizers import Tokenizer

from textmill.llm.common import Remembered, batches_of, one_text, table
from textmill.staging import stage

TOKENIZER_FILE = public_tokenizers.path("word_bpe_49k.json")
MAX_TOKENS = 2048
CLOSING_ID = 1
#: Entries of each generation of a worker's memory of words; old ones are forgotten and computed again when needed.
REMEMBERED = 170_000

_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[!-&(-~{_LATIN}]+")
_WORDS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Letter that stands for each byte in a byte-level vocabulary: itself if visible, else the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in visible else chr(next(rest)) for b in range(256)}


class WordTokenizer:
    """Token ids of texts as little-endian unsigned 32-bit numbers, equal to those of the tokenizer file.

    Special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.words = Remembered(self._word, remembered)
        self.runs = Remembered(self._run, remembered)

    def _word(self, word: str) -> bytes:
        spelled = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        return np.array([t.id for t in self.model.tokenize(spelled)], dtype="<u4").tobytes()

    def _run(self, raw: bytes) -> bytes:
        run = raw.decode()
        if _PLAIN.fullmatch(run):
            return b"".join([self.words[w] for w in _WORDS.findall(run.lower())])
        return np.array(self.whole.encode(run, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        ids = b"".join(map(self.runs.__getitem__, text.encode().split()))
        self.runs.trim()
        self.words.trim()
        return ids


@lru_cache(maxsize=2)
def load_tokenizer(path: str = TOKENIZER_FILE) -> WordTokenizer:
    return WordTokenizer(path)


def cut_pieces(
    df: DataFrame, id_column: str, text: str, max_tokens: int = MAX_TOKENS, closing_id: int = CLOSING_ID,
    tokenizer_file: str = TOKENIZER_FILE, keep_ids: bool = False,
) -> DataFrame:
    """Pieces of every document: id, start, length, ids_crc32, doc_tokens, token_ids (binary; null unless asked for),
    and ``__task``, ``__place``: rank of the piece among those of its length in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = load_tokenizer(tokenizer_file), TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, dtype=np.int64)
        closing = np.array([closing_id], dtype="<u4").tobytes()
        for batch in batches:
            for part in batches_of(batch):
                rows, starts, lengths, sums, totals, kept, places = [], [], [], [], [], [], []
                for row, value in enumerate(part.column(1).to_pylist()):
                    ids = tokenizer.encode(value) + closing
                    total = len(ids) // 4
                    for start in range(0, total, max_tokens):
                        piece = ids[4 * start : 4 * (start + max_tokens)]
                        length = len(piece) // 4
                        rows.append(row)
                        starts.append(start)
                        lengths.append(length)
                        sums.append(zlib.crc32(piece))
                        totals.append(total)
                        kept.append(piece if keep_ids else None)
                        places.append(int(seen[length]))
                        seen[length] += 1
                longs = [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]
                tasks = pa.array([task] * len(rows), pa.int32())
                yield pa.record_batch(
                    [part.column(0).take(pa.array(rows, pa.int64())), *longs, pa.array(kept, pa.binary()), tasks, pa.array(places, pa.int64())],
                    [id_column, "start", "length", "ids_crc32", "doc_tokens", "token_ids", "__task", "__place"],
                )

    chosen = df.select(F.col(id_column), one_text(text).alias("text"))
    kind = chosen.schema[0].dataType.simpleString()
    return chosen.mapInArrow(
        run,
        f"`{id_column}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, token_ids binary, __task int, __place bigint",
    )


def shortest_pack_first(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (count, lengths in the order of placing) that hold ``histogram[length]`` pieces of each length."""
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}  # open patterns by the room they leave
    for length in sorted(histogram, reverse=True):
        left, free = histogram[length], max_tokens
        while left:
            while free >= length and not room.get(free):
                free -= 1
            if free < length:  # no pack has room: new packs take as many pieces of this length as fit
                each = max_tokens // length
                for count, pieces in ((left // each, each), (1, left % each)):
                    if count and pieces:
                        room.setdefault(max_tokens - pieces * length, []).append((count, (length,) * pieces))
                break
            count, pattern = room[free].pop()  # the shortest pack has the most room
            taken = min(count, left)
            if taken < count:
                room[free].append((count - taken, pattern))
            room.setdefault(free - length, []).append((taken, (*pattern, length)))
            left -= taken
    return [x for free in sorted(room) for x in room[free]]


def place_runs(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end of ranks, first sequence, offset) for every place of every pattern."""
    runs, used, sequence = [], {}, 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            first = used.get(length, 0)
            runs.append((length, first, first + count, sequence, offset))
            used[length] = first + count
            offset += length
        sequence += count
    return runs


def pack(
    df: DataFrame, id_column: str, text: str, max_tokens: int = MAX_TOKENS, closing_id: int = CLOSING_ID,
    tokenizer_file: str = TOKENIZER_FILE, keep_ids: bool = True,
) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``; the pieces of a sequence lie gapless from offset 0.

    A null or empty text is one piece that holds the closing id. Repeated rows are documents of their own; null ids stay
    null. Ties (pieces of one length) are placed by task and place in the task. An empty table gives no rows.
    """
    if max_tokens < 1:
        raise ValueError("max_tokens must be at least 1")
    pieces = stage(cut_pieces(df, id_column, text, max_tokens, closing_id, tokenizer_file, keep_ids), "pieces")
    counts = stage(pieces.groupBy("length", "__task").agg(F.count("*").alias("__n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    runs = pieces.sparkSession.createDataFrame(
        place_runs(shortest_pack_first(histogram, max_tokens)),
        "__length long, __first long, __end long, __sequence long, offset long",
    )
    before = W.partitionBy("length").orderBy("__task").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("length", "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    ranked = pieces.join(offsets, ["length", "__task"]).withColumn("__rank", F.col("__before") + F.col("__place"))
    fits = (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__first")) & (F.col("__rank") < F.col("__end"))
    # the runs are bounded by the lengths of pieces, whatever the number of documents
    placed = ranked.join(F.broadcast(runs), fits)
    return placed.select(
        id_column, "start", "length", "ids_crc32", "doc_tokens",
        (F.col("__sequence") + F.col("__rank") - F.col("__first")).alias("sequence_id"), "offset",
        *(["token_ids"] if keep_ids else []),
    )


def document_sequences(spark: SparkSession, sf: str, tokenizer_file: str = TOKENIZER_FILE) -> DataFrame:
    return pack(table(spark, sf, "documents"), "doc_id", "text", tokenizer_file=tokenizer_file, keep_ids=False)
