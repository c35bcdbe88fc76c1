"""Byte-level BPE encoding and decoding with a local rank file.

The tiktoken library encodes; this module reads the ranks, cuts very long texts into runs of whole matches and decodes ids
to raw bytes. The rank file's place is a parameter and must be readable at that place on every worker.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import map_batches, one_text, table

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters after which a text is cut at the next safe boundary.
STEP_CHARS = 50_000
# No match of the pattern holds white space after another character, so a match always ends in front of white space
# that follows a letter or digit. It also ends between an ASCII letter and an ASCII digit.
_SAFE = regex.compile(r"(?<=[\p{L}\p{N}])(?=[ \n\t\r])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


@lru_cache(maxsize=4)
def load_encoding(rank_file: str = RANK_FILE, pattern: str = PATTERN) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _decimal(rank_file: str, pattern: str) -> list[str]:
    return [str(i) for i in range(load_encoding(rank_file, pattern).max_token_value + 1)]


def safe_pieces(text: str, step: int = STEP_CHARS) -> Iterator[str]:
    """The text in pieces of about ``step`` characters; no match of the pattern crosses a cut.

    A piece grows beyond ``step`` where the text has no safe boundary.
    """
    start = 0
    while len(text) - start > step:
        cut = _SAFE.search(text, start + step)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str, encoding: tiktoken.Encoding, step: int = STEP_CHARS) -> list[int]:
    if len(text) <= step:
        return encoding.encode_ordinary(text)
    return [i for piece in safe_pieces(text, step) for i in encoding.encode_ordinary(piece)]


def encode(df: DataFrame, id_column: str, text: str, rank_file: str = RANK_FILE, pattern: str = PATTERN) -> DataFrame:
    """``id_column`` and ``token_ids`` (array of int) of every row, repeated rows and null ids included.

    A null text counts as empty and gives an empty array. Special tokens in a text are ordinary text.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding = load_encoding(rank_file, pattern)
        ids = [encode_text(x, encoding) for x in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_column, "token_ids"])

    chosen = df.select(F.col(id_column), one_text(text).alias("text"))
    return map_batches(chosen, step, f"`{id_column}` {chosen.schema[0].dataType.simpleString()}, token_ids array<int>")


def decode(df: DataFrame, id_column: str, token_ids: str, rank_file: str = RANK_FILE, pattern: str = PATTERN) -> DataFrame:
    """``id_column`` and ``raw`` (binary): the joined bytes of the ids, which need not be valid UTF-8. Null ids give null."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding = load_encoding(rank_file, pattern)
        raw = [None if x is None else encoding.decode_bytes(x) for x in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(raw, pa.binary())], [id_column, "raw"])

    chosen = df.select(F.col(id_column), F.col(token_ids).alias("token_ids"))
    return map_batches(chosen, step, f"`{id_column}` {chosen.schema[0].dataType.simpleString()}, raw binary")


def round_trip(df: DataFrame, id_column: str, text: str, rank_file: str = RANK_FILE, pattern: str = PATTERN) -> DataFrame:
    """Digests of encoding and decoding in one pass: number of ids, SHA-256 of the ids and of the decoded bytes."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding, decimal = load_encoding(rank_file, pattern), _decimal(rank_file, pattern)
        counts, of_ids, of_bytes = [], [], []
        for value in batch.column(1).to_pylist():
            ids = encode_text(value, encoding)
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
            of_bytes.append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
        return pa.record_batch(columns, [id_column, "n_tokens", "ids_sha256", "decoded_sha256"])

    chosen = df.select(F.col(id_column), one_text(text).alias("text"))
    kind = chosen.schema[0].dataType.simpleString()
    return map_batches(chosen, step, f"`{id_column}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def document_round_trip(spark: SparkSession, sf: str, rank_file: str = RANK_FILE) -> DataFrame:
    return round_trip(table(spark, sf, "documents"), "doc_id", "text", rank_file)
