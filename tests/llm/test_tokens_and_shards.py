"""Sharding, byte-level BPE and packing against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textmill.llm import byte_bpe, packing, sharding


def text_of(x):
    return x or ""


# -- sharding ------------------------------------------------------------------------------------------------------------


def place(df, shards=8):
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    return sharding.shard_by_bytes(df, shards, size, [F.xxhash64("text"), F.col("doc_id")])


def test_shards_of_documents(spark, sf):
    rows = sharding.document_shards(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    total = sum(r["size"] for r in rows)
    by_shard = defaultdict(list)
    for r in rows:
        raw = text_of(texts[r.doc_id]).encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        by_shard[r.shard].append(r)
    assert sorted(by_shard) == list(range(8))
    largest = max(r["size"] for r in rows)
    for of_shard in by_shard.values():
        assert sorted(r.slot for r in of_shard) == list(range(len(of_shard)))
        assert abs(sum(r["size"] for r in of_shard) - total / 8) <= largest


def test_shards_follow_the_order(spark):
    sizes = [random.Random(3).randint(1, 50) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, bytes long").repartition(7)
    rows = sorted(sharding.shard_by_bytes(df, 5, F.col("bytes"), [F.col("id")]).collect(), key=lambda r: r.id)
    before, total, slots = 0, sum(sizes), Counter()
    for r in rows:
        shard = (2 * before + r.bytes) * 5 // (2 * total)
        assert (r.shard, r.slot) == (shard, slots[shard])
        slots[shard] += 1
        before += r.bytes


def test_shards_of_odd_rows(odd_documents, no_documents, tmp_path):
    placed = place(odd_documents, 3)
    assert placed.columns == [c for c in odd_documents.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    rows = placed.collect()
    assert len(rows) == odd_documents.count() and all(r.shard in (0, 1, 2) for r in rows)
    assert place(no_documents).collect() == []
    sharding.write_shards(placed, f"{tmp_path}/shards")
    back = odd_documents.sparkSession.read.parquet(f"{tmp_path}/shards")
    assert back.count() == len(rows)
    one = place(odd_documents.limit(1), 4).collect()
    assert len(one) == 1 and one[0].slot == 0
    with pytest.raises(ValueError):
        place(odd_documents, 0)


# -- byte-level BPE ------------------------------------------------------------------------------------------------------


def check_round_trip(df):
    encoding = byte_bpe.load_encoding()
    got = Counter(map(tuple, byte_bpe.round_trip(df, "doc_id", "text").collect()))
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = encoding.encode_ordinary(text_of(r.text))
        raw = text_of(r.text).encode()
        want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest())] += 1
    assert got == want


def test_round_trip(spark, sf, odd_documents, no_documents):
    check_round_trip(spark.read.parquet(f"{sf}/documents.parquet"))
    check_round_trip(odd_documents)
    check_round_trip(no_documents)


def test_encode_and_decode_frames(odd_documents):
    ids = byte_bpe.encode(odd_documents, "doc_id", "text")
    raw = byte_bpe.decode(ids, "doc_id", "token_ids").collect()
    assert Counter((r.doc_id, bytes(r.raw)) for r in raw) == Counter((r.doc_id, text_of(r.text).encode()) for r in odd_documents.collect())


def test_cuts_are_safe():
    rng, encoding = random.Random(5), byte_bpe.load_encoding()
    parts = [" ", "  ", "\n", "\r\n", "\t", "'s", "'", "don't", "é", "ß", "9", "12", "a", "Zed", "-", "...", "漢", "́", " ", " ", "\x1c", "'S1", "x's9"]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=80))
        assert "".join(byte_bpe.safe_pieces(text, 5)) == text
        assert byte_bpe.encode_text(text, encoding, 5) == encoding.encode_ordinary(text)
    assert len(list(byte_bpe.safe_pieces("word " * 1000, 50))) > 50


# -- packing -------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def check_packing(df, library, max_tokens=2048):
    rows = packing.pack(df, "doc_id", "text", max_tokens, keep_ids=True).collect()
    encoded = [(r.doc_id, library.encode(text_of(r.text), add_special_tokens=False).ids + [1]) for r in df.collect()]
    want = Counter()
    for doc_id, ids in encoded:
        for start in range(0, len(ids), max_tokens):
            piece = np.array(ids[start : start + max_tokens], dtype="<u4").tobytes()
            want[(doc_id, start, len(piece) // 4, zlib.crc32(piece), len(ids), piece)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.token_ids)) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for content in sequences.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= max_tokens
    return len(sequences) * max_tokens / max(1, sum(len(ids) for _, ids in encoded))


def test_packing(spark, sf, odd_documents, no_documents, library):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    assert check_packing(documents, library) < 1.02
    check_packing(documents, library, 64)
    check_packing(odd_documents, library)
    check_packing(odd_documents, library, 1)
    check_packing(no_documents, library)


def test_word_tokenizer_is_the_library(library):
    rng, own = random.Random(7), packing.WordTokenizer(packing.TOKENIZER_FILE, 20)
    letters = "aBzéÉßÿÀ'’.,!?-_09 \n\tµªº×÷İıſKΣςςДđ漢ȩ́  \x1c\x85<|>"
    for _ in range(2_000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 25))) + rng.choice(["", "don't", "<|endoftext|>", "I'LL"])
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_shortest_pack_first():
    rng = random.Random(9)
    for _ in range(50):
        histogram = {rng.randint(1, 100): rng.randint(1, 40) for _ in range(rng.randint(0, 12))}
        patterns = packing.shortest_pack_first(histogram, 100)
        held = Counter()
        for count, lengths in patterns:
            assert sum(lengths) <= 100
            for x in lengths:
                held[x] += count
        assert held == Counter(histogram)
    # longest first, each into the shortest pack with room
    assert sorted(packing.shortest_pack_first({6: 1, 5: 1, 3: 1, 2: 1}, 10)) == [(1, (5, 3)), (1, (6, 2))]
    assert sorted(packing.shortest_pack_first({2: 11}, 10)) == [(1, (2,)), (2, (2, 2, 2, 2, 2))]
