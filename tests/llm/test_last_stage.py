"""The packed sequences of the pipeline can be built from its rows."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def test_last_stage_rebuilds_the_sequences(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).unionByName(spark.createDataFrame([(-1, None)], "doc_id long, text string"), allowMissingColumns=True)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    sequences = defaultdict(lambda: np.full(2048, -1, dtype=np.int64))
    for r in rows:
        ids = np.frombuffer(bytes(r.token_ids), dtype="<u4")
        place = sequences[r.sequence_id][r.offset : r.offset + r.length]
        assert len(ids) == r.length == len(place) and (place == -1).all()
        place[:] = ids
    for content in sequences.values():
        used = content >= 0
        assert used[: used.sum()].all()
    for doc in docs.collect():
        pieces = sorted((r for r in rows if r.doc_id == doc.doc_id), key=lambda r: r.start)
        back = np.concatenate([sequences[r.sequence_id][r.offset : r.offset + r.length] for r in pieces]).tolist()
        assert back == tokenizer.encode(doc.text or "", add_special_tokens=False).ids + [1]


def test_near_duplicates_keep_any_column(spark, tmp_path):
    rows = [(1, "a b c d", 7, "p"), (2, "a b c d", 8, "q"), (3, "other words here", 9, "r"), (3, "other words here", 9, "r"), (None, "x y z", 1, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int, __dropped_id string")
    kept = corpus_pipeline.STAGES[1][1](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r["__id"]) for r in kept.collect()) == [(0, 1), (1, 7), (3, 9)]
