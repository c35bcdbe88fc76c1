"""Queries of this subpackage, and the SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import bitslice, byte_bpe, collocations, crosspolytope, merkle, packing, sharding, simhash, surrogates, toxicity, url_lists, warc, wordpiece

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": sharding.document_shards,
    "op2_topk_search": bitslice.embedding_top,
    "op3_toxicity": toxicity.document_toxicity,
    "op4_surrogates": surrogates.document_surrogates,
    "op5_simhash": simhash.document_duplicates,
    "op6_packing": packing.document_sequences,
    "op7_token_counts": wordpiece.document_tokens,
    "op8_url_lists": url_lists.page_verdicts,
    "op9_neighbours": crosspolytope.embedding_neighbours,
    "op10_byte_bpe": byte_bpe.document_round_trip,
    "op11_manifest": merkle.document_manifest,
    "op12_warc": warc.page_archives,
    "op13_collocations": collocations.document_phrases,
}

SQL: dict[str, str] = {
    "op2_topk_search": bitslice.EMBEDDING_TOP_SQL,
    "op8_url_lists": url_lists.PAGE_VERDICTS_SQL,
    "op12_warc": warc.PAGE_ARCHIVES_SQL,
    "op13_collocations": collocations.DOCUMENT_PHRASES_SQL,
}
