"""Bag-of-words features in long form: (id, term, tf) -> vocabulary -> TF-IDF -> normalised rows.

Everything is keyed so that a document is never split over tasks needlessly: the text is moved once by id before the
tokens are exploded; counting, normalising and scoring then need no further shuffle when the vocabulary is small enough
to be broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.group_ops import PandasCogroupedOps
from pyspark.sql.pandas.types import to_arrow_type

from textmill.errors import InvalidPoint
from textmill.functions.text import ngrams, tokenise
from textmill.operators.ranking import global_rank
from textmill.staging import bucket_of, scalar_of, stage, stage_buckets

MAX_FEATURES = 10_000
#: Documents that are weighed together, with one copy of what they need of a vocabulary.
BLOCK_DOCS = 5_000
#: Documents and bytes of text of a block that stays where it was written.
BUCKET_DOCS, BUCKET_BYTES = 20_000, 1 << 27
#: Rows of a batch that leaves a block.
OUT_ROWS = 1 << 17
#: Products of entries and weights, or sums, that are held at once.
PRODUCTS = 1 << 22
#: A vocabulary up to this size is given to every block as it is.
WHOLE_TERMS = 20_000


def explode_tokens(
    df: DataFrame,
    text: str,
    key: str = "id",
    keep: Sequence[str] = (),
    tokenizer: str | Callable[[Column], Column] = "space",
    ngram_range: tuple[int, int] = (1, 1),
) -> DataFrame:
    """(key, keep..., term): one row per token; a text without tokens gives one row with a null term.

    The text is moved once by key, before it grows into tokens. The number of partitions is given, since merging them by
    the size of the text would leave too few tasks for the tokens.
    """
    tokens = ngrams(tokenise(F.col(text), tokenizer), *ngram_range)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_key = df.select(key, *keep, text).repartition(partitions, key)
    return by_key.select(key, *keep, F.explode_outer(tokens).alias("term"))


def term_counts(tokens: DataFrame, key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., term, tf). Documents without tokens stay as one row with a null term."""
    return tokens.groupBy(key, *keep, "term").agg(F.count("*").alias("tf"))


def _columns(df: DataFrame, *left_out: str) -> str:
    """The columns of ``df`` as text of a schema."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in left_out)


def _entries_of(tokens: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Distinct tokens of each list and how often each is there; nulls are left out."""
    rows = np.repeat(np.arange(len(tokens)), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
    coded = tokens.flatten().dictionary_encode()
    known = coded.indices.is_valid().to_numpy(zero_copy_only=False)
    codes, width = pc.fill_null(coded.indices, 0).to_numpy().astype(np.int64)[known], max(len(coded.dictionary), 1)
    cells, tf = np.unique(rows[known] * width + codes, return_counts=True)
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(cells // width, minlength=len(tokens)))]), pa.int32())
    return pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(cells % width))), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))


def planes(numbers: np.ndarray) -> bytes:
    """Four bytes a number, the bytes of one place together, which compresses well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def numbers(planes: Sequence[bytes]) -> np.ndarray:
    parts = [np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(4, -1).T).view("<u4").ravel() for p in planes]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def count_packed(
    df: DataFrame,
    text: str,
    key: str = "id",
    keep: Sequence[str] = (),
    tokenizer: str | Callable[[Column], Column] = "space",
    ngram_range: tuple[int, int] = (1, 1),
    apart: bool = False,
) -> DataFrame:
    """(key, keep..., terms, tfs): the term counts of :func:`term_counts` with one row per document, as two arrays.

    Texts are moved once by key; the texts of one (key, keep...) are counted together. Tokens are counted where they lie and never
    become rows. ``apart`` counts every text for itself and moves none, unless there are fewer partitions than task slots.
    """
    if apart:
        slots = df.sparkSession.sparkContext.defaultParallelism
        texts = df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)
        tokens = texts.select(key, *keep, ngrams(tokenise(F.col(text), tokenizer), *ngram_range).alias("_tokens"))
    else:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by_key = df.select(key, *keep, text).repartition(partitions, key)
        texts = by_key.groupBy(key, *keep).agg(F.collect_list(text).alias("_texts"))
        tokens = texts.select(key, *keep, F.flatten(F.transform("_texts", lambda t: ngrams(tokenise(t, tokenizer), *ngram_range))).alias("_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*batch.columns[:-1], *_entries_of(batch.columns[-1])], [*batch.schema.names[:-1], "terms", "tfs"])

    return tokens.mapInArrow(run, f"{_columns(tokens, '_tokens')}, terms array<string>, tfs array<bigint>")


def bucketed_counts(
    df: DataFrame, text: str, key: str = "id", tokenizer: str | Callable[[Column], Column] = "space", ngram_range: tuple[int, int] = (1, 1)
) -> tuple[DataFrame, int]:
    """(_block, key, terms, tfs), one row per key, written once in blocks of documents by key, and the number of blocks.

    The text is moved once, to its block. What is known of a block's terms is brought to the block afterwards; its documents stay.
    """
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    blocks = max(df.sparkSession.sparkContext.defaultParallelism, -(-n // BUCKET_DOCS), -(-size * ngram_range[1] // BUCKET_BYTES))
    block = bucket_of(df, key, blocks).alias("_block")
    texts = df.select(block, key, text).repartition(blocks, "_block").groupBy("_block", key).agg(F.collect_list(text).alias("_texts"))
    tokens = texts.select("_block", key, F.flatten(F.transform("_texts", lambda t: ngrams(tokenise(t, tokenizer), *ngram_range))).alias("_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*batch.columns[:-1], *_entries_of(batch.columns[-1])], ["_block", key, "terms", "tfs"])

    return stage_buckets(tokens.mapInArrow(run, f"{_columns(tokens, '_tokens')}, terms array<string>, tfs array<bigint>"), "_block", blocks, "bucketed-counts", dealt=True), blocks


def packed(counts: DataFrame) -> DataFrame:
    """Term counts in the form of :func:`count_packed`; long ones (..., term, tf) are packed and written once."""
    if "terms" in counts.columns:
        return counts
    others = [f"`{c}`" for c in counts.columns if c not in ("term", "tf")]
    entry = F.when(F.col("term").isNotNull(), F.struct("term", F.col("tf").cast("bigint").alias("tf")))
    rows = counts.groupBy(*others).agg(F.collect_list(entry).alias("_e"))
    return stage(rows.select(*others, F.col("_e.term").alias("terms"), F.col("_e.tf").alias("tfs")), "packed-counts")


def unpacked(counts: DataFrame) -> DataFrame:
    """Term counts in long form (..., term, tf), without rows for documents that have no terms."""
    if "terms" not in counts.columns:
        return counts
    others = [f"`{c}`" for c in counts.columns if c not in ("terms", "tfs")]
    entry = F.explode(F.arrays_zip("terms", "tfs")).alias("_e")
    return counts.select(*others, entry).select(*others, F.col("_e.terms").alias("term"), F.col("_e.tfs").alias("tf"))


def _located(known: pa.Table, lists: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, place in ``known`` and frequency of the entries whose term is known, in the order of the documents."""
    words, sizes, tfs = lists
    rows = np.repeat(np.arange(len(words)), pc.list_value_length(sizes).to_numpy(zero_copy_only=False))
    place = pc.index_in(_terms_of(lists), value_set=known["term"].combine_chunks().cast(pa.large_string()))
    at = place.is_valid().to_numpy(zero_copy_only=False)
    return rows[at], pc.fill_null(place, 0).to_numpy()[at], tfs.flatten().to_numpy()[at]


def _terms_of(lists: Sequence[pa.Array]) -> pa.Array:
    """The terms of documents whose words travelled as one string and their lengths."""
    words, sizes, _ = lists
    ends = np.concatenate([[0], np.cumsum(sizes.flatten().to_numpy(), dtype=np.int64)])
    return pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(w.as_buffer() for w in words))])


def _sizes_of(rows: np.ndarray, value: np.ndarray, n: int, codes: np.ndarray | None) -> list[np.ndarray]:
    """Sum of squares and of absolute values per document; those of equal ``codes`` are added."""
    # without rows bincount gives integers
    found = [np.bincount(rows, weights=x, minlength=n).astype(np.float64) for x in (value * value, np.abs(value))]
    return found if codes is None else [np.bincount(codes, weights=x)[codes] for x in found]


def _key_codes(docs: pa.Table, key: str) -> np.ndarray:
    coded = docs[key].combine_chunks().dictionary_encode()
    return pc.fill_null(coded.indices, len(coded.dictionary)).to_numpy()


def _row_sums(known: pa.Table, lists: Sequence[pa.Array], weights: int, codes: np.ndarray | None) -> list[pa.Array]:
    """Per document the weighted sums, the sum of squares and that of absolute values; sums of squares and values of equal ``codes`` are added."""
    n = len(lists[0])
    if not n:
        return [pa.array([], kind) for kind in (pa.list_(pa.float64()), pa.float64(), pa.float64())]
    rows, place, tf = _located(known, lists)
    value = tf * known["idf"].to_numpy()[place]
    squares, absolute = _sizes_of(rows, value, n, codes)
    sums = np.zeros((n, weights))
    if weights and len(rows):
        matrix = known["weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, weights)
        # the entries of a document lie together; a bounded number of products is held at once
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        cuts = np.append(first[np.unique(np.searchsorted(first, np.arange(0, len(rows), max(1, PRODUCTS // weights)), "right") - 1)], len(rows))
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            starts = first[np.searchsorted(first, begin) : np.searchsorted(first, end)]
            sums[rows[starts]] = np.add.reduceat(matrix[place[begin:end]] * value[begin:end, None], starts - begin)
    every = pa.array(np.arange(n + 1) * weights, pa.int32())
    return [pa.ListArray.from_arrays(every, pa.array(sums.ravel())), pa.array(squares), pa.array(absolute)]


def _in_blocks(counts: DataFrame, table: DataFrame, key: str, columns: Sequence[str]) -> tuple[list[str], PandasCogroupedOps]:
    """The columns that packed counts keep, and blocks of documents beside the rows of ``table`` for their terms."""
    n = counts.select(F.count("*")).first()[0]
    parts = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), counts.sparkSession.sparkContext.defaultParallelism)
    blocks = max(parts, -(-n // BLOCK_DOCS))
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("_block")
    if table.select(F.count("*")).first()[0] <= WHOLE_TERMS:
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")
        known = table.select(every, *columns)
    else:
        asked = counts.select(block, F.explode("terms").alias("term")).distinct()
        known = asked.join(table.select(*columns), "term").select("_block", *columns)
    held = [c for c in counts.columns if not (c == "tfs" or c == "terms")]
    # the words of a document travel as one string and their lengths
    words = [F.array_join("terms", "").cast("binary").alias("_words"), F.transform("terms", lambda t: F.octet_length(t)).alias("_sizes"), "tfs"]
    docs = counts.select(block, *[f"`{c}`" for c in held], *words)
    return held, docs.repartition(parts, "_block").groupBy("_block").cogroup(known.repartition(parts, "_block").groupBy("_block"))


def weigh(counts: DataFrame, table: DataFrame, key: str = "id", weights: int = 0, by_key: bool = False) -> DataFrame:
    """Packed counts with ``sums`` array<double>, ``squares`` and ``absolute`` over the values tf * idf of the known terms.

    ``table`` is (term, idf) or, with the number of ``weights``, (term, idf, weights); sums holds one weighted sum per weight. With
    ``by_key`` squares and absolute are those of all rows of the key.

    A vocabulary of any size never meets the single entries of the documents in a join: documents lie in blocks by key, a block
    asks once for each of its terms (a short vocabulary goes to all blocks), and what it asks for is joined with its documents. So frequent terms are no hot keys, and what is
    moved are the documents once and the distinct terms per block.
    """
    held, blocks = _in_blocks(counts, table, key, ["term", "idf", *(["weights"] if weights else [])])

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        lists = [docs[c].combine_chunks() for c in ("_words", "_sizes", "tfs")]
        extra = _row_sums(known, lists, weights, _key_codes(docs, key) if by_key else None)
        sized = pc.list_value_length(lists[1]).to_numpy(zero_copy_only=False).astype(np.int64)
        back = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sized)]), pa.int32()), _terms_of(lists).cast(pa.string())), lists[2]] if by_key else []
        return pa.table([*[docs[c] for c in held], *back, *extra], [*held, *(["terms", "tfs"] if by_key else []), "sums", "squares", "absolute"])

    schema = f"{_columns(counts, 'terms', 'tfs')}, {'terms array<string>, tfs array<bigint>, ' if by_key else ''}sums array<double>, squares double, absolute double"
    return blocks.applyInArrow(run, schema)


def normalised_sums(counts: DataFrame, table: DataFrame, by: Sequence[str], norm: str, key: str = "id") -> DataFrame:
    """(term, by..., value): tf * idf of packed counts divided by the l1 or l2 norm over all rows of the key, summed over equal ``by``.

    ``table`` is (term, idf). The sums of a block of documents are formed where :func:`weigh` finds the norms, so only one row per
    (term, by...) leaves it.
    """
    _, blocks = _in_blocks(counts.select(*dict.fromkeys([key, *by]), "terms", "tfs"), table, key, ["term", "idf"])
    names = ["term", *by, "value"]
    kinds = [pa.string(), *(to_arrow_type(counts.schema[c].dataType) for c in by), pa.float64()]

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        if not len(docs) or not len(known):
            return pa.table([pa.array([], kind) for kind in kinds], names)
        rows, place, tf = _located(known, [docs[c].combine_chunks() for c in ("_words", "_sizes", "tfs")])
        value = tf * known["idf"].to_numpy()[place]
        squares, absolute = _sizes_of(rows, value, len(docs), _key_codes(docs, key))
        size = absolute if norm == "l1" else np.sqrt(squares)
        value = value / np.where(size > 0, size, 1.0)[rows]
        # rows of equal ``by`` have one number, and an example each
        numbers: dict = {}
        group = np.array([numbers.setdefault(repr(x), len(numbers)) for x in zip(*(docs[c].to_pylist() for c in by), strict=True)])
        example = np.unique(group, return_index=True)[1]
        cell, width = place.astype(np.int64) * len(numbers) + group[rows], len(known) * len(numbers)
        if width <= PRODUCTS:
            sums, found = np.bincount(cell, weights=value, minlength=width), np.flatnonzero(np.bincount(cell, minlength=width))
            sums = sums[found]
        else:
            found, where = np.unique(cell, return_inverse=True)
            sums = np.bincount(where, weights=value, minlength=len(found))
        # taken from arrays in one piece: a take from many chunks is slow
        shown = [docs[c].combine_chunks().take(pa.array(example[found % len(numbers)])) for c in by]
        return pa.table([known["term"].combine_chunks().take(pa.array(found // len(numbers))), *shown, pa.array(sums, pa.float64())], names)

    columns = ", ".join(f"`{c}` {counts.schema[c].dataType.simpleString()}" for c in by)
    summed = blocks.applyInArrow(run, f"term string, {columns}, value double")
    return summed.groupBy("term", *by).agg(F.sum("value").alias("value"))


def resolve_df(value: float | int, n_docs: Column) -> Column:
    """Document-frequency bound as a count: a float is a share of all documents (1.0 = every document), an int a count."""
    return F.lit(value) * n_docs if isinstance(value, float) else F.lit(value) * 1.0


def idf_of(df: Column, n_docs: Column | int) -> Column:
    """ln((1 + N) / (1 + df)) + 1."""
    return F.log((1 + (F.lit(n_docs) if isinstance(n_docs, int) else n_docs)) / (1 + df)) + 1


def fit_vocab(
    counts: DataFrame,
    min_df: float | int = 1,
    max_df: float | int = 1.0,
    max_features: int | None = None,
    key: str = "id",
    n_docs: Column | None = None,
) -> DataFrame:
    """(term, df, cf, idf) of the terms whose document frequency is inside the bounds.

    ``min_df=1.0`` means one document, ``max_df=1.0`` every document. ``max_features`` keeps the most frequent terms of
    the corpus, ties in alphabetical order. idf = ln((1 + N) / (1 + df)) + 1.
    """
    n = n_docs if n_docs is not None else scalar_of(counts, F.count_distinct(key))
    per_term = counts.filter(F.col("term").isNotNull()).groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf")
    )
    return bound_vocab(per_term, n, min_df, max_df, max_features)


def df_bounds(min_df: float | int, max_df: float | int) -> tuple[float | int, float | int]:
    """The bounds of :func:`fit_vocab` with ``min_df=1.0`` as one document; bounds that leave no term are an invalid point."""
    if min_df == 1.0:
        min_df = 1
    if isinstance(min_df, float) and isinstance(max_df, float) and min_df > max_df:
        raise InvalidPoint(f"no term is in at least {min_df} and at most {max_df} of the documents")
    return min_df, max_df


def bound_vocab(per_term: DataFrame, n: Column, min_df: float | int, max_df: float | int, max_features: int | None) -> DataFrame:
    """Rows of (term, df, cf...) inside the bounds of :func:`fit_vocab`, with their idf."""
    min_df, max_df = df_bounds(min_df, max_df)
    kept = per_term.filter((F.col("df") >= resolve_df(min_df, n)) & (F.col("df") <= resolve_df(max_df, n)))
    if max_features:
        kept = kept.orderBy(F.desc("cf"), "term").limit(max_features)
    return kept.withColumn("idf", idf_of(F.col("df"), n))


def index_vocab(vocab: DataFrame) -> DataFrame:
    """Add ``idx``, the alphabetical position of a term; the vocabulary may be of any size."""
    return global_rank(vocab, ["term"], "idx")


def tfidf(counts: DataFrame, vocab: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Counts with ``value`` = tf * idf for known terms; ``keep_empty`` keeps unknown and null terms with a null value."""
    how = "left" if keep_empty else "inner"
    return counts.join(vocab.select("term", "idf"), "term", how).withColumn("value", F.col("tf") * F.col("idf"))


def normalise(values: DataFrame, norm: str | None = "l2", key: str = "id") -> DataFrame:
    """Scale ``value`` so that every document has unit l1 or l2 norm; None or 'None' leaves it unchanged."""
    if norm in (None, "None"):
        return values
    whole = W.partitionBy(key)
    if norm == "l1":
        size = F.sum(F.abs("value")).over(whole)
    elif norm == "l2":
        size = F.sqrt(F.sum(F.col("value") * F.col("value")).over(whole))
    else:
        raise ValueError(f"unknown norm {norm!r}")
    return values.withColumn("value", F.when(size > 0, F.col("value") / size).otherwise(F.col("value")))


def tfidf_vectorise(
    df: DataFrame,
    text: str,
    key: str = "id",
    tokenizer: str | Callable[[Column], Column] = "space",
    ngram_range: tuple[int, int] = (1, 1),
    min_df: float | int = 1,
    max_df: float | int = 1.0,
    max_features: int | None = None,
    norm: str | None = "l2",
) -> DataFrame:
    """Text to normalised TF-IDF rows (key, term, tf, value) in one call."""
    if norm not in (None, "None", "l1", "l2"):
        raise ValueError(f"unknown norm {norm!r}")
    rows, blocks = bucketed_counts(df, text, key, tokenizer, ngram_range)
    entries = rows.select("_block", F.explode(F.arrays_zip("terms", "tfs")).alias("e")).select("_block", F.col("e.terms").alias("term"), F.col("e.tfs").alias("tf"))
    per_block = entries.groupBy("_block", "term").agg(F.count("*").alias("n"), F.sum("tf").alias("tf"))
    per_term = per_block.groupBy("term").agg(F.sum("n").alias("df"), F.sum("tf").alias("cf"), F.collect_list("_block").alias("blocks"))
    vocab = bound_vocab(per_term, scalar_of(df, F.count("*")), min_df, max_df, max_features)
    # only terms that are kept go back, each to the blocks that hold it
    known = vocab.select(F.explode("blocks").alias("_block"), "term", "idf").repartition(blocks, "_block")
    names = [key, "term", "tf", "value"]

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        shown, lists = docs[key].combine_chunks(), docs["terms"].combine_chunks()
        at = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        term = lists.flatten()
        place = pc.index_in(term, value_set=known["term"].combine_chunks())
        found = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
        at, term, tf = at[found], term.take(pa.array(found)), docs["tfs"].combine_chunks().flatten().to_numpy()[found]
        value = tf * known["idf"].to_numpy()[pc.fill_null(place, 0).to_numpy()[found]]
        if norm in ("l1", "l2"):
            squares, absolute = _sizes_of(at, value, len(docs), None)
            size = absolute if norm == "l1" else np.sqrt(squares)
            value = value / np.where(size > 0, size, 1.0)[at]
        # in pieces, so that no batch is as large as the block
        cuts = range(0, max(len(at), 1), OUT_ROWS)
        return pa.concat_tables(
            pa.table([shown.take(pa.array(at[i : i + OUT_ROWS])), *(pa.array(x[i : i + OUT_ROWS]) if isinstance(x, np.ndarray) else x.slice(i, OUT_ROWS) for x in (term, tf, value))], names)
            for i in cuts
        )

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, term string, tf bigint, value double"
    return rows.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(run, schema)


def term_totals(counts: DataFrame) -> DataFrame:
    """Corpus count per term."""
    return counts.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("tf").alias("cf"))


def mean_tfidf(values: DataFrame, n_docs: Column) -> DataFrame:
    """Mean TF-IDF per term over all documents; a document without the term counts as zero."""
    return values.groupBy("term").agg(F.sum("value").alias("total")).select("term", (F.col("total") / n_docs).alias("mean_tfidf"))


def in_vocab(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tokens known to a vocabulary. Catalyst broadcasts the vocabulary when its measured size allows it."""
    return tokens.join(vocab.select("term"), "term", "left_semi")


def lemma_lookup(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Replace each term by its dictionary form (lexicon: term, lemma); unknown terms stay."""
    forms = lexicon.select("term", "lemma")
    joined = tokens.join(forms, "term", "left")
    return joined.withColumn("term", F.coalesce("lemma", "term")).select(*tokens.columns)


def extremes(df: DataFrame, measure: str, n: int = 20, item: str = "term") -> DataFrame:
    """The n smallest and n largest rows by a measure; ties in the order of the item."""
    small = df.select(item, measure).orderBy(F.asc(measure), item).limit(n).withColumn("side", F.lit("smallest"))
    large = df.select(item, measure).orderBy(F.desc(measure), item).limit(n).withColumn("side", F.lit("largest"))
    return small.unionByName(large)


def frequent_terms(totals: DataFrame, top: int = 30, bottom: int = 10) -> DataFrame:
    """Most and least frequent terms by corpus count."""
    most = totals.select("term", "cf").orderBy(F.desc("cf"), "term").limit(top).withColumn("side", F.lit("most"))
    least = totals.select("term", "cf").orderBy(F.asc("cf"), "term").limit(bottom).withColumn("side", F.lit("least"))
    return most.unionByName(least)


def term_length_extremes(vocab: DataFrame) -> DataFrame:
    """Longest and shortest term; among equals the first in alphabetical order."""
    by_length = F.struct(F.length("term"), F.col("term"))
    by_negative = F.struct(-F.length("term"), F.col("term"))
    return vocab.agg(
        F.min_by("term", by_negative).alias("longest"), F.min_by("term", by_length).alias("shortest")
    )


def embed_documents(tokens: DataFrame, vectors: DataFrame, key: str = "id", size: int | None = None) -> DataFrame:
    """(key, n_known, embedding): mean vector of the tokens that have a vector, all zeros where none has.

    ``tokens`` is (key, term) with a null term for empty documents, ``vectors`` is (term, vector array). Repeated tokens
    are counted first, then summed position by position inside each map task before the shuffle.
    """
    if size is None:
        size = len(vectors.select("vector").first()[0])
    counted = tokens.groupBy(key, "term").agg(F.count("*").alias("tf"))
    joined = counted.join(vectors.select("term", "vector"), "term", "left")
    sums = ", ".join(f"sum(cast(vector[{i}] AS double) * tf)" for i in range(size))
    summed = joined.groupBy(key).agg(
        F.expr("sum(CASE WHEN vector IS NOT NULL THEN tf ELSE 0L END)").alias("n_known"), F.expr(f"array({sums})").alias("sums")
    )
    means = F.transform("sums", lambda total: F.coalesce(F.try_divide(total, F.col("n_known")), F.lit(0.0)))
    return summed.select(key, "n_known", means.alias("embedding"))
