"""Phrase collocations by one FM-index a shard.

1. Tasks turn texts into shards: the word ids of some million words of one language under a dictionary of their own, with
   id 0 between pieces. Word counts are summed over the shards; rarer words cannot be in a phrase and become breaks.
2. Every shard gets a bidirectional FM-index: the Burrows-Wheeler transforms of its ids and of the reversed ids, sorted as
   deep as the longest phrase. An interval of the one and its twin in the other stand for a phrase; its size is the count.
3. Intervals of words are extended to the right, which gives the pairs with their counts. A shard deals them out by hash into
   packed lists, one a bucket; a bucket sums its lists, and each shard learns which of its pairs are frequent everywhere.
4. Intervals of these pairs are extended to the left and then to the right, as long as the new end is a frequent pair; the
   counts of the longer phrases are summed over the shards. A phrase is never more frequent than a part of it, so none is lost.
5. Scores and the rule for parts of longer phrases are joins on the table of counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.llm.common import batches_of, lookup, table
from textmill.staging import stage

MIN_COUNT = 30
MAX_WORDS = 4
#: Words after which a shard is closed; an index takes some 60 bytes a word while it is built.
SHARD_WORDS = 1 << 20
#: Words for which there is one bucket of pairs; the number of buckets follows the input, so that a bucket fits into a task.
BUCKET_WORDS = 1 << 18
_BREAKS = re.compile(rb"[.,;:!?\x0a-\x0d]+")
_BREAK = b"."  # never part of a word


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed planes of bytes."""
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(raw[:, :width].T).tobytes()
    return len(values).to_bytes(8, "little") + bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(packed: bytes | pa.Buffer) -> np.ndarray:
    view = memoryview(packed)
    size, width = int.from_bytes(view[:8], "little"), view[8]
    raw = np.zeros((size, 8), dtype=np.uint8)
    if size:
        raw[:, :width] = np.frombuffer(pa.decompress(pa.py_buffer(view[9:]), decompressed_size=size * width, codec="zstd"), dtype=np.uint8).reshape(width, size).T
    return raw.view("<i8").reshape(-1)


# -- shards --------------------------------------------------------------------------------------------------------------


class _Words(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Shard:
    def __init__(self):
        self.words, self.ids, self.size = _Words({_BREAK: 0}), [np.zeros(1, dtype=np.int32)], 1

    def add(self, text: bytes) -> None:
        tokens = _BREAKS.sub(b" . ", text.lower()).split()
        tokens.append(_BREAK)
        self.ids.append(np.fromiter(map(self.words.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
        self.size += len(tokens)

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        ids = np.concatenate(self.ids)
        counts = np.bincount(ids, minlength=len(self.words))
        columns = [
            pa.array([number], pa.int64()), pa.array([lang]), pa.array([list(self.words)[1:]], pa.list_(pa.binary())),
            pa.array([counts[1:]], pa.list_(pa.int64())), pa.array([pack(ids)], pa.binary()), pa.array([int(counts[1:].sum())], pa.int64()),
        ]
        return pa.record_batch(columns, ["shard", "lang", "words", "counts", "ids", "n"])


def shards_of(df: DataFrame, lang: str, text: str, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``shard``, ``lang``, ``words``, ``counts``, ``ids`` (packed, 0 between pieces), ``n``; a shard holds one language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Shard] = {}
        number = TaskContext.get().partitionId() << 32

        def close(name: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            return held.pop(name).row(number, name)

        for batch in batches:
            for part in batches_of(batch):
                for name, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    shard = held.setdefault(name, _Shard())
                    shard.add(body)
                    if shard.size >= shard_words:
                        yield close(name)
                    # many languages in one task: the largest shard goes first
                    while len(held) > 1 and sum(s.size + 64 for s in held.values()) > 2 * shard_words:
                        yield close(max(held, key=lambda x: held[x].size))
        while held:
            yield close(next(iter(held)))

    chosen = df.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text")
    )
    return chosen.mapInArrow(run, "shard bigint, lang string, words array<binary>, counts array<bigint>, ids binary, n bigint")


# -- the index -----------------------------------------------------------------------------------------------------------


def _order(*columns: np.ndarray) -> np.ndarray:
    """Stable order of the rows by the columns, 16 bits at a time from the last ones, for which there is a radix sort."""
    order = None
    for column in reversed(columns):
        shift, largest = 0, int(column.max(initial=0))
        while not shift or largest >> shift:
            digit = ((column >> shift) & 0xFFFF).astype(np.uint16)
            order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
            shift += 16
    return order


def transform(ids: np.ndarray, depth: int = MAX_WORDS) -> np.ndarray:
    """Burrows-Wheeler transform of ``ids`` (0 at both ends): rotations sorted by their first ``depth`` symbols at least."""
    rank, width, order = ids.astype(np.int64), 1, None
    while order is None or width < depth:
        follower = np.concatenate([rank[width:], np.zeros(width, dtype=np.int64)])[: len(rank)]
        order = _order(rank, follower)
        first, second = rank[order], follower[order]
        rank[order] = np.concatenate([[0], np.cumsum((first[1:] != first[:-1]) | (second[1:] != second[:-1]))])
        width *= 2
    return ids[order - 1].astype(np.int32)


class Index:
    """A bidirectional FM-index; a node is (low in the forward index, low in the backward index, size)."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, symbols: int):
        self.sides, self.symbols = (forward, backward), symbols
        self.first = np.concatenate([[0], np.cumsum(np.bincount(forward, minlength=symbols + 1))])
        self.steps = []
        for side in self.sides:
            step = np.empty(len(side), dtype=np.int32 if len(side) < 1 << 31 else np.int64)
            step[_order(side)] = np.arange(len(side), dtype=step.dtype)
            self.steps.append(step)

    def words(self) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Symbol, lows and size of every single word."""
        symbol = np.arange(1, self.symbols + 1)
        low, size = self.first[symbol], self.first[symbol + 1] - self.first[symbol]
        return symbol, [low, low], size

    def extend(self, lows: list[np.ndarray], size: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """All extensions of the nodes by one word on one side: parent, symbol, lows and size of each, parents in order.

        The transform of the side holds the neighbouring word of every occurrence of a node inside its interval. Equal words
        of an interval are the occurrences of the extended phrase; the step of the first one is the new low there, and the
        number of smaller words in the interval leads to the new low in the twin.
        """
        bwt, step, low = self.sides[right], self.steps[right], lows[right]
        ends = np.cumsum(size)
        begins = ends - size
        parent = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(parent)) + np.repeat(low - begins, size)
        key = parent * (self.symbols + 1) + bwt[at]
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
        grown = np.diff(np.append(start, len(key)))
        head = order[start]
        above, symbol = parent[head], bwt[at[head]]
        own, twin = step[at[head]].astype(np.int64), lows[not right][above] + start - begins[above]
        keep = symbol > 0
        both = [twin[keep], own[keep]] if right else [own[keep], twin[keep]]
        return above[keep], symbol[keep].astype(np.int64), both, grown[keep]


def build_index(ids: np.ndarray, symbols: int, depth: int = MAX_WORDS) -> Index:
    """Index of ``ids`` (symbols 1 to ``symbols``, 0 as break)."""
    return Index(transform(ids, depth), transform(ids[::-1], depth), symbols)


def _without_repeated_breaks(ids: np.ndarray) -> np.ndarray:
    ids = np.concatenate([[0], ids, [0]])
    return ids[np.concatenate([[True], (ids[1:] != 0) | (ids[:-1] != 0)])]


def pairs_of(index: Index) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """First word, second word, lows and count of every pair."""
    symbol, lows, size = index.words()
    above, second, lows, size = index.extend(lows, size, right=True)
    return symbol[above], second, lows, size


def longer_of(index: Index, wanted: np.ndarray, depth: int = MAX_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases (one row of symbols each) of 3 to ``depth`` words all of whose pairs are ``wanted`` (sorted codes), and their counts.

    ``wanted`` codes a pair as first * (symbols + 1) + second. Nodes grow to the left, then to the right, and so on.
    """
    base = index.symbols + 1
    first, second, lows, size = pairs_of(index)
    keep = np.isin(first * base + second, wanted, assume_unique=True)
    phrase, lows, size = np.stack([first[keep], second[keep]], axis=1), [x[keep] for x in lows], size[keep]
    for words in range(3, depth + 1):
        right = words % 2 == 0
        above, symbol, lows, size = index.extend(lows, size, right)
        phrase = phrase[above]
        code = phrase[:, -1] * base + symbol if right else symbol * base + phrase[:, 0]
        keep = np.isin(code, wanted)
        added = symbol[keep][:, None]
        phrase = np.concatenate([phrase[keep], added] if right else [added, phrase[keep]], axis=1)
        lows, size = [x[keep] for x in lows], size[keep]
        yield phrase, size


# -- jobs ----------------------------------------------------------------------------------------------------------------


def _ints(column: pa.Array, i: int, kind=np.int64) -> np.ndarray:
    return np.asarray(column[i].values).astype(kind, copy=False)


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids = unpack(row.column("ids")[0].as_buffer())
            coded = row.column("coded")[0].values
            place, names = np.asarray(coded.field("place")).astype(np.int64) + 1, np.asarray(coded.field("id")).astype(np.int64)
            symbol_of = np.zeros(max(int(ids.max()), int(place.max())) + 1, dtype=np.int32)
            order = np.argsort(names)
            symbol_of[place[order]] = np.arange(1, len(names) + 1)
            ids = _without_repeated_breaks(symbol_of[ids])
            sides = [pack(transform(x)) for x in (ids, ids[::-1])]
            yield pa.record_batch([row.column("shard"), pa.array([names[order]], pa.list_(pa.int64())), *[pa.array([x], pa.binary()) for x in sides]], ["shard", "names", "forward", "backward"])


def _loaded(row: pa.RecordBatch) -> tuple[Index, np.ndarray]:
    names = np.concatenate([[0], _ints(row.column("names"), 0)])
    forward, backward = (unpack(row.column(x)[0].as_buffer()).astype(np.int32) for x in ("forward", "backward"))
    return Index(forward, backward, len(names) - 1), names


_LISTS = "size int, bucket bigint, shard bigint, words array<binary>, count binary"


def _dealt(phrases: np.ndarray, counts: np.ndarray, shard: int, buckets: int) -> pa.RecordBatch:
    """Phrases (one row of word ids each) of a shard as packed lists, one row for each bucket that holds any."""
    mixed = np.zeros(len(phrases), dtype=np.uint64)
    for word in phrases.T:
        mixed = (mixed ^ word.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    bucket = ((mixed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((phrases[:, 0], bucket))
    found, start = np.unique(bucket[order], return_index=True)
    words, sizes = [], []
    for part in np.split(order, start[1:]) if len(order) else []:
        inside = phrases[part]
        words.append([pack(np.diff(inside[:, 0], prepend=0)), *map(pack, inside.T[1:])])
        sizes.append(pack(counts[part]))
    columns = [
        pa.array(np.full(len(found), phrases.shape[1], dtype=np.int32)), pa.array(found), pa.array(np.full(len(found), shard, dtype=np.int64)),
        pa.array(words, pa.list_(pa.binary())), pa.array(sizes, pa.binary()),
    ]
    return pa.record_batch(columns, ["size", "bucket", "shard", "words", "count"])


def _listed(words: pa.ListScalar) -> np.ndarray:
    """The phrases of one packed list."""
    held = [unpack(x.as_buffer()) for x in words.values]
    return np.stack([np.cumsum(held[0]), *held[1:]], axis=1)


def _summed(phrases: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct phrases, their counts, and the place of each row's phrase among them."""
    order = np.lexsort(phrases.T[::-1])
    ordered = phrases[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    start, place = np.flatnonzero(new), np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[start], np.add.reduceat(counts[order], start), place


def _pair_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                index, names = _loaded(row)
                first, second, _, counts = pairs_of(index)
                yield _dealt(np.stack([names[first], names[second]], axis=1), counts, row.column("shard")[0].as_py(), buckets)

    return run


def _longer_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                index, names = _loaded(row)
                pairs = np.searchsorted(names, np.concatenate([_listed(x) for x in row.column("pairs")[0].values]))
                for phrases, counts in longer_of(index, np.unique(pairs[:, 0] * (index.symbols + 1) + pairs[:, 1])):
                    yield _dealt(names[phrases], counts, row.column("shard")[0].as_py(), buckets)

    return run


_FREQUENT = "phrase array<bigint>, f bigint, shard bigint, words array<binary>"


def _merged(min_count: int, tell_shards: bool):
    """The lists of a bucket summed: a row for each frequent phrase, and for each shard, if wanted, the list of those that it holds."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        lists = [_listed(x) for x in rows.column("words")]
        phrases, totals, place = _summed(np.concatenate(lists), np.concatenate([unpack(x.as_buffer()) for x in rows.column("count")]))
        often = totals >= min_count
        shards, words, at = [], [], 0
        for shard, held in zip(rows.column("shard").to_pylist(), lists, strict=True) if tell_shards else ():
            keep = held[often[place[at : at + len(held)]]]
            at += len(held)
            if len(keep):
                shards.append(shard)
                words.append([pack(np.diff(keep[:, 0], prepend=0)), *map(pack, keep.T[1:])])
        flat = pa.array(phrases[often].ravel())
        n, width = int(often.sum()), phrases.shape[1]
        listed = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width), pa.int32()), flat)
        columns = [
            [listed, pa.nulls(len(shards), listed.type)], [pa.array(totals[often]), pa.nulls(len(shards), pa.int64())],
            [pa.nulls(n, pa.int64()), pa.array(shards, pa.int64())], [pa.nulls(n, pa.list_(pa.binary())), pa.array(words, pa.list_(pa.binary()))],
        ]
        return pa.table([pa.chunked_array(x) for x in columns], ["phrase", "f", "shard", "words"])

    return run


def _numbered(words: DataFrame) -> DataFrame:
    """``words`` with ``id``, gapless from 1, the most frequent first: place in its partition plus the rows of earlier ones."""
    placed = stage(words.orderBy(F.desc("f")).withColumn("at", F.monotonically_increasing_id()), "sorted-words")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row a partition
    before = sizes.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return placed.withColumn("part", part).join(before, "part").select(*words.columns, (F.col("before") + place + 1).alias("id"))


def phrase_counts(df: DataFrame, lang: str, text: str, min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of all phrases of 1 to ``MAX_WORDS`` words with at least ``min_count`` occurrences in their language.

    Returns ``lang``, ``n`` (all words of a language); ``id``, ``lang``, ``word``, ``f`` (frequent words); ``phrase`` (array of
    word ids), ``f``. Ids differ between languages, so a phrase has one language.
    """
    shards = stage(shards_of(df, lang, text, shard_words), "phrase-shards")
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0")
    entry = F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")
    entries = shards.select("shard", "lang", entry).select("shard", "lang", "place", F.col("entry.words").alias("word"), F.col("entry.counts").alias("count"))
    # a word comes once a shard, so the rows of a word are few; its count and its places move together
    spread = entries.withColumn("f", F.sum("count").over(W.partitionBy("lang", "word"))).where(F.col("f") >= min_count)
    spread = stage(spread.select("shard", "lang", "word", "place", "f"), "frequent-entries")
    frequent = stage(_numbered(spread.groupBy("lang", "word").agg(F.max("f").alias("f"))), "frequent-words")

    coded = spread.select("shard", "lang", "word", "place").join(frequent.select("lang", "word", "id"), ["lang", "word"])
    coded = coded.groupBy("shard").agg(F.collect_list(F.struct("place", "id")).alias("coded"))
    index = stage(
        shards.select("shard", "ids").join(coded, "shard").select("shard", "ids", "coded")
        .mapInArrow(_index_rows, "shard bigint, names array<bigint>, forward binary, backward binary"), "phrase-index",
    )
    words = shards.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = -(-words // BUCKET_WORDS) or 1
    lists = index.mapInArrow(_pair_rows(buckets), _LISTS)
    pairs = stage(lists.groupBy("bucket").applyInArrow(_merged(min_count, True), _FREQUENT), "frequent-pairs")

    wanted = pairs.where("shard IS NOT NULL").groupBy("shard").agg(F.collect_list("words").alias("pairs"))
    lists = index.join(wanted, "shard").select("shard", "names", "forward", "backward", "pairs").mapInArrow(_longer_rows(buckets), _LISTS)
    longer = lists.groupBy("size", "bucket").applyInArrow(_merged(min_count, False), _FREQUENT).select("phrase", "f")
    two = pairs.where("shard IS NULL").select("phrase", "f")
    one = frequent.select(F.array("id").alias("phrase"), "f")
    return totals, frequent, stage(one.unionByName(two).unionByName(longer), "phrase-counts")


def _wide(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def collocations(df: DataFrame, lang: str, text: str, top: int = 2000, min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the best ``top`` phrases of each language.

    A text is lower-cased in A-Z, cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words at blanks and tabs. Candidates
    are phrases of 2 to 4 words with ``a >= min_count`` occurrences; ``l`` and ``r`` are the counts of the two parts of the
    lowest-scoring cut, the score is floor(2000000 a / (l + r)). A candidate in a longer one with at least 0.8 of its
    occurrences is dropped: that is so if, and only if, it is in one that is longer by one word, for the words between are at least
    as frequent as the longest. ``rank`` orders by score and ``a`` descending, then by the phrase in UTF-8.

    A null language is ``und``, a null text is empty, repeated rows count each time, a text of any length is read whole.
    Without candidates, as in an empty table, there are no rows. Other columns of ``df`` play no part.
    """
    totals, frequent, counts = phrase_counts(df, lang, text, min_count, shard_words)
    candidates = counts.where(F.size("phrase") > 1).withColumnRenamed("f", "a")
    size = F.size("phrase")
    cuts = stage(
        candidates.select("phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
            "phrase", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("left"), F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("right")
        ), "phrase-cuts",
    )
    half = stage(lookup(cuts, "left", counts.select(F.col("phrase").alias("left"), F.col("f").alias("l"))), "phrase-cuts")
    whole = lookup(half, "right", counts.select(F.col("phrase").alias("right"), F.col("f").alias("r")))
    score = F.call_function("div", _wide("a") * F.lit(2_000_000).cast("decimal(7,0)"), _wide("l") + _wide("r"))
    best = whole.withColumn("score", score).groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    parts = candidates.where(size > 2).select("a", F.explode(F.array(F.slice("phrase", F.lit(1), size - 1), F.slice("phrase", F.lit(2), size - 1))).alias("phrase"))
    longer = parts.groupBy("phrase").agg(F.max("a").alias("longer"))
    inside = F.coalesce(_wide("longer") * 100 >= _wide("a") * 80, F.lit(False))
    kept = stage(best.join(longer, "phrase", "left").where(~inside).select("phrase", "a", "cut.*"), "phrases")

    spelt = stage(kept.select("phrase", F.posexplode("phrase").alias("place", "id")), "phrase-words")
    spelt = lookup(spelt, "id", frequent.select("id", "lang", "word")).groupBy("phrase").agg(F.max("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    text_of = F.array_join(F.transform("words", lambda x: x["word"].cast("string")), " ")
    named = kept.join(spelt, "phrase").select("lang", text_of.alias("phrase"), "a", "l", "r", "score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint"))


def document_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"), "lang", "text")


DOCUMENT_PHRASES_SQL = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
), pieces AS (
    SELECT lang, unnest(string_split_regex(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), lists AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), grams AS (
    SELECT lang, words[i : i + m - 1] AS phrase
    FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM lists, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(words) >= m)
), counts AS (
    SELECT lang, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM lists GROUP BY lang
), candidates AS (
    SELECT lang, phrase, f AS a FROM counts WHERE f >= 30 AND len(phrase) > 1
), longer AS (
    SELECT lang, part, max(a) AS most
    FROM (SELECT lang, a, phrase[i : i + m - 1] AS part
          FROM (SELECT lang, phrase, a, m, unnest(range(1, len(phrase) - m + 2)) AS i FROM candidates, (SELECT unnest([2, 3]) AS m) WHERE len(phrase) > m))
    GROUP BY ALL
), cuts AS (
    SELECT lang, phrase, a, unnest(range(1, len(phrase))) AS k FROM candidates
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.phrase[1 : c.k]
         JOIN counts y ON y.lang = c.lang AND y.phrase = c.phrase[c.k + 1 : len(c.phrase)]
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
    SELECT b.lang, array_to_string(b.phrase, ' ') AS phrase, b.a, b.l, b.r, b.score
    FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.part = b.phrase
    WHERE NOT coalesce(100::HUGEINT * g.most >= 80::HUGEINT * b.a, false)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
