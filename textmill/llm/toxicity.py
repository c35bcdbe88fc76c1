"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine, over a block-max inverted index.

1. Examples: at most ``max_examples`` labelled rows, chosen by the hash of their id (a bounded sample of labels).
2. Features: whole words, word beginnings and word ends whose document counts among the examples differ between the two
   labels (G-test); at most ``max_features`` of them. The index thus holds at most max_examples x max_features postings,
   and in practice a few for each example; that bound is why it may be broadcast.
3. Document frequencies of the features are counted over all documents.
4. Index: postings by feature in the order of the examples, cut into blocks of 64 examples, with the largest weight of each
   block. A search adds up the block maxima to a bound for every block and takes a first limit from the best blocks. The
   weakest features, which together cannot reach a share of that limit, are not read; their block maxima stand in for them.
   Only examples whose read weights and maxima reach the limit are compared in full. The result is exact.
5. Votes are weighted by nearness (squared cosine) and pulled towards the base rate; a monotone fit on left-one-out votes of
   the examples turns them into calibrated scores. The nearest examples are returned as evidence.

Whole texts are read once: what they hold of the features is written beside the rows and serves the document frequencies and
the scores. No rows are moved.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import Remembered, batches_of, one_text, table
from textmill.staging import stage

MAX_EXAMPLES, MAX_FEATURES = 20_000, 4_096
NEIGHBOURS, EVIDENCE = 25, 3
THRESHOLD = 0.3
BLOCK = 64
#: Share of the limit that features left unread may reach together: a smaller one reads more postings and compares fewer examples.
UNREAD = 0.1
#: Vectors searched for at once.
VECTORS = 32
#: A feature that more than one example in so many holds has its postings laid out as whole blocks.
DENSE = 16
#: Least G (chi-square with one degree of freedom) and least number of examples of a feature.
LEAST_G, LEAST_EXAMPLES = 13.0, 3
#: Column with the features of a text and how often each occurs, as pairs of 32-bit numbers in rising order.
COUNTS = "__toxicity_counts"
_WORD = re.compile(r"\w+")
_EDGES = (4, 5, 6)
#: Signs around a word that are no part of any word.
_SIGNS = ".,;:!?()[]{}<>\"'`*#-"


def held_out(id_column: str) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def run_features(run: bytes) -> tuple[str, ...]:
    """Features of a run of non-space characters."""
    found = []
    for word in _WORD.findall(run.decode().lower()):
        found.append(f"={word}")
        for n in _EDGES:
            if len(word) > n:
                found.append(f"^{word[:n]}")
                found.append(f"{word[-n:]}$")
    return tuple(found)


# -- the index -----------------------------------------------------------------------------------------------------------


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All positions of the ranges [first, last)."""
    sizes = last - first
    return np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class BlockMaxIndex:
    """Postings of examples by feature. ``vectors``: one (features, weights) pair per example, of length 1."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], features: int):
        self.size = len(vectors)
        example = np.repeat(np.arange(self.size), [len(f) for f, _ in vectors])
        feature = np.concatenate([f for f, _ in vectors]) if vectors else np.zeros(0, dtype=np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        order = np.lexsort((example, feature))
        self.example, self.weight, feature = example[order], weight[order], feature[order]
        new = np.ones(len(feature), dtype=bool)
        new[1:] = (feature[1:] != feature[:-1]) | (self.example[1:] // BLOCK != self.example[:-1] // BLOCK)
        self.first = np.append(np.flatnonzero(new), len(feature))  # where each block of postings starts
        self.block = self.example[self.first[:-1]] // BLOCK
        self.largest = np.maximum.reduceat(self.weight, self.first[:-1]) if len(feature) else np.zeros(0)
        self.of_feature = np.searchsorted(feature[self.first[:-1]], np.arange(features + 1))
        self.blocks = -(-self.size // BLOCK)
        self.posts = self.first[self.of_feature]  # where the postings of each feature start
        # the vectors themselves, for the exact cosines of candidates
        self.start = np.concatenate([[0], np.cumsum([len(f) for f, _ in vectors])]).astype(np.int64)
        self.own_feature = np.concatenate([f for f, _ in vectors]) if vectors else np.zeros(0, dtype=np.int64)
        self.own_weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_maxima", "_dense")}

    def maxima(self) -> np.ndarray:
        """Largest weight by feature and block, 0 where a block has none; made once per worker."""
        held = self.__dict__.get("_maxima")
        if held is None:
            held = self._maxima = np.zeros((len(self.of_feature) - 1, self.blocks))
            held[np.repeat(np.arange(len(held)), np.diff(self.of_feature)), self.block] = self.largest
        return held

    def dense(self) -> tuple[np.ndarray, np.ndarray]:
        """Features with whole blocks, and their weights for all examples (32 bits); at most DENSE times the postings."""
        held = self.__dict__.get("_dense")
        if held is None:
            sizes = np.diff(self.posts)
            whole = np.flatnonzero(sizes * DENSE > self.size)
            weights = np.zeros((len(whole), self.blocks * BLOCK), dtype=np.float32)
            posts = _ranges(self.posts[whole], self.posts[whole + 1])
            weights[np.repeat(np.arange(len(whole)), sizes[whole]), self.example[posts]] = self.weight[posts]
            held = self._dense = (whole, weights)
        return held

    def nearest(self, features: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples with a positive cosine, nearest first; ties by position."""
        return self.nearest_of([(features, weights)], k, [without])[0]

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each vector; the products with whole blocks are made for several vectors at once."""
        whole, held = self.dense()
        found = []
        for start in range(0, len(vectors), VECTORS):
            some = vectors[start : start + VECTORS]
            asked = np.zeros((len(some), len(self.of_feature) - 1))
            for row, (features, weights) in zip(asked, some, strict=True):
                row[features] = weights
            read = asked[:, whole].astype(np.float32) @ held
            asked_sparse = np.ones(asked.shape[1], dtype=bool)
            asked_sparse[whole] = False
            for i, (features, _) in enumerate(some):
                found.append(self._nearest(features, asked[i], features[asked_sparse[features]], read[i].reshape(-1, BLOCK), k, without[start + i]))
        return found

    def _nearest(self, features: np.ndarray, asked: np.ndarray, sparse: np.ndarray, read: np.ndarray, k: int, without: int) -> tuple[np.ndarray, np.ndarray]:
        """``read``: what the features with whole blocks give, by block; ``sparse``: the other ones of ``features``."""
        slack = (len(self.dense()[0]) + 4) * float(np.finfo(np.float32).eps)  # more than the error of 32-bit sums
        bound = asked[features] @ self.maxima()[features]
        # the best blocks give a first limit
        best = np.argsort(-bound, kind="stable")[: 2 + 2 * k // BLOCK]
        scores = np.concatenate([np.zeros(0), *[self._block_scores(b, asked, without) for b in best.tolist()]])
        limit = np.partition(scores, -k)[-k] - slack if len(scores) >= k else 0.0
        # features that together stay below a share of the limit are not read: no example reaches it by them alone
        parts = self.maxima()[sparse] * asked[sparse][:, None]
        highest = parts.max(axis=1, initial=0.0)
        order = np.argsort(highest, kind="stable")
        unread = int(np.searchsorted(np.cumsum(highest[order]), UNREAD * limit)) if limit > 0 else 0
        blocks = np.flatnonzero(bound + slack >= limit)
        rest = parts[order[:unread]].sum(axis=0)[blocks]
        sparse = sparse[order[unread:]]
        first, last = self.posts[sparse], self.posts[sparse + 1]
        posts = _ranges(first, last)
        read = read[blocks]
        if len(posts):
            products = np.repeat(asked[sparse], last - first) * self.weight[posts]
            read = read + np.bincount(self.example[posts], products, minlength=self.blocks * BLOCK).reshape(-1, BLOCK)[blocks]
        # what an example must have read already
        reached = np.flatnonzero(read >= np.maximum(limit - rest, 1e-300)[:, None])
        block = reached // BLOCK
        have = read.ravel()[reached]
        at = k + (without >= 0)  # the example left out may be among those read
        if len(reached) > at:  # the k-th largest weight read so far is a limit, too
            kept = have + rest[block] >= np.partition(have, -at)[-at] - 2 * slack
            reached, block = reached[kept], block[kept]
        found, scores = self._best(blocks[block] * BLOCK + reached % BLOCK, asked, k, without)
        return found, np.minimum(scores, 1.0)

    def _block_scores(self, block: int, asked: np.ndarray, without: int) -> np.ndarray:
        """Cosines of the examples of a block, whose features lie side by side."""
        starts = self.start[block * BLOCK : (block + 1) * BLOCK + 1]
        own = slice(starts[0], starts[-1])
        sums = np.concatenate([[0.0], np.cumsum(asked[self.own_feature[own]] * self.own_weight[own])])
        scores = np.diff(sums[starts - starts[0]])
        if without // BLOCK == block:
            scores[without % BLOCK] = 0.0
        return scores

    def _best(self, candidates: np.ndarray, asked: np.ndarray, k: int, without: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of the candidates by their exact cosines."""
        first, last = self.start[candidates], self.start[candidates + 1]
        own = _ranges(first, last)
        scores = np.round(np.bincount(np.repeat(np.arange(len(candidates)), last - first), asked[self.own_feature[own]] * self.own_weight[own], minlength=len(candidates)), 12)
        kept = (scores > 0) & (candidates != without)
        candidates, scores = candidates[kept], scores[kept]
        if len(scores) > k:
            kept = scores >= np.partition(scores, -k)[-k]
            candidates, scores = candidates[kept], scores[kept]
        best = np.lexsort((candidates, -scores))[:k]
        return candidates[best], scores[best]


def monotone_fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a rising curve through the means of ``y`` over ``x`` (pooled adjacent violators)."""
    blocks: list[list[float]] = []  # sum of y, weight, sum of x
    order = np.argsort(x, kind="stable")
    values, starts, counts = np.unique(x[order], return_index=True, return_counts=True)
    for value, start, count in zip(values, starts, counts, strict=True):
        blocks.append([float(y[order[start : start + count]].sum()), float(count), float(value * count)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def counts_in(pairs: bytes) -> dict[int, int]:
    """How often each feature occurs, from a value of ``COUNTS``."""
    return dict(np.frombuffer(pairs, dtype="<i4").reshape(-1, 2).tolist())


class KnownRuns:
    """Which runs hold features, found once each; the table of those that hold none has two generations, so both are bounded."""

    def __init__(self, compute: Callable[[list[bytes]], dict[bytes, tuple[int, ...]]], limit: int):
        self.compute, self.limit = compute, limit
        self.having: dict[bytes, tuple[int, ...]] = {}
        self.without: set[bytes] = set()
        self.before: set[bytes] = set()

    def learn(self, runs: set[bytes]) -> None:
        """Every one of the runs that holds features is in ``having`` after that."""
        if len(self.having) > self.limit:
            self.having.clear()
        if len(self.without) > self.limit:
            self.before, self.without = self.without, set()
        # one difference after another: each looks up the runs that are left
        new = runs.difference(self.without).difference(self.having)
        held = self.compute(list(new.difference(self.before)))
        self.having.update(held)
        self.without.update(new.difference(held))


@dataclass
class ToxicityModel:
    """All that scoring needs; bounded by the number of examples and features."""

    names: dict[str, int]
    idf: np.ndarray
    base_rate: float
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    index: BlockMaxIndex | None = None
    curve: tuple[np.ndarray, np.ndarray] | None = None
    without_evidence: float = 0.0
    neighbours: int = NEIGHBOURS

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_runs", "_known")}

    def counts(self, text: str) -> dict[int, int]:
        """How often each feature occurs in the text."""
        return self.counts_of([text])[0]

    def counts_of(self, texts: list[str]) -> list[dict[int, int]]:
        runs = self.__dict__.get("_runs")
        if runs is None:
            words = {n[1:]: i for n, i in self.names.items() if n[0] == "="}
            starts = {n[1:]: i for n, i in self.names.items() if n[0] == "^"}
            ends = {n[:-1]: i for n, i in self.names.items() if n[-1] == "$"}
            # the shortest edge of a selected longer one is a key too, so one look is enough for most words
            for edges, cut in ((starts, slice(_EDGES[0])), (ends, slice(-_EDGES[0], None))):
                for edge in list(edges):
                    edges.setdefault(edge[cut], None)
            runs = self._runs = KnownRuns(lambda new: self._selected_of(new, words, starts, ends), 100_000)
        seen = [Counter(text.encode().split()) for text in texts]
        runs.learn(set().union(*seen))
        counted = []
        for times in seen:
            found: dict[int, int] = {}
            for run in times.keys() & runs.having.keys():
                for feature in runs.having[run]:
                    found[feature] = found.get(feature, 0) + times[run]
            counted.append(found)
        return counted

    def _selected_of(self, runs: list[bytes], words: dict[str, int], starts: dict[str, int | None], ends: dict[str, int | None]) -> dict[bytes, tuple[int, ...]]:
        """Features of those runs that hold some."""
        first, last = _EDGES[0], -_EDGES[0]
        found = {}
        # runs hold no line breaks; most are one word without a selected edge
        for run, text in zip(runs, b"\n".join(runs).decode().lower().split("\n"), strict=True) if runs else ():
            core = text.strip(_SIGNS)
            if core[:first] in starts or core[last:] in ends or core in words or not core.isalnum():
                selected = self._selected(core, words, starts, ends)
                if selected:
                    found[run] = selected
        return found

    def _selected(self, core: str, words: dict[str, int], starts: dict[str, int | None], ends: dict[str, int | None]) -> tuple[int, ...]:
        found = []
        # letters and digits between signs are one word
        for word in (core,) if core.isalnum() else _WORD.findall(core):
            if word in words:
                found.append(words[word])
            size = len(word)
            if word[: _EDGES[0]] in starts:
                found += [starts[word[:n]] for n in _EDGES if n < size and starts.get(word[:n]) is not None]
            if word[-_EDGES[0] :] in ends:
                found += [ends[word[-n:]] for n in _EDGES if n < size and ends.get(word[-n:]) is not None]
        return tuple(found)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Features in rising order and their TF-IDF weights, of length 1."""
        features = np.array(sorted(counts), dtype=np.int64)
        weights = np.array([1.0 + math.log(counts[f]) for f in features.tolist()]) * self.idf[features]
        return features, weights / np.sqrt(np.square(weights).sum()) if len(features) else weights

    def votes_of(self, counts: list[dict[int, int]], without: list[int] | None = None) -> list[tuple[float | None, np.ndarray, np.ndarray]]:
        """For each text the share of toxic votes, None without evidence; the nearest examples and their cosines."""
        nothing = (np.zeros(0, dtype=np.int64), np.zeros(0))
        vectors = [self.vector(c) for c in counts]
        searched = self.index.nearest_of(vectors, self.neighbours, without or [-1] * len(counts)) if self.index is not None else [nothing] * len(counts)
        votes = []
        for found, cosines in searched:
            weights = np.square(cosines)
            vote = float(((weights * self.toxic[found]).sum() + 0.5 * self.base_rate) / (weights.sum() + 0.5)) if len(found) else None
            votes.append((vote, found, cosines))
        return votes

    def pairs(self, text: str) -> bytes:
        """The value of ``COUNTS`` for a text."""
        return self.pairs_of([text])[0]

    def pairs_of(self, texts: list[str]) -> list[bytes]:
        return [np.array(sorted(found.items()), dtype="<i4").tobytes() for found in self.counts_of(texts)]

    def scores_of(self, pairs: list[bytes]) -> list[tuple[float, list[dict]]]:
        """Calibrated score and evidence of texts by their values of ``COUNTS``; equal ones are searched for once."""
        known = self.__dict__.setdefault("_known", {})
        if len(known) > 20_000:
            known.clear()
        new = [x for x in dict.fromkeys(pairs) if x not in known]
        votes = self.votes_of([counts_in(x) for x in new])
        known.update({x: self._scored(*vote) for x, vote in zip(new, votes, strict=True)})
        return [known[x] for x in pairs]

    def _scored(self, vote: float | None, found: np.ndarray, cosines: np.ndarray) -> tuple[float, list[dict]]:
        if vote is None:
            return self.without_evidence, []
        score = float(np.clip(np.interp(vote, *self.curve), 0.0, 1.0)) if self.curve and len(self.curve[0]) else self.base_rate
        evidence = [{"doc_id": int(self.ids[i]), "similarity": float(c), "toxic": int(self.toxic[i])} for i, c in zip(found[:EVIDENCE], cosines, strict=False)]
        return score, evidence


# -- learning ------------------------------------------------------------------------------------------------------------


def labelled_examples(docs: DataFrame, labels: DataFrame, max_examples: int) -> DataFrame:
    """``id``, ``text``, ``toxic`` of at most ``max_examples`` labelled ids that are not held out (equal texts once)."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    ids = known.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = stage(ids.orderBy(F.xxhash64("id"), "id").limit(max_examples), "labelled")
    # the sample is bounded by max_examples, so it may be sent to every task
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), one_text("text").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id")
    return stage(rows.groupBy("text", "toxic").agg(F.min("id").alias("id")).select("id", "text", "toxic"), "examples")


def _feature_counts(examples: DataFrame) -> DataFrame:
    """(feature, toxic, clean): number of examples of either label that hold the feature."""

    def table_of(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(counts[0] | counts[1])
        columns = [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in (counts[1], counts[0])]]
        return pa.record_batch(columns, ["feature", "toxic", "clean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Remembered(run_features, 100_000)
        counts = (Counter(), Counter())
        for batch in batches:
            for part in batches_of(batch):
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    counts[toxic].update({f for run in set(text.encode().split()) for f in runs[run]})
                    runs.trim()
                    if len(counts[0]) + len(counts[1]) > 500_000:
                        yield table_of(counts)
                        counts = (Counter(), Counter())
        yield table_of(counts)

    counted = examples.select("text", "toxic").mapInArrow(run, "feature string, toxic bigint, clean bigint")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_features(examples: DataFrame, max_features: int) -> list[str]:
    """Features whose counts differ most between the labels, by the G statistic."""
    totals = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    all_toxic, all_clean = float(totals.get(1, 0)), float(totals.get(0, 0))
    if not all_toxic or not all_clean:
        return []
    both = all_toxic + all_clean

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    with_it = F.col("toxic") + F.col("clean")
    rest = F.lit(both) - with_it
    g = 2 * (
        part(F.col("toxic"), with_it * all_toxic / both) + part(F.col("clean"), with_it * all_clean / both)
        + part(all_toxic - F.col("toxic"), rest * all_toxic / both) + part(all_clean - F.col("clean"), rest * all_clean / both)
    )
    marked = _feature_counts(examples).where(with_it >= LEAST_EXAMPLES).withColumn("g", g).where(F.col("g") >= LEAST_G)
    return [r["feature"] for r in marked.orderBy(F.desc("g"), "feature").select("feature").limit(max_features).collect()]


def count_features(docs: DataFrame, names: dict[str, int], kept: list[str]) -> DataFrame:
    """The columns ``kept`` of ``docs`` plus ``COUNTS``, written; a null text counts as empty."""
    model = docs.sparkSession.sparkContext.broadcast(ToxicityModel(names, np.ones(len(names)), 0.0))
    chosen = docs.select(*[F.col(f"`{c}`") for c in kept], one_text("text").alias(COUNTS))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField(COUNTS, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model.value
        for batch in batches:
            for part in batches_of(batch):
                pairs = pa.array(held.pairs_of(part.column(len(kept)).to_pylist()), pa.binary())
                yield pa.record_batch([*part.columns[:-1], pairs], part.schema.names)

    return stage(chosen.mapInArrow(run, schema), "feature-counts")


def document_frequencies(counted: DataFrame, features: int) -> tuple[int, np.ndarray]:
    """Number of all documents and of those with each feature; every task returns one row per feature at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(features + 1, dtype=np.int64)
        for batch in batches:
            for part in batches_of(batch):
                counts[features] += part.num_rows
                held = np.frombuffer(b"".join(part.column(0).to_pylist()), dtype="<i4").reshape(-1, 2)[:, 0]
                counts[:features] += np.bincount(held, minlength=features)
        seen = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], ["feature", "n"])

    rows = counted.select(COUNTS).mapInArrow(run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect()  # one per feature
    found = np.zeros(features + 1, dtype=np.int64)
    for r in rows:
        found[r["feature"]] = r["n"]
    return int(found[features]), found[:features]


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_features: int = MAX_FEATURES, neighbours: int = NEIGHBOURS) -> ToxicityModel:
    """Model from the labels of rows that are not held out. Without labels of both kinds every score is the base rate.

    A doc_id labelled several times is toxic if one label says so; null labels and ids are left out.
    """
    return fit_and_count(docs, labels, [], max_examples, max_features, neighbours)[0]


def fit_and_count(
    docs: DataFrame, labels: DataFrame, kept: list[str], max_examples: int = MAX_EXAMPLES, max_features: int = MAX_FEATURES, neighbours: int = NEIGHBOURS,
) -> tuple[ToxicityModel, DataFrame]:
    """The model, and the columns ``kept`` of ``docs`` with ``COUNTS``, which ``score`` takes in place of the texts."""
    examples = labelled_examples(docs, labels, max_examples)
    names = {name: i for i, name in enumerate(choose_features(examples, max_features))}
    counted = count_features(docs, names, kept)
    documents, frequency = document_frequencies(counted, len(names))
    rate = examples.agg(F.avg("toxic")).first()[0] or 0.0
    model = ToxicityModel(names, np.log((1.0 + documents) / (1.0 + frequency)) + 1.0, rate, without_evidence=rate, neighbours=neighbours)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                pairs = pa.array(shared.value.pairs_of(part.column(1).to_pylist()), pa.binary())
                yield pa.record_batch([part.column(0), part.column(2), pairs], ["id", "toxic", "pairs"])

    # at most max_examples; they reach the driver packed, as an object for each feature of each example fills its memory
    found = examples.select("id", "text", "toxic").mapInArrow(run, "id bigint, toxic int, pairs binary").toArrow()
    found = found.take(pa.array(np.argsort(found["id"].to_numpy(), kind="stable")))
    known = pc.greater(pc.binary_length(found["pairs"]), 0)
    bare = found.filter(pc.invert(known))["toxic"].to_pylist()
    found = found.filter(known)
    model.ids, model.toxic, pairs = found["id"].to_numpy(), found["toxic"].to_numpy().astype(np.int64), found["pairs"].to_pylist()
    vectors = [model.vector(counts_in(x)) for x in pairs]
    # examples with the same strongest features lie together, so few blocks hold a feature and their bounds are close
    strongest = [f[np.lexsort((f, -w))].astype(">i4").tobytes() for f, w in vectors]  # in the order of the numbers
    order = sorted(range(len(pairs)), key=lambda i: (strongest[i], model.ids[i]))
    model.ids, model.toxic, pairs = model.ids[order], model.toxic[order], [pairs[i] for i in order]
    model.index = BlockMaxIndex([vectors[i] for i in order], len(names))
    votes = _votes_without_self(docs.sparkSession, model, pairs)
    voted = np.array([v is not None for v in votes], dtype=bool)
    bare += model.toxic[~voted].tolist()
    model.without_evidence = (sum(bare) + rate) / (len(bare) + 1.0)
    if voted.any():
        model.curve = monotone_fit(np.array([v for v in votes if v is not None]), model.toxic[voted].astype(float))
    return model, counted


def _votes_without_self(spark: SparkSession, model: ToxicityModel, pairs: list[bytes]) -> list[float | None]:
    """Vote of every example among the others."""
    shared = spark.sparkContext.broadcast((model, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, packed = shared.value
        for batch in batches:
            places = batch.column(0).to_pylist()
            votes = [v for v, _, _ in held.votes_of([counts_in(packed[i]) for i in places], places)]
            yield pa.record_batch([pa.array(places, pa.int64()), pa.array(votes, pa.float64())], ["place", "vote"])

    found = spark.range(len(pairs)).mapInArrow(run, "place bigint, vote double").collect()
    return [r["vote"] for r in sorted(found, key=lambda r: r["place"])]


# -- scoring -------------------------------------------------------------------------------------------------------------


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` plus ``score``, ``predicted`` and ``evidence`` (doc_id, similarity, toxic of the nearest).

    With a column ``COUNTS`` (from ``fit_and_count`` of this model) texts are not read; it is left out of the result.
    A null or empty text has no evidence and gets the share of toxic examples without evidence. Repeated rows are scored
    alike. Columns with the names of the results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    results = ("score", "predicted", "evidence")
    ready = COUNTS in docs.columns
    names = [c for c in docs.columns if c not in (*results, COUNTS)]
    asked = F.col(COUNTS) if ready else one_text("text")
    chosen = docs.select(*[F.col(f"`{c}`") for c in names], asked.alias(COUNTS))
    evidence = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("toxic", T.IntegerType())]))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", evidence)])
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for part in batches_of(batch):
                asked_for = part.column(len(names)).to_pylist()
                scored = held.scores_of(asked_for if ready else held.pairs_of(asked_for))
                scores = [s for s, _ in scored]
                yield pa.record_batch(
                    [*part.columns[:-1], pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array([e for _, e in scored], kind)],
                    [*names, *results],
                )

    return chosen.mapInArrow(run, schema)


def document_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model, counted = fit_and_count(docs, table(spark, sf, "labels"), ["doc_id"])
    return score(counted, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", F.to_json("evidence").alias("evidence"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    names = docs.columns
    clear = [f"__{i}" for i in range(len(names))]  # columns may have the names of the results
    model, counted = fit_and_count(docs, table(spark, sf, "labels"), names)
    kept = score(counted.toDF(*clear, COUNTS), model).where(F.col("predicted") == 0)
    return kept.select(*clear).toDF(*names)
