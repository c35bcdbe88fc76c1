"""Exact search, approximate search and near duplicates against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from textmill.llm import bitslice, crosspolytope, simhash


def fine(v, zero=True):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


# -- exact search --------------------------------------------------------------------------------------------------------


def brute_top(rows, queries, k):
    out = []
    quantised = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and fine(v)]
    for q, v in queries:
        w = [math.floor(256 * x) for x in v]
        scored = sorted((-sum(a * b for a, b in zip(w, u, strict=False)), i) for i, u in quantised if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def as_list(df):
    return sorted(map(tuple, df.collect()))


def test_top_of_embeddings(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    queries = [(i, v) for i, v in rows if i % 50 == 0 and fine(v)]
    assert as_list(bitslice.embedding_top(spark, sf)) == brute_top(rows, queries, 5)


def test_top_of_odd_vectors(spark):
    rng = random.Random(1)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.5, 3.0]) for _ in range(5)]) for i in range(300)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0, 1.0]) for i in range(300, 400)]  # many ties
    rows += [(400, None), (401, [1.0, None]), (402, [nan, 1.0]), (403, [inf]), (404, []), (405, [2.0]), (None, [1.0]), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    queries = [(i, v) for i, v in rows[:400] if i % 20 == 0] + [(404, []), (405, [2.0])]
    asked = spark.createDataFrame(queries, "vec_id long, embedding array<double>")
    for block_rows, query_rows in ((16_384, 256), (50, 7)):
        index = bitslice.build_index(df, "vec_id", "embedding", block_rows=block_rows)
        packed = bitslice.pack_queries(asked, "vec_id", "embedding", query_rows=query_rows)
        for k in (1, 5, 1_000):
            assert as_list(bitslice.search(index, packed, k)) == brute_top(rows, queries, k)
    empty = bitslice.build_index(df.where("false"), "vec_id", "embedding")
    assert bitslice.search(empty, packed).collect() == []
    assert bitslice.search(index, bitslice.pack_queries(asked.where("false"), "vec_id", "embedding")).collect() == []


# -- approximate search --------------------------------------------------------------------------------------------------


def brute_near(rows, query_id, v, k):
    return sorted((math.dist(v, u), i) for i, u in rows if i != query_id)[:k]


def recall(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows = [(i, v) for i, v in rows if fine(v, zero=False)]
    vectors = dict(rows)
    got = defaultdict(list)
    for r in crosspolytope.embedding_neighbours(spark, sf).collect():
        assert math.isclose(r.score, math.dist(vectors[r.query_id], vectors[r.vec_id]), rel_tol=1e-12, abs_tol=1e-12)
        got[r.query_id].append((r["rank"], r.score, r.vec_id))
    hits = wanted = 0
    for q, v in rows:
        if q % 100 == 0:
            found = sorted(got[q])
            assert [x[0] for x in found] == list(range(1, len(found) + 1))
            assert [x[1:] for x in found] == sorted(x[1:] for x in found)
            best = {i for _, i in brute_near(rows, q, v, 10)}
            hits, wanted = hits + len(best & {x[2] for x in found}), wanted + len(best)
    return hits / wanted


def test_recall(spark):
    assert recall(spark, "/root/testdata/sf0.001") >= 0.9
    assert recall(spark, "/root/testdata/sf0.1") >= 0.9


def test_near_of_odd_vectors(spark):
    nan = float("nan")
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(80)] + [(i, [1.0, 2.0, 0.0, 0.0, 0.0, -1.0]) for i in range(80, 120)]
    odd = [(120, None), (121, [0.0] * 6), (122, [nan] * 6), (123, [1.0, None]), (124, []), (None, [1.0]), (125, [1e-300, 0.0]), (5, rows[5][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, rank int")
    found = crosspolytope.nearest(df, df, "vec_id", "embedding", k=3, probes=16, part_rows=8).collect()
    usable = [(i, v + [0.0] * (6 - len(v))) for i, v in rows + [(125, [1e-300, 0.0])]]
    want = [(q, n + 1, i) for q, v in usable for n, (_, i) in enumerate(brute_near(usable, q, v, 3))]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == sorted(want)  # 16 probes of 16 axes: exact
    assert crosspolytope.nearest(df.where("false"), df, "vec_id", "embedding").collect() == []
    assert crosspolytope.nearest(df, df.where("false"), "vec_id", "embedding").collect() == []


def test_rotation_keeps_distances():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = crosspolytope.rotated(x, 3)
    assert np.allclose(x @ x.T, y @ y.T) and not np.allclose(x, y)


# -- near duplicates -----------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, different=2):
    """Smallest id by (id, fingerprint) rows."""
    distinct = sorted(set(m for _, m in marks))
    up = {m: m for m in distinct}

    def root(m):
        while up[m] != m:
            m = up[m]
        return m

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= different:
                up[root(a)] = root(b)
    smallest = {}
    for i, m in marks:
        if i is not None:
            smallest[root(m)] = min(i, smallest.get(root(m), i))
    return [(i, f"{m:016x}", smallest.get(root(m))) for i, m in marks]


def check_duplicates(df, **bounds):
    got = Counter(map(tuple, simhash.near_duplicates(df, "doc_id", "text", **bounds).collect()))
    assert got == Counter(plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in df.select("doc_id", "text").collect()]))


def test_duplicates(spark, sf, odd_documents, no_documents):
    check_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
    check_duplicates(spark.read.parquet(f"{sf}/documents.parquet"), node_rows=20)
    check_duplicates(odd_documents)
    check_duplicates(odd_documents, node_rows=4)
    check_duplicates(no_documents)


def crowded_marks(rng, size):
    """Fingerprints in tight balls, chains and at random."""
    centres = [rng.getrandbits(64) for _ in range(5)]
    marks = {rng.getrandbits(64) for _ in range(size)}
    for c in centres:
        for _ in range(size):
            marks.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
        walk = c
        for _ in range(20):
            walk ^= 3 << rng.randint(0, 62)
            marks.add(walk)
    return sorted(marks)


def test_walk_finds_every_link():
    rng = random.Random(4)
    for size in (1, 30, 120):
        marks = np.array(crowded_marks(rng, size), dtype=np.uint64)
        for different in (0, 1, 2, 3):
            found = {(int(i), int(j)) for a, b in simhash.walk(marks, None, 0, 0, different) for i, j in zip(a, b, strict=True)}
            want = {(i, j) for j in range(len(marks)) for i in range(j) if int(marks[i] ^ marks[j]).bit_count() <= different}
            assert found == want


def test_links_join_the_same_components(spark):
    rng = random.Random(6)
    marks = crowded_marks(rng, 60)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    df = spark.createDataFrame([(m,) for m in signed], "fingerprint long")
    want = plain_components(list(enumerate(marks)))
    for node_rows in (10, 100_000):
        edges = simhash.links(df, node_rows=node_rows)
        roots = {r.node: r.root for r in simhash.components(edges).collect()}
        assert all(roots[r.a] == roots[r.b] and (r.a ^ r.b).bit_count() <= 2 for r in [x for x in edges.collect() if x.a * x.b >= 0])
        groups = defaultdict(set)
        for i, m in enumerate(signed):
            groups[roots.get(m, m)].add(i)
        same = defaultdict(set)
        for i, _, c in want:
            same[c].add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, same.values()))


@pytest.mark.parametrize("n", [1, 2, 6, 12, 25])
def test_few_vectors_are_searched_exactly(spark, n):
    rng = np.random.default_rng(n)
    points = rng.normal(size=(n, 64))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): r.vec_id for r in crosspolytope.nearest(df, df, "vec_id", "embedding", 10).collect()}
    want = {}
    for q in range(n):
        others = sorted((float(np.sqrt(np.square(points[i] - points[q]).sum())), i) for i in range(n) if i != q)[:10]
        want |= {(q, rank): i for rank, (_, i) in enumerate(others, 1)}
    assert got == want
