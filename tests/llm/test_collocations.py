"""Phrase mining against a plain count of all phrases."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from textmill.llm import collocations as co


def plain_counts(rows):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        name = lang if lang is not None else "und"
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[name] += len(words)
            for m in (1, 2, 3, 4):
                counts.update((name, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    return counts, totals


def plain_collocations(rows, top, least):
    counts, totals = plain_counts(rows)
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, words), f in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                part = (lang, words[i : i + m])
                if 100 * f >= 80 * candidates[part]:
                    covered.add(part)
    out = []
    for lang in {k[0] for k in candidates}:
        found = []
        for (name, words), a in candidates.items():
            if name == lang and (name, words) not in covered:
                cuts = []
                for k in range(1, len(words)):
                    l, r = counts[(lang, words[:k])], counts[(lang, words[k:])]
                    cuts.append((2_000_000 * a // (l + r), k, l, r))
                score, _, l, r = min(cuts)
                found.append((-score, -a, " ".join(words).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def check(df, top=2000, least=30, **settings):
    rows = [(r.lang, r.text) for r in df.select("lang", "text").collect()]
    got = sorted(tuple(r) for r in co.collocations(df, "lang", "text", top, least, **settings).collect())
    assert got == plain_collocations(rows, top, least)
    return got


def test_phrases_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert check(docs)
    assert len(check(docs.repartition(5), top=40, least=4, shard_words=700)) > 100


def test_phrases_by_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    assert sorted(con.execute(co.DOCUMENT_PHRASES_SQL).fetchall()) == sorted(map(tuple, co.document_phrases(spark, folder).collect()))


def test_phrases_of_odd_rows(spark, odd_documents, no_documents):
    check(odd_documents, least=1)
    check(odd_documents, least=30)
    check(no_documents, least=1)
    words = ["a", "B", "b", "c", "é", "É", "x y", "\x00", "\x1c", "-"]
    rng = random.Random(2)
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))).replace(" - ", rng.choice([". ", "\n", "\t", "!?", "..", " - "])) for _ in range(300)]
    rows = [(rng.choice(["en", None, "und", "de"]), t) for t in texts]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("shard", F.lit("s")).repartition(4)
    check(df, least=2, shard_words=50)
    check(df, least=5, top=10)
    hot = spark.createDataFrame([("en", "one two three four five")] * 500 + [("en", "two three")] * 90, "lang string, text string")
    assert [r[2] for r in check(hot)] == [x for x in ("one two three four", "two three four five")]


def test_index_counts_every_phrase():
    rng = random.Random(4)
    for _ in range(30):
        symbols = rng.randint(1, 6)
        ids = np.array([0] + [rng.randint(0, symbols) for _ in range(rng.randint(1, 200))] + [0])
        index = co.build_index(ids, symbols)
        plain = Counter(tuple(ids[i : i + m].tolist()) for m in (2, 3, 4) for i in range(len(ids) - m + 1) if (ids[i : i + m] > 0).all())
        first, second, _, size = co.pairs_of(index)
        got = Counter(dict(zip(zip(first.tolist(), second.tolist(), strict=True), size.tolist(), strict=True)))
        every = np.unique(first * (symbols + 1) + second)
        for phrase, size in co.longer_of(index, every):
            got.update({tuple(p): s for p, s in zip(phrase.tolist(), size.tolist(), strict=True)})
        assert got == plain
        # both sides give the same extensions of a word
        symbol, lows, size = index.words()
        for right in (False, True):
            above, added, _, grown = index.extend(lows, size, right)
            for a, b, n in zip(symbol[above].tolist(), added.tolist(), grown.tolist(), strict=True):
                assert plain[(a, b) if right else (b, a)] == n
