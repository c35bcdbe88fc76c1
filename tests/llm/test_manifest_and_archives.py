"""The Merkle manifest against a plain tree, and WARC archives against their pages and against damage."""

import base64
import glob
import gzip
import hashlib
import io
import zlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from textmill.llm import merkle, warc

# -- manifest ------------------------------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(digests):
    """Root, and for each digest its list of (left, right) from the leaf up."""
    paths, groups = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        ups, merged = [], []
        for start in range(0, len(digests), 16):
            run = digests[start : start + 16]
            ups.append(sha("".join(run)))
            for k, members in enumerate(groups[start : start + 16]):
                for i in members:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            merged.append([i for members in groups[start : start + 16] for i in members])
        digests, groups = ups, merged
    return digests[0], paths


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        leaf = plain_leaf((r.doc_id, r.source, r.lang, r.n_chars, r.text))
        altered = leaf
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None:
            lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text)
            altered = plain_leaf((r.doc_id, r.source, r.lang, r.n_chars, lowered))
        groups[(r.source is not None, (r.source or "").encode())].append(((r.doc_id is not None, r.doc_id or 0), leaf, r.doc_id, altered))
    names, out = sorted(groups), []
    trees = [plain_tree([x[1] for x in sorted(groups[name])]) for name in names]
    root, upper = plain_tree([t[0] for t in trees]) if trees else (None, [])
    for name, (subroot, paths), above in zip(names, trees, upper, strict=True):
        for (_, leaf, doc_id, altered), path in zip(sorted(groups[name]), paths, strict=True):
            whole = path + above
            digest = altered
            for left, right in whole:
                digest = sha(left + digest + right)
            out.append((doc_id, leaf, subroot, root, sha("".join(a + b for a, b in whole)), digest, digest == root))
    return Counter(out)


def check_manifest(spark, folder, docs):
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    got = Counter(map(tuple, merkle.document_manifest(spark, str(folder)).collect()))
    assert got == plain_manifest(spark.read.parquet(f"{folder}/documents.parquet").collect())
    return got


def test_manifest_of_documents(spark, sf, tmp_path):
    got = check_manifest(spark, tmp_path, spark.read.parquet(f"{sf}/documents.parquet"))
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_tall_trees(spark, tmp_path):
    """Sources of 1, 16, 17, 256, 257 and 4,500 rows, and many sources."""
    sizes = [1, 16, 17, 256, 257, 4_500] + [1] * 300
    docs = spark.createDataFrame([(s, i) for s, n in enumerate(sizes) for i in range(n)], "s int, i int").select(
        (F.col("i") * 1_000 + F.col("s")).cast("long").alias("doc_id"), F.concat(F.lit("Text "), F.col("i").cast("string")).alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("ßé"), F.col("s").cast("string")).alias("source"), F.lit(None).cast("long").alias("n_chars"),
    ).repartition(5)
    check_manifest(spark, tmp_path, docs)


def test_manifest_of_odd_rows(spark, tmp_path, odd_documents, no_documents):
    check_manifest(spark, tmp_path / "odd", odd_documents)
    check_manifest(spark, tmp_path / "none", no_documents)
    clash = spark.createDataFrame([(1, "a", "x", "y", 3), (2, None, None, "z", 4)], "rank long, group string, digest string, item string, path int")
    out = merkle.manifest(clash, "group", ["rank"], merkle.digest_of([F.col("item")]), ["rank", "path", "digest"])
    assert out.columns[:4] == ["rank", "path", "digest", "leaf"] and out.count() == 2


# -- archives ------------------------------------------------------------------------------------------------------------


def bare(digest):
    return base64.b32encode(digest).decode()


def plain_pages(rows):
    firsts = {}
    for page_id, html in rows:
        if page_id is not None:
            firsts[html or ""] = min(firsts.get(html or "", page_id), page_id)
    out = Counter()
    for page_id, html in rows:
        raw, first = (html or "").encode(), firsts.get(html or "")
        own = first is None or page_id == first
        out[(page_id, len(raw), bare(hashlib.sha1(raw).digest()), "response" if own else "revisit", None if own else first)] += 1
    return out


def pages_frame(spark, folder, rows):
    spark.createDataFrame(rows, "page_id long, url string, html string, row string, body int").repartition(3).write.parquet(f"{folder}/pages.parquet")


def test_archives_of_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert Counter(map(tuple, warc.page_archives(spark, sf).collect())) == plain_pages([(r.page_id, r.html) for r in pages])


def test_archives_of_odd_pages(spark, tmp_path):
    rows = [(7, "http://a/ b\r\nX: y", "same"), (3, None, "same"), (9, "http://ü/", "same"), (None, "u", "same"), (1, "u", None), (2, "u", ""), (4, "u", "é" * 200_000 + "漢"), (5, "u", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n"), (6, "u", "\r\n\r\n"), (6, "u", "\r\n\r\n"), (None, "u", "alone"), (None, "u", "alone")]
    rows += [(100 + i, "u", "hot") for i in range(400)]
    pages_frame(spark, tmp_path, [(*r, "x", 1) for r in rows])
    assert Counter(map(tuple, warc.page_archives(spark, str(tmp_path)).collect())) == plain_pages([(r[0], r[2]) for r in rows])
    pages_frame(spark, tmp_path / "none", [])
    assert warc.page_archives(spark, str(tmp_path / "none")).collect() == []


def test_archives_by_sql(spark, sf, tmp_path):
    for folder in (sf, str(tmp_path)):
        if folder != sf:
            pages_frame(spark, folder, [(i, "u", ["one", "two", None, ""][i % 4], "x", i) for i in range(20)] + [(None, "u", "one", "x", 1)])
        con = duckdb.connect()
        places = [f"{folder}/pages.parquet"] if folder == sf else glob.glob(f"{folder}/pages.parquet/*.parquet")
        con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet({places})")
        assert Counter(con.execute(warc.PAGE_ARCHIVES_SQL).fetchall()) == Counter(map(tuple, warc.page_archives(spark, folder).collect()))


def test_small_payloads_and_small_archives(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(warc.with_revisits(df, "page_id", "html", 3), "url", f"file://{tmp_path}/out", archive_bytes=1)
    assert archives.count() == 4 and len(glob.glob(f"{tmp_path}/out/*.warc.gz")) == 4
    read = {r.record_id: r for r in warc.read_archives(archives, keep_payload=True).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in read.items()} == {"1": ("response", None), "2": ("response", None), "3": ("response", None), "4": ("revisit", "3")}
    assert {k: r.payload and bytes(r.payload) for k, r in read.items()} == {"1": b"ab", "2": b"ab", "3": b"abc", "4": None}


def parse(raw):
    return list(warc.read_archive(io.BytesIO(raw), len(raw), keep_payload=True))


def test_reader_frames_every_record():
    bodies = ["", "x" * 300_000, "é\r\n\r\n", "WARC/1.1\r\n\r\n"]
    members = [warc.page_record(i, "http://a/", body) for i, body in enumerate(bodies)]
    found = parse(b"".join(members))
    assert [r["payload"].decode() for r in found] == bodies and all(r["digest_ok"] for r in found)
    assert [r["offset"] for r in found] == [sum(map(len, members[:i])) for i in range(len(members))]
    # members written by another packer
    again = b"".join(gzip.compress(zlib.decompress(m, 31)) for m in members)
    assert [r["payload"].decode() for r in parse(again)] == bodies


def test_reader_passes_damage():
    good = [warc.page_record(i, "u", f"body {i} " * 50) for i in range(4)]
    plain = zlib.decompress(good[1], 31)

    def packed(raw):
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        return c.compress(raw) + c.flush()

    flipped = bytearray(good[1])
    flipped[len(flipped) // 2] ^= 0xFF
    faults = {
        "crc": bytes(flipped), "cut": good[1][: len(good[1]) // 2], "long": packed(plain + b"more"), "short": packed(plain[:-40]),
        "length": packed(plain.replace(b"Content-Length: ", b"Content-Length: x", 1)), "kind": packed(b"nothing"), "noise": b"garbage between members",
    }
    for name, bad in faults.items():
        found = parse(good[0] + bad + good[2] + good[3])
        assert [r["record_id"] for r in found if "error" not in r] == ["0", "2", "3"], name
        assert sum("error" in r for r in found) == 1, name
    assert [("error" in r) for r in parse(good[0] + good[1][:-9])] == [False, True]
    changed = packed(plain.replace(b"body 1 body", b"bode 1 body", 1))
    assert [r["digest_ok"] for r in parse(good[0] + changed)] == [True, False]


def test_wrong_digest_is_told(spark, tmp_path):
    raw = zlib.decompress(warc.page_record(1, "u", "words"), 31).replace(b"words", b"wordy")
    (tmp_path / "a.warc.gz").write_bytes(zlib.compress(raw, wbits=31))
    archives = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",), (None,)], "archive string")
    assert [r.digest_ok for r in warc.read_archives(archives).collect()] == [False]
