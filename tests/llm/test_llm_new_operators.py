"""Periodic runs, hard negatives and address filters against brute-force versions, and their defined results for odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenweave.llm import hard_negatives, periodic_runs, queries, url_filter

FOLDER = "/root/testdata/sf0.001"
FIND = re.compile(r"[^\x20\x09-\x0D]+").findall


# --- periodic runs -----------------------------------------------------------------------------------------------------------


def brute_runs(words, least=6, times=4):
    """All maximal stretches for every period; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_row(doc_id, text):
    words = planted(doc_id, FIND(text or ""))
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_of_random_words():
    rnd, n = random.Random(5), 0
    for least, times in ((6, 4), (2, 2), (3, 3)) * 40:
        texts = []
        for _ in range(rnd.randint(0, 9)):
            words = [rnd.choice("abcd"[: rnd.randint(1, 4)]) for _ in range(rnd.randint(0, 50))]
            if words and rnd.random() < 0.5:
                a, p = rnd.randrange(len(words)), rnd.randint(1, 7)
                words = words[:a] + [words[(a + (i - a) % p) % len(words)] for i in range(a, len(words))]
            texts.append(" ".join(words))
        runs, counts, kept = periodic_runs._slice(texts, least, times)
        for text, found in zip(texts, runs.to_pylist(), strict=True):
            want = brute_runs(text.split(), least, times)
            assert [(r["start"], r["length"], r["period"]) for r in found] == want
            n += len(want)
    assert n > 500


def test_runs_query_over_documents(spark, rows):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    short = {r["doc_id"]: r["text"] for r in docs.collect() if len(r["text"] or "") < 6000}
    assert len(short) > 150
    got = {r[0]: tuple(r) for r in queries.op11_periodic_runs(spark, FOLDER).collect()}
    assert len(got) == docs.count()
    for doc_id, text in short.items():
        assert got[doc_id] == brute_row(doc_id, text)
    assert sum(r[1] for r in got.values()) > 5


ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a " * 6), (5, "a " * 6), (None, "x y " * 9), (None, None), (7, "a b a b a b a"), (8, "a b " * 4),
    (9, "q " * 30000), (10, " ".join(f"w{i % 977}" for i in range(5000))), (11, "é ñ " * 5 + "漢 😀 " * 7), (16, "z" * 100_000), (12, "\x00 \x1c \x00 \x1c " * 3),
    *((i, "one two three four five six seven eight nine ten " * 3) for i in range(20, 60)),
]


def test_runs_of_odd_texts(spark, rows):
    docs = spark.createDataFrame([(i, t, "s", 1, "c") for i, t in ODD_TEXTS], "doc_id long, text string, runs string, start int, top string")
    text = periodic_runs.with_period(F.col("text"), F.col("doc_id"))
    got = rows(periodic_runs.digests(periodic_runs.find_runs(docs.withColumn("text", text))))
    long_ = {9, 10}
    want = sorted((brute_row(i, t) for i, t in ODD_TEXTS if i not in long_), key=repr)
    assert [r for r in got if r[0] not in long_] == want
    assert [r[1:6] for r in got if r[0] == 9] == [(1, 0, 30000, 1, 30000000)]
    assert [r[1:6] for r in got if r[0] == 10] == [(1, 0, 5000, 977, 5117)]
    whole = periodic_runs.find_runs(docs.filter("doc_id = 8")).first()
    assert (whole["n_words"], whole["collapsed"], [tuple(r) for r in whole["runs"]]) == (8, "a b", [(0, 8, 2)])
    assert periodic_runs.digests(periodic_runs.find_runs(docs.limit(0))).collect() == []


# --- hard negatives ----------------------------------------------------------------------------------------------------------


def brute_negatives(rows, every, positives, negatives):
    usable = [
        (i, label, np.floor(256 * np.array(x, dtype=np.float64))) for i, x, label in rows
        if label is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)
    ]
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for i, label, x in usable:
        if i is None or i % every:
            continue
        scored = [(int(x @ y), j, other) for j, other, y in usable if len(y) == len(x) and j != i]
        for p, j in sorted(((s, j) for s, j, other in scored if other == label), key=order)[:positives]:
            near = sorted(((s, k) for s, k, other in scored if other != label and 30 * p <= 100 * s <= 90 * p), key=order)[:negatives]
            out += [(i, j, r + 1, k, p, s) for r, (s, k) in enumerate(near)]
    return sorted(out, key=repr)


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, x string, score int")


@pytest.mark.parametrize("block", [4 * 8 * 64, 1 << 20])
def test_negatives_of_clusters(spark, rows, block):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(12, 8))
    some = [(i, (centres[i % 12] + 0.2 * rnd.normal(size=8)).astype(np.float32).tolist(), i % 5) for i in range(900)]
    some += [(10_000 + i, some[0][1], i % 3) for i in range(300)]  # a third are copies of one vector
    got = rows(hard_negatives.mine(vectors_of(spark, some), 20, 5, 10, block_bytes=block, tile=7, zones=32))
    assert got == brute_negatives(some, 20, 5, 10) and len(got) > 2000


def test_zone_maps_spare_blocks(spark):
    rnd = np.random.default_rng(4)
    centres = 3 * np.eye(10)
    some = [(i, (centres[i % 10] + 0.05 * rnd.normal(size=10)).astype(np.float32).tolist(), (i // 10) % 2) for i in range(4000)]
    clean = vectors_of(spark, some).select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    n, spread = hard_negatives._spread(clean, 256)
    blocks = hard_negatives.stage(hard_negatives._blocks(hard_negatives._placed(clean, spread, 256), n, 4 * 10 * 64), "blocks")
    zones = blocks.withColumn("chunk", F.lit(0).cast("long")).groupBy("dim", "chunk").agg(*(
        F.collect_list(c).alias(to) for c, to in (("block", "blocks"), ("low", "lows"), ("high", "highs"), ("label_low", "label_lows"), ("label_high", "label_highs"))))
    tiles = hard_negatives._tiles(blocks, 10, 5, 64)
    read = hard_negatives._needs(tiles, zones, True, False).agg(F.sum("n")).first()[0]
    assert n == 4000 and read < 0.5 * 400 * blocks.count()


def test_negatives_of_odd_rows(spark, rows):
    rnd = np.random.default_rng(5)
    unit = lambda n: rnd.normal(size=n).astype(np.float32).tolist()
    some = [(i, unit(4), i % 2) for i in range(60)] + [(i, unit(3), i % 2) for i in range(60, 90)] + [(i, [], i % 2) for i in range(90, 99)]
    some += [(100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [float("nan")] * 4, 0), (103, [float("inf"), 0.0, 0.0, 0.0], 0), (104, unit(4), None)]
    some += [(None, unit(4), 0), (None, unit(4), 1), (None, None, None), (None, [0.0] * 4, 1), (105, [0.0] * 4, 0)]
    some += [(3, unit(4), 1), (10, unit(4), 0), (10, some[10][1], 0), (200, [70000.0, 0.0, 0.0, 0.0], 0), (201, [40000.0, 1.0, 0.0, 0.0], 1), (202, [60000.0] * 4, 0)]
    got = rows(hard_negatives.mine(vectors_of(spark, some), 5, 5, 10))
    assert got == brute_negatives(some, 5, 5, 10) and any(r[3] is None for r in got) and len({r[0] for r in got}) > 15
    huge = [(i, [3e38 if i % 3 else -3e38, 1e30], i % 2) for i in range(12)]
    assert all(abs(r[4]) < 2**63 for r in rows(hard_negatives.mine(vectors_of(spark, huge), 5, 5, 10)))
    assert hard_negatives.mine(vectors_of(spark, some).limit(0), 5, 5, 10).collect() == []
    assert hard_negatives.mine(vectors_of(spark, [(1, [1.0], 1), (5, [1.0], 1)]), 5, 5, 10).collect() == []


def test_hilbert_neighbours():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = hard_negatives.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(place)], axis=0))
        assert (steps.sum(axis=1) == 1).all()


# --- address filter ----------------------------------------------------------------------------------------------------------


def brute_address(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def brute_rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


ADDRESSES = [
    None, "", "no address", "http://", "http://com", "http://com/", "HTTP://A.COM/x?y#z", "https://example.com/en/1", "https://www.Example.com/en/1",
    "http://xwww.example.com/en/", "http://notexample.com/en/", "http://a.www.example.com/en/", "http://example.com/EN/", "http://example.com/en", "http://a.net/es/",
    "http://net/fr/?a=1&b=2", "http://net?/fr/", "http://net#/fr/", "http://a.org/b://c/d", "//x.com/", "a://b?c://d.com/", "http://u:p@x.com:80/q",
    "http://é.com/ü?ß", "http://ÄBC.NET/es/x", "http://x.com\n/en/", "http://" + "y" * 50_000 + ".com/" + "z/" * 10_000, "http://a..com/", "http://.com/", "http://a.com./",
]


def test_addresses_and_rules(spark, rows):
    pages = spark.createDataFrame([(i, u, "h", "r", 1) for i, u in enumerate(ADDRESSES)], "page_id long, url string, html string, rule string, score int")
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    for i, url in enumerate(ADDRESSES):
        host, path = brute_address(url)
        rule, says = brute_rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == (says or ("block" if got[i]["score"] >= 0.5 else "allow"))
    assert url_filter.judge(pages.limit(0)).collect() == []
    odd = spark.createDataFrame([(None, None), (None, None), (1, "http://a.org/"), (1, "http://a.org/")], "page_id long, url string")
    assert {tuple(r)[3:5] for r in url_filter.judge(odd).collect()} == {(None, "block")}  # no labels: an even chance


def test_filter_over_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r["page_id"]: r for r in queries.op13_url_filter(spark, FOLDER).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        host, path = brute_address(r["url"])
        rule, says = brute_rule(host, path)
        row = got[r["page_id"]]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule) and row["verdict"] in ({says} if says else {"allow", "block"})


def brute_trees(cells, features, trees, depth, rate):
    """The same boosting on a list of rows (features, y, n), one node at a time."""
    n, blocked = sum(c[2] for c in cells), sum(c[1] * c[2] for c in cells)
    share = (blocked + 1) / (n + 2)
    margin = [np.log(share / (1 - share))] * len(cells)
    gain = lambda g, h: g * g / (h + 1)
    for _ in range(trees):
        p = [1 / (1 + np.exp(-m)) for m in margin]
        unit = url_filter.UNIT
        g = [round((q - c[1]) * unit) * c[2] / unit for q, c in zip(p, cells, strict=True)]
        h = [round(q * (1 - q) * unit) * c[2] / unit for q, c in zip(p, cells, strict=True)]

        def grow(rows, left, g=g, h=h):
            g_all, h_all = sum(g[i] for i in rows), sum(h[i] for i in rows)
            best, top = None, 1e-6
            for f in range(features) if left else ():
                for step in sorted({cells[i][0][f] for i in rows})[:-1]:
                    low = [i for i in rows if cells[i][0][f] <= step]
                    gl, hl = sum(g[i] for i in low), sum(h[i] for i in low)
                    if min(hl, h_all - hl) >= 1 and (won := gain(gl, hl) + gain(g_all - gl, h_all - hl) - gain(g_all, h_all)) > top + 1e-9:
                        best, top = (low, [i for i in rows if cells[i][0][f] > step]), won
            if best:
                return grow(best[0], left - 1) | grow(best[1], left - 1)
            return dict.fromkeys(rows, -rate * g_all / (h_all + 1))

        change = grow(list(range(len(cells))), depth)
        margin = [m + change[i] for i, m in enumerate(margin)]
    return margin


def test_trees_against_plain_ones(spark):
    rnd = random.Random(9)
    cells = [((a, b, c), int(rnd.random() < (0.9 if a > 3 and b < 5 else 0.2)), rnd.randint(1, 6)) for a in range(8) for b in range(8) for c in range(3)]
    frame = spark.createDataFrame([(*x, y, n) for x, y, n in cells], "a int, b int, c int, y int, n long")
    start, trees = url_filter.grow(frame, ("a", "b", "c"), 4, 3, 0.4)
    got = {(r["a"], r["b"], r["c"]): r["m"] for r in frame.withColumn("m", sum(trees, F.lit(start))).collect()}
    for (x, _, _), m in zip(cells, brute_trees(cells, 3, 4, 3, 0.4), strict=True):
        assert abs(got[x] - m) < 1e-4


def test_held_out_addresses(spark):
    """Rules are learned from four fifths of the hosts' pages and tell the rest apart."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    known = url_filter.described(pages, url_filter.RULES).withColumn("truth", F.col("said"))
    known = known.withColumn("said", F.when(F.col("page_id") % 5 > 0, F.col("said")))
    for key in url_filter.KEYS:
        known = url_filter.with_statistics(known, key)
    apart = known.withColumn("score", url_filter.train(known)).filter("page_id % 5 = 0 and truth is not null")
    right = apart.agg(F.avg(((F.col("score") >= 0.5) == (F.col("truth") == "block")).cast("int"))).first()[0]
    assert right > 0.95
