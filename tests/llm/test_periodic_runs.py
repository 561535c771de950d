import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from geolake.llm import periodic_runs as pr

SPACES = r"[\x20\x09-\x0D]+"


def words_of(text):
    return [w for w in re.split(SPACES, text or "") if w]


def brute(w):
    """All runs by comparing every pair of words at every distance."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)  # smallest distance first
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(w, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def some_words(rnd):
    letters = "abcdefghijklmnopqrstuvwxyzé"[:rnd.choice([1, 2, 2, 3, 5, 27])]
    w = [rnd.choice(letters) * rnd.choice([1, 1, 2]) for _ in range(rnd.choice([0, 3, 11, 12, 13, 40, 100, 300, 700]))]
    for _ in range(rnd.randint(0, 4)):
        if len(w) > 10:
            a = rnd.randrange(len(w))
            p = rnd.randint(1, max(1, (len(w) - a) // 2))
            for i in range(a, rnd.randint(a, len(w))):
                w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    docs = [some_words(rnd) for _ in range(60)]
    texts = [rnd.choice([" ", "\n ", "\t"]).join(d) + rnd.choice(["", " "]) for d in docs]
    runs, kept = [], []
    for r, t in pr.runs_of_texts(pa.array(texts)):
        runs += r.to_pylist()
        kept += t.to_pylist()
    for w, r, t in zip(docs, runs, kept, strict=True):
        expected = brute(w)
        assert [(x["start"], x["length"], x["period"]) for x in r] == expected
        assert t == collapse(w, expected)


@pytest.mark.parametrize("size", [2, 4, 16, 64])
def test_transform_counts_squared_differences(size):
    rng = np.random.default_rng(size)
    blocks = rng.integers(0, pr.PRIME, (5, size)).astype(np.uint64)
    windows = rng.integers(0, pr.PRIME, (5, 3 * size - 1)).astype(np.uint64)
    windows[2, size - 1:2 * size - 1] = blocks[2]
    got = pr.mismatches(blocks, windows, pr.Transform(4 * size))
    for i in range(5):
        for j in range(2 * size):
            exact = sum((int(a) - int(b)) ** 2 for a, b in zip(blocks[i], windows[i, j:j + size])) % pr.PRIME
            assert int(got[i, j]) == exact
    assert got[2, size - 1] == 0


def test_long_texts_of_few_words():
    a, b = "a", "ab"
    while len(b) < 3000:
        a, b = b, b + a
    for w in (["x"] * 30_000, [str(i % 777) for i in range(30_000)], list(b[:3000])):
        (runs, text), = pr.runs_of_texts(pa.array([" ".join(w)]))
        found = [(r["start"], r["length"], r["period"]) for r in runs.to_pylist()[0]]
        if len(w) < 10_000:
            assert found == brute(w)
        else:
            assert found == [(0, len(w), len(set(w)))]
            assert text.to_pylist() == [" ".join(w[:len(set(w))])]


def expected_row(doc_id, text):
    w = words_of(text)
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    runs = brute(w)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *top, top[0] if top[0] is None else 1000 * top[1] // top[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapse(w, runs).encode()).hexdigest())


def test_query_rows_equal_brute_force(spark):
    rnd = random.Random(9)
    rows = [(i, " ".join(some_words(rnd))) for i in range(150)]
    rows += [(7, rows[7][1]), (None, "a b " * 9), (None, None), (500, None), (501, ""), (502, " \n\t"), (503, "one"),
             (504, "x y " * 15), (505, "a b c d e f a b c d e f")]
    docs = spark.createDataFrame([(i, t, 1, "k", [2]) for i, t in rows], "doc_id long, text string, k int, runs string, collapsed array<int>")
    from pyspark.sql import functions as F
    texts = docs.withColumn("text", pr.planted(F.col("text"), F.col("doc_id")))
    got = [tuple(r) for r in pr.digests(pr.periodic_runs(texts)).collect()]
    assert sorted(got, key=str) == sorted((expected_row(i, t) for i, t in rows), key=str)
    assert sum(r[1] for r in got) > 20


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pr.digests(pr.periodic_runs(docs)).collect() == []
