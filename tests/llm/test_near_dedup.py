import random
import re

import numpy as np
import pyarrow as pa

import pytest

from geolake.llm import near_dedup as nd
from geolake.llm.components import components
from geolake.operators.graph import connected_components
from geolake.llm.text import shingle_sets


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None:
                continue
            both = len(sets[a] & sets[b])
            if rows[a][0] == rows[b][0] and sets[a] and sets[b] or both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(rows[a][0]), find(rows[b][0])
                parent[max(x, y)] = min(x, y)
    out = []
    for (i, _), s in zip(rows, sets):
        comp = None if i is None else find(i) if s else i
        out.append((i, len(s), comp, comp is None or comp == i))
    return sorted(out, key=str)


def got(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, comp string, n int")
    return sorted(map(tuple, nd.near_duplicates(docs).collect()), key=str)


def fixture():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    rows, n = [], 0
    for _ in range(60):
        base = [word() for _ in range(rnd.choice([1, 3, 4, 5, 6, 30, 80, 200]))]
        for _ in range(rnd.choice([1, 1, 2, 4])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 6, 20])):
                if len(copy) > 10:
                    copy[rnd.randrange(len(copy))] = word()
            rows.append((n, rnd.choice([" ", "\n", " \t "]).join(copy)))
            n += 1
    return rows


def test_against_brute_force_with_edge_cases(spark):
    rows = fixture()
    # A drifting chain: neighbours are near, ends are not.
    text = [f"w{i}" for i in range(120)]
    for k in range(12):
        rows.append((1000 + k, " ".join(text)))
        text[k * 9:k * 9 + 2] = [f"z{k}", f"y{k}"]
    hot = [f"h{i}" for i in range(150)]
    rows += [(2000 + k, " ".join(hot)) for k in range(40)]                        # exact copies
    for k in range(40):                                                          # near copies
        rows.append((3000 + k, " ".join(hot[:k] + [f"q{k}"] + hot[k + 1:])))
    shared = [f"s{i}" for i in range(60)]                                        # a passage, below the threshold
    rows += [(4000 + k, " ".join(shared + [f"u{k}_{i}" for i in range(25)])) for k in range(30)]
    rows += [(5000, None), (5001, ""), (5002, " \n\t "), (5003, "One"), (5004, "one"), (5005, "ÉTÉ"), (5006, "été"),
             (None, "one"), (None, None), (5007, "x y"), (5008, "a " * 30000)]
    rows += [rows[0], rows[1]]                                                   # repeated rows
    rows += [(1, "entirely another text of that very document here")]             # one id, two texts
    assert got(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_pipeline_form_keeps_one_row_of_each_group(spark):
    rows = [(3, "a b c d e f g", "x"), (1, "a b c d e f g", "y"), (1, "a b c d e f g", "y"), (None, "a b c d e f g", None),
            (7, None, None), (8, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = nd.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[1], rows[3], rows[4], rows[5]], key=str)


def test_columns_of_any_name_keep_their_values(spark):
    rows = [(1, "a b c d e f g", "own", 7, 1, "k", 0.5), (2, "a b c d e f g", "x", 8, 2, "l", 1.5), (3, "other words here", "y", 9, 3, "m", 2.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own string, place int, `order` int, keep_key string, `a.b` double")
    out = nd.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == [rows[0], rows[2]]


def test_hot_sets_are_salted(spark, monkeypatch):
    monkeypatch.setattr(nd, "HOT_SETS", 3)
    rows = [(i, "the very same words again and again") for i in range(60)] + [(100 + i, f"other text number {i} of some") for i in range(30)]
    rows += [(5, "the very same words again and again")] * 20 + [(None, "the very same words again and again")]
    assert got(spark, rows) == brute(rows)


def test_registers_merge_and_estimate():
    rnd = np.random.default_rng(1)
    a = rnd.integers(1 << 62, size=900).astype(np.uint64)
    b = np.concatenate([a[:850], rnd.integers(1 << 62, size=50).astype(np.uint64)])
    ra, rb, both = nd.registers([a, b, np.union1d(a, b)])
    assert (np.maximum(ra, rb) == both).all()
    more, less = [(ra > rb).sum()], [(ra < rb).sum()]
    assert nd.likely(more, less, [900], [900], 75)[0]
    far = nd.registers([a, rnd.integers(1 << 62, size=900).astype(np.uint64)])
    assert not nd.likely([(far[0] > far[1]).sum()], [(far[0] < far[1]).sum()], [900], [900], 75)[0]


def test_shingle_sets_do_not_depend_on_chunks(monkeypatch):
    from geolake.llm import text
    texts = ["a b c d e f", None, "", "x", "A  B\nc D e"] * 20
    before = [s.tolist() for s in shingle_sets(pa.array(texts))]
    monkeypatch.setattr(text, "CHUNK_BYTES", 7)
    assert [s.tolist() for s in shingle_sets(pa.array(texts))] == before
    assert [s.tolist() for s in shingle_sets(pa.array(texts).slice(3, 4))] == before[3:7]


@pytest.mark.parametrize("connected_components", [connected_components, components])
def test_components_against_union_find(spark, connected_components):
    rnd = random.Random(9)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {v for e in edges if e[0] != e[1] for v in e}
    assert {r.id: r.comp for r in out} == {v: find(v) for v in nodes} and len(out) == len(nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
