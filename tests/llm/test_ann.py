import numpy as np

from geolake.llm import ann


def brute(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, tuple(map(float, np.float32(v)))), None)
    out = []
    for i, v in ok:
        if i % 100:
            continue
        d = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))), j) for j, w in ok if j != i and len(w) == len(v))
        out += [(i, r + 1, j, s) for r, (s, j) in enumerate(d[:k])]
    return sorted(out)


def run(spark, rows, k=10, factor=1.0):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    return sorted(map(tuple, ann.nearest(df, df.where("vec_id % 100 = 0"), k, factor).collect()))


def vectors(n, dim, seed=1):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(8, dim))
    return [(i, [float(x) for x in np.float32(centre[i % 8] + 0.4 * rnd.normal(size=dim))]) for i in range(n)]


def test_exact_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 150)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 4)
    rows = vectors(700, 6)
    rows += [(1000, None), (1100, []), (1200, [0.0] * 6), (1300, [float("nan")] + [1.0] * 5), (1400, [float("inf")] * 6), (1500, [None] + [1.0] * 5),
             (None, rows[3][1]), (1600, [1.0, 2.0]), (1601, [1.0, 2.5]), (1700, [9.0] * 3)]
    rows += [(2000 + i, rows[100][1]) for i in range(30)]            # ties at distance 0
    rows += [rows[100], rows[5]]                                      # repeated rows
    got = run(spark, rows)
    assert [r[:3] for r in got] == [r[:3] for r in brute(rows, 10)]
    assert [r[3] for r in got] == [r[3] for r in brute(rows, 10)]


def test_few_and_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [3.0]), (2, [2.0])]) == [(0, 1, 2, 1.0), (0, 2, 1, 2.0)]


def test_relaxed_pruning_keeps_recall_and_skips_work(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 100_000)
    rows = vectors(4000, 16, seed=2)
    exact = {r[:1] + r[2:3] for r in run(spark, rows)}
    near = {r[:1] + r[2:3] for r in run(spark, rows, factor=0.7)}
    assert len(exact & near) / len(exact) >= 0.9


def test_query_id_with_several_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 150)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 2)
    rows = vectors(600, 6)
    for i in (100, 300):
        rows += [(i, [x + s for x in rows[i + 7][1]]) for s in (0.01, 0.02, 3.0)] + [(i, [1.0, 2.0])]
    rows += [(601, [1.0, 2.5]), (602, rows[1][1]), (602, rows[2][1]), rows[100]]
    expected, vecs = {}, {}
    for i, v in rows:
        vecs.setdefault(i, {})[tuple(map(float, np.float32(v)))] = None
    for q in (x for x in vecs if x % 100 == 0):
        best = []
        for j, many in vecs.items():
            for w in many if j != q else ():
                d = [float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))) for v in vecs[q] if len(v) == len(w)]
                best += [(min(d), j)] if d else []
        expected[q] = sorted(best)[:10]
    got, want = run(spark, rows), sorted((q, r + 1, j, s) for q, best in expected.items() for r, (s, j) in enumerate(best))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=0)


def test_many_repeats_of_a_vector_and_of_an_id(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 60)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 3)
    rows = vectors(300, 5)
    rows += [(10_000 + i, rows[200][1]) for i in range(400)]          # one vector, many ids: ties by id
    rows += [(100, [x + 0.001 * s for x in rows[7][1]]) for s in range(200)]   # one query id, many vectors
    rows += [rows[50]] * 300                                           # one row many times
    items = ann._items(spark.createDataFrame(rows, "id long, vec array<double>"), 10)
    assert items.count() < 520 and max(len(r.ids) for r in items.collect()) <= 11
    got, want = run(spark, rows), {}
    vecs = {}
    for i, v in rows:
        vecs.setdefault(i, {})[tuple(map(float, np.float32(v)))] = None
    for q in (x for x in vecs if x % 100 == 0):
        mine = np.array(list(vecs[q]))
        best = [(float(np.sqrt(((mine - np.array(w)) ** 2).sum(axis=1)).min()), j) for j in vecs if j != q for w in vecs[j]]
        want[q] = [j for _, j in sorted(best)[:10]]
    assert {q: [r[2] for r in got if r[0] == q] for q in want} == want


def test_queries_go_only_where_they_must(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 100)
    sent = []
    real = ann._searched
    monkeypatch.setattr(ann, "_searched", lambda items, asked, k, factor: sent.append(asked.count()) or real(items, asked, k, factor))
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in 50 * (i % 10) + rnd.normal(size=4)]) for i in range(2000)]   # ten far clusters
    assert run(spark, rows) == brute(rows, 10) or [r[:3] for r in run(spark, rows)] == [r[:3] for r in brute(rows, 10)]
    assert sent[0] == 20 and sent[1] < 20 * 10   # of some twenty regions
