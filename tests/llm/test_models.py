import re
import zlib

import numpy as np
import pytest

from geolake.llm import catalog, quality, toxicity

SF = "/root/testdata/sf0.01"
EDGE = [(None, "some text"), (1, None), (2, ""), (3, " \n"), (4, "***"), (5, "word " * 50000), (5, "again"), (6, "Ünï 漢字 🙂")]


def edge_docs(spark):
    return spark.createDataFrame([(i, t, 0.5, "k", 1) for i, t in EDGE], "doc_id long, text string, score double, k string, toxic int")


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_on_held_out_rows(spark, labels):
    rows = catalog.queries()["op5_quality"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.predicted, labels[r.doc_id].quality) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) >= 0.93


def test_quality_learns_outside_the_held_out_fold_only(spark):
    docs, lab = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = lab.withColumn("quality", quality.F.when(quality.held_out(quality.F.col("doc_id")), 1 - quality.F.col("quality"))
                            .otherwise(quality.F.col("quality")))
    a, b = quality.fit(docs, lab), quality.fit(docs, turned)
    assert (a[0] == b[0]).all() and a[1] == b[1]


def test_quality_edge_cases(spark):
    docs = edge_docs(spark)
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, none)
    out = quality.score(docs, model).collect()
    assert len(out) == len(EDGE) and all(r.score == 0.5 and r.predicted == 1 for r in out)
    some = spark.createDataFrame([(5, 0), (6, 1), (6, 1), (2, 1)], "doc_id long, quality int")
    assert len(quality.score(docs, quality.fit(docs, some)).collect()) == len(EDGE)
    assert quality.score(docs.limit(0), model).count() == 0


def test_toxicity_on_unlabelled_rows(spark, labels):
    words = re.compile(r"\b(idiot|pathetic|loser|scum|worthless|clown|disgusting|moron|stupid|trash)\b", re.I)
    texts = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.queries()["op4_toxicity"](spark, SF).collect()
    assert len(rows) == len(texts)
    new = [r for r in rows if r.doc_id not in labels and texts[r.doc_id].lang == "en"]
    bad = [r.is_toxic for r in new if words.search(texts[r.doc_id].text or "")]
    good = [r.is_toxic for r in new if not words.search(texts[r.doc_id].text or "")]
    assert np.mean(bad) >= 0.9 and np.mean(good) <= 0.01


def test_chain_uses_out_of_fold_predictions_and_all_links():
    rnd = np.random.default_rng(0)
    terms = np.unique(rnd.integers(1, 1 << 60, size=200).astype(np.uint64))
    sets, y = [], []
    for i in range(600):
        own = set(rnd.choice(terms[20:], 15))
        y.append(int(i % 4 == 0))
        if y[-1]:
            own |= set(rnd.choice(terms[:20], rnd.integers(1, 6)))
        sets.append(np.array(sorted(own), np.uint64))
    chain = toxicity.fit_chain(sets, np.array(y))
    assert [len(v) for _, v, _ in chain["links"]] == [0, 1, 2]
    p = toxicity.predict(chain, sets)
    assert p.shape == (600, len(toxicity.CATEGORIES)) and ((p[:, -1] >= chain["threshold"]) == np.array(y)).mean() >= 0.98


def test_toxicity_edge_cases(spark):
    docs = edge_docs(spark)
    one_class = spark.createDataFrame([(1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    chain = toxicity.fit(docs, one_class)
    assert chain is None
    out = toxicity.score(docs, chain).collect()
    assert len(out) == len(EDGE) and not any(r.is_toxic for r in out)
    kept = toxicity.remove_toxic(docs, chain)
    assert kept.columns == docs.columns and kept.count() == len(EDGE)
    both = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (6, 0), (2, 0)], "doc_id long, toxic int")
    assert len(toxicity.score(docs, toxicity.fit(docs, both)).collect()) == len(EDGE)
    assert toxicity.score(docs.limit(0), chain).count() == 0


def test_toxicity_out_of_fold_scores_see_nothing_of_their_fold():
    rnd = np.random.default_rng(3)
    terms = np.unique(rnd.integers(1, 1 << 60, size=8000).astype(np.uint64))
    y = (np.arange(900) // 3 % 2).astype(float)  # labels that no term explains
    sets = [np.unique(rnd.choice(terms, 200)) for _ in y]
    p = toxicity.out_of_fold(sets, y)[:, -1]
    bad, good = p[y == 1], p[y == 0]
    above = (bad[:, None] > good[None, :]).mean() + 0.5 * (bad[:, None] == good[None, :]).mean()
    assert abs(above - 0.5) < 0.06


def test_toxicity_learns_terms_of_few_toxic_rows(spark):
    # In 0.6 % of 8,000 toxic rows, and no other sign of toxicity there.
    n = 8000
    bad = [f"w{i % 97} x{i % 89} " + ("zorgle" if i % 167 == 0 else "idiot") for i in range(n)]
    good = [f"w{i % 97} x{i % 89} fine" for i in range(n)]
    rows = [(i, t, int(i < n)) for i, t in enumerate(bad + good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    chain = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", docs.y.alias("toxic")))
    new = spark.createDataFrame([(1, "you zorgle"), (2, "you idiot"), (3, "w1 x1 fine")], "doc_id long, text string")
    assert [r.is_toxic for r in sorted(toxicity.score(new, chain).collect())] == [True, True, False]
    assert toxicity.THRESHOLD[0] == 0.1


def test_toxicity_counts_in_spark_give_the_model_of_whole_sets(spark):
    docs, lab = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.fit(docs, lab, 60)
    known = lab.groupBy("doc_id").agg(toxicity.F.max("toxic").alias("y"))
    rows = []
    for c in (0, 1):
        rows += known.where(known.y == c).orderBy(toxicity.F.xxhash64("doc_id"), "doc_id").limit(60).join(docs, "doc_id").collect()
    rows.sort(key=lambda r: r.doc_id)
    whole = toxicity.fit_chain(list(toxicity.term_sets(toxicity.pa.array([r.text for r in rows]))), np.array([r.y for r in rows]))
    assert (chain["vocab"] == whole["vocab"]).all() and len(chain["vocab"]) >= 3 and chain["threshold"] == whole["threshold"]
    for (w, v, b), (w2, v2, b2) in zip(chain["links"], whole["links"]):
        assert (w == w2).all() and (v == v2).all() and b == b2


def test_toxicity_learns_from_a_repeated_id_once(spark):
    rows = [(i, f"calm words number {i}", 0) for i in range(20)] + [(100 + i, f"awful nasty vile {i}", 1) for i in range(20)]
    docs = spark.createDataFrame([(i, t, 1.0, "k") for i, t, _ in rows], "doc_id long, text string, fold double, terms string")
    lab = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    once = toxicity.fit(docs, lab)
    again = toxicity.fit(docs.unionByName(docs.where("doc_id = 100")).unionByName(docs.where("doc_id = 100")), lab)
    assert (once["vocab"] == again["vocab"]).all() and once["threshold"] == again["threshold"]
    assert (once["links"][0][0] == again["links"][0][0]).all()
