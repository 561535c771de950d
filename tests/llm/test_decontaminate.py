import hashlib
import random
import re

from pyspark.sql import functions as F

from geolake.llm import decontaminate as dc


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(len(w), 10)
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if (own := windows.get(tuple(w[i:i + k]))) is not None:
                    hit |= set(range(i, i + k))
                    found |= own
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(spark, docs, items):
    d = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, item string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")
    return sorted(map(tuple, dc.decontaminate(d, b).collect()), key=str)


def fixture():
    rnd = random.Random(11)
    vocab = ["a", "b", "çé", "d1", "E", "f"]
    text = lambda n: rnd.choice([" ", ", ", "--"]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([10, 11, 14, 30]))) for i in range(12)]
    items += [(20, "only four short words"), (21, "nine " * 9), (22, ""), (23, None), (24, "!!!"), (25, items[0][1]), (None, items[3][1]),
              (20, "only four short words")]
    docs = []
    for i in range(60):
        parts = [text(rnd.randint(0, 25))]
        if rnd.random() < 0.6:
            own = words(rnd.choice(items)[1])
            cut = rnd.randint(0, 3)
            parts += [" ".join(own[cut:]).upper() if rnd.random() < 0.3 else " ".join(own[cut:]), text(rnd.randint(0, 12))]
        docs.append((i, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, "..."), (103, "x " * 20000 + items[1][1]), (104, "here are Only Four short-words again"),
             (105, "nine " * 8), (None, items[2][1]), (None, "clean"), (106, items[2][1]), (106, items[2][1]), (106, "another text")]
    return docs, items


def test_against_brute_force_with_edge_cases(spark):
    docs, items = fixture()
    assert got(spark, docs, items) == brute(docs, items)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs, items = fixture()
    monkeypatch.setattr(dc, "BROADCAST_ROWS", -1)
    assert got(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b c")]) == []
    assert got(spark, [(1, "a b c")], []) == brute([(1, "a b c")], [])


def test_pipeline_form(spark):
    docs, items = fixture()
    clean = {(i, t) for (i, t) in docs if not brute([(i, t)], items)[0][5]}
    d = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, x2 string")
    out = dc.remove_contaminated(d, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == d.columns
    assert {(r.doc_id, r.text) for r in out.collect()} == clean


def test_no_python_in_the_plan(spark):
    docs, items = fixture()
    df = dc.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert df.select(F.count("*")).first()[0] == len(docs)
