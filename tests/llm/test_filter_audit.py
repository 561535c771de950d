import itertools
import random
import re

from geolake.llm import filter_audit as fa


def fails(rows):
    out = []
    for i, _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        f = ""
        f += "A" * (len(w) < 50)
        f += "B" * (100 * len(set(w)) < 65 * len(w))
        f += "C" * (100 * len(re.findall("[A-Z]", t or "")) > 5 * len(t or ""))
        f += "D" * bool(re.search(r"[#$%&*|]", t or ""))
        f += "E" * any(j is not None and i is not None and j < i and (u or "") == (t or "") for j, _, u in rows)
        out.append(set(f))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, failed = [], fails(rows)
    for part in {p or "" for _, p, _ in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failed) if (r[1] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in itertools.permutations("ABCDE"):
            for k, letter in enumerate(order):
                gone = [(i, f) for i, f in mine if letter in f and not f & set(order[:k])]
                shapley[letter] += len(gone)
                lines.append((part, "".join(order), k + 1, sum(not f & set(order[:k + 1]) for _, f in mine), len(gone),
                              sum(letter in f for _, f in mine) - len(gone), sum(f == {letter} for _, f in mine),
                              sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter))
        out += [(*x[:-1], shapley[x[-1]]) for x in lines]
    return sorted(out)


def rows_and_labels(seed):
    rnd = random.Random(seed)
    texts = [None, "", " \n", "word " * 60, "One Two THREE", "a$b"]
    texts += [" ".join(rnd.choice(["w%d" % rnd.randrange(80), "X", "é"]) for _ in range(rnd.choice([5, 49, 50, 70, 200]))) + rnd.choice(["", "|"])
              for _ in range(30)]
    rows = [(i, rnd.choice([None, "", "web", "book"]), rnd.choice(texts)) for i in range(150)]
    rows += [rows[3], rows[3], (None, "web", texts[3]), (None, None, None), (3, "other", texts[8])]
    rows += [(1000 + i, "hot", "the very same text #") for i in range(300)]
    rnd.shuffle(rows)
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 200, 2)] + [(4, 1, 1), (None, 1, 1)]
    return rows, labels


def test_figures_equal_brute_force(spark):
    rows, labels = rows_and_labels(1)
    docs = spark.createDataFrame([(*r, 5, "x", 0) for r in rows], "doc_id long, source string, text string, bits int, part string, n int")
    lab = spark.createDataFrame([(*x, "h") for x in labels], "doc_id long, quality int, toxic int, h string")
    got = sorted(tuple(r) for r in fa.audit_filters(docs, lab).collect())
    assert got == brute(rows, labels)


def test_steps_add_up(spark):
    rows, labels = rows_and_labels(2)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = fa.audit_filters(docs, lab).collect()
    size = {p: sum((r[1] or "") == p for r in rows) for p in {r[1] or "" for r in rows}}
    for part, n in size.items():
        for order in fa.ORDERS:
            mine = {r.step: r for r in got if r.part == part and r.filter_order == order}
            assert len(mine) == 5 and n == mine[5].kept + sum(r.removed for r in mine.values())
        once = {r.filter_order[r.step - 1]: r.shapley for r in got if r.part == part}
        assert sum(once.values()) == 120 * (n - mine[5].kept)
    assert all(r.good_lost == r.toxic_lost == 0 for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    lab = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert fa.audit_filters(docs, lab).collect() == []
