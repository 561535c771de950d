import re

import corpus_pipeline as cp
from geolake.llm.text import shingle_sets  # noqa: F401  (the package is importable)

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_columns(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (_, step) in enumerate(cp.STAGES):
        docs = step(spark, docs, SF)
        if k + 1 < len(cp.STAGES):
            assert docs.columns == columns
            docs = cp.stage(docs, "test")
    assert docs.columns == ["doc_id", "n_tokens", "ids"] and 0 < docs.count() < 200


def test_stages_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, k string"
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, "a", "b"), (2, "mail jo@ex.org now", "en", "s", 18, "a", "b"),
            (2, "mail jo@ex.org now", "en", "s", 18, "a", "b"), (3, "x " * 9000, "en", "s", 18000, None, None), (4, "Word", "en", "s", 4, "", "")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, step in cp.STAGES[:-1]:
            docs = step(spark, docs, SF)
            assert docs.columns == [c.split()[0] for c in schema.split(", ")], name
            docs = cp.stage(docs, "odd")
        out = cp.STAGES[-1][1](spark, docs, SF).collect()
        assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i in ({None, 1, 2, 3, 4} if data else ()))
        assert not any(re.search("jo@ex", r.text or "") for r in docs.collect())


def test_run_and_registration(spark):
    import __spark_entry__ as entry
    assert "pipeline" in entry.queries() and sum(n.startswith("op") for n in entry.queries()) >= 10
    assert cp.run(spark, SF).count() > 0
