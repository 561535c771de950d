import numpy as np
import pandas as pd

from geolake.operators.quantiles import exact_quantiles


def test_exact_quantiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(7)
    keys = np.concatenate([np.zeros(3000, dtype=int), rng.integers(1, 40, 3000)])
    vals = np.round(rng.normal(100, 30, len(keys)), 2)
    vals[::97] = np.nan
    pdf = pd.DataFrame({"k": keys.astype("int64"), "v": vals, "w": vals * 2})
    df = spark.createDataFrame(pdf).repartition(6)
    specs = [("v", 0.25, "q1"), ("v", 0.5, "med"), ("v", 0.75, "q3"), ("w", 0.5, "wmed")]
    got = exact_quantiles(df, ["k"], specs).toPandas().set_index("k").sort_index()
    exp = pdf.groupby("k").agg(q1=("v", lambda s: s.quantile(0.25)), med=("v", "median"),
                               q3=("v", lambda s: s.quantile(0.75)), wmed=("w", "median"))
    for c in ["q1", "med", "q3", "wmed"]:
        assert np.allclose(got[c].to_numpy(), exp[c].to_numpy(), rtol=0, atol=1e-9), c


def test_single_value_and_null_keys(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 1.0), (2, None), (2, 3.0), (2, 4.0)], "k int, v double")
    got = {r["k"]: r["m"] for r in exact_quantiles(df, ["k"], [("v", 0.5, "m")]).collect()}
    assert got == {1: 5.0, 2: 3.5}


def test_digit_is_monotone():
    import math
    from geolake.operators import quantiles as Q
    vals = sorted([-1e300, -5.0, -1.0000001, -1.0, -1e-300, 0.0, 5e-324, 1e-300, 0.1, 0.1 + 1e-17, 1.0, 1.0000001, 3.0, 1e300])

    def digit(v):
        return 0 if v == 0 else int(math.copysign(math.floor(math.log2(abs(v)) * Q.STEPS) + Q._OFFSET, v))
    assert [digit(v) for v in vals] == sorted(digit(v) for v in vals)


def test_negative_zero_and_tied_values(spark):
    vals = [-7.5, -7.5, -0.0, 0.0, 0.0, 1e-12, 2.0, 2.0, 2.0, 1e9, float("nan"), None]
    df = spark.createDataFrame([(1, v) for v in vals] + [(2, -1.0)], "k int, v double")
    specs = [("v", p, f"p{i}") for i, p in enumerate((0.0, 0.1, 0.37, 0.5, 0.9, 1.0))]
    got = {r.k: list(r)[1:] for r in exact_quantiles(df, ["k"], specs).collect()}
    real = [v for v in vals if v is not None and v == v]
    assert np.allclose(got[1], [np.quantile(real, p) for _, p, _ in specs], rtol=0, atol=1e-6)
    assert got[2] == [-1.0] * 6


def test_building_the_price_queries_runs_no_job(spark):
    import __spark_entry__ as E
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        for name in ("section_prices", "commune_prices", "prices_by_prefix"):
            E.queries()[name](spark, "/root/testdata/sf0.001")
        # Reading a Parquet footer for its schema is no scan of rows.
        assert len(tracker.getJobIdsForGroup("lazy")) <= 9
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_close_values_are_divided_again(spark, monkeypatch):
    from geolake.operators import quantiles as Q
    monkeypatch.setattr(Q, "BOUND", 8)
    monkeypatch.setattr(Q, "PARTS", 8)
    rng = np.random.default_rng(3)
    close = 1000 + rng.integers(0, 400, 3000) * 1e-9    # all in one digit
    wide = np.concatenate([rng.normal(0, 1e-7, 500) + 5, rng.normal(0, 1e9, 200), [-0.0, 0.0, 5e-324, -5e-324]])
    pdf = pd.DataFrame({"k": ["a"] * len(close) + ["b"] * len(wide) + ["c"], "v": np.concatenate([close, wide, [2.5]])})
    pdf["w"] = -pdf["v"]
    specs = [("v", p, f"p{int(p * 100)}") for p in (0.0, 0.1, 0.5, 0.99, 1.0)] + [("w", 0.5, "m")]
    got = exact_quantiles(spark.createDataFrame(pdf).repartition(5), ["k"], specs, staged=True).toPandas().set_index("k").sort_index()
    for v, p, name in specs:
        expected = pdf.groupby("k")[v].quantile(p).sort_index()
        assert (got[name] == expected).all(), name


def test_weights_count_rows(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": rng.integers(0, 5, 300), "v": np.round(rng.normal(0, 9, 300), 1), "n": rng.integers(1, 6, 300)})
    many = pdf.loc[pdf.index.repeat(pdf["n"])]
    got = exact_quantiles(spark.createDataFrame(pdf), ["k"], [("v", 0.25, "q")], weight="n").toPandas().set_index("k").sort_index()
    assert np.allclose(got["q"], many.groupby("k")["v"].quantile(0.25).sort_index())


def test_price_statistics_read_the_input_once(spark):
    import re

    import __spark_entry__ as E
    for name in ("section_prices", "commune_prices"):
        df = E.queries()[name](spark, "/root/testdata/sf0.001")
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len(re.findall(r"FileScan parquet", final)) == 1, final


def test_staged_and_lazy_price_statistics_agree(spark):
    from geolake.operators import prices
    from geolake.plans import bindings as B
    dvf = B.dvf_input(spark, "/root/testdata/sf0.001")
    lines = prices.staged_sales(dvf)
    for f in (prices.section_prices, prices.commune_prices):
        a, b = (df.toPandas().sort_values("departement").round(6) for df in (f(dvf), f(dvf, lines)))
        assert sorted(map(str, a.itertuples(index=False))) == sorted(map(str, b.itertuples(index=False)))
