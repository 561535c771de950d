"""Refresh contracts: years, requested departments, staging."""

import pytest

from geolake.sinks import tables as K

SCHEMA = "id string, v int, year int, departement string"


def rows(df):
    return sorted((r.id, r.v, r.year, r.departement) for r in df.collect())


@pytest.fixture
def table(spark):
    K.ensure_namespace(spark, "t_years")
    spark.sql("DROP TABLE IF EXISTS t_years.t")
    return "t_years.t"


def load(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_a_second_year_leaves_the_first(spark, table):
    y22 = load(spark, ("a", 1, 2022, "01"), ("b", 2, 2022, "2A"))
    y23 = load(spark, ("a", 3, 2023, "01"), ("b", 4, 2023, "2A"))
    K.replace_departments(y22, table, ["01", "2A"], within={"year": 2022})
    K.replace_departments(y23, table, ["01", "2A"], within={"year": 2023})
    assert rows(spark.table(table)) == rows(y22.unionByName(y23))
    again = load(spark, ("c", 9, 2023, "01"))
    K.replace_departments(again, table, ["01", "2A"], within={"year": 2023})
    assert rows(spark.table(table)) == rows(y22.unionByName(again))
    assert dict(spark.table(table).dtypes) == dict(y22.dtypes)


def test_action_and_query_form_agree(spark, table):
    """Requested departments are replaced, rows of others appended, and
    requested ones without new rows disappear."""
    old = load(spark, *[(f"o{d}{y}", 1, y, d) for d in ("01", "02", "03", "04") for y in (2022, 2023)])
    new = load(spark, ("n1", 5, 2023, "01"), ("n3", 5, 2023, "03"))
    K.replace_departments(old, table, ["01", "02", "03", "04"], within={"year": 2022})
    expected = rows(K.replace_departments_query(spark.createDataFrame(spark.table(table).collect(), spark.table(table).schema),
                                                new, ["01", "02"], within={"year": 2023}))
    K.replace_departments(new, table, ["01", "02"], within={"year": 2023})
    got = rows(spark.table(table))
    assert got == expected
    assert ("o012022", 1, 2022, "01") in got and ("o032023", 1, 2023, "03") in got and ("n3", 5, 2023, "03") in got
    assert not [r for r in got if r[0] in ("o012023", "o022023")]


def test_replace_present_by_year(spark, table):
    a = load(spark, ("a", 1, 2022, "01"), ("b", 1, 2022, "02"), ("c", 1, 2023, "01"))
    K.replace_present(a, table, within={"year": 2022})
    b = load(spark, ("d", 2, 2023, "01"))
    before = spark.createDataFrame(spark.table(table).collect(), spark.table(table).schema)
    expected = rows(K.replace_present_query(before, b, within={"year": 2023}))
    K.replace_present(b, table, within={"year": 2023})
    assert rows(spark.table(table)) == expected == [("a", 1, 2022, "01"), ("b", 1, 2022, "02"), ("d", 2, 2023, "01")]


def test_a_failing_load_changes_nothing(spark, table):
    good = load(spark, ("a", 1, 2022, "01"))
    K.replace_departments(good, table, ["01"], within={"year": 2022})
    from pyspark.sql import functions as F
    bad = good.withColumn("v", F.raise_error(F.lit("broken source")).cast("int"))
    with pytest.raises(Exception, match="broken source"):
        K.replace_departments(bad, table, ["01"], within={"year": 2022})
    assert rows(spark.table(table)) == rows(good)
