"""Versioned publish: one atomic commit per refresh."""

import threading

import pytest

from geolake.sinks import tables as K
from geolake.sinks import versions as V

SCHEMA = "id string, v int, year int, departement string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def load(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture
def root(spark, tmp_path):
    spark.conf.set("geolake.tables.root", str(tmp_path / "tables"))
    yield str(tmp_path / "tables")
    spark.conf.unset("geolake.tables.root")


OLD = [("a", 1, 2022, "01"), ("b", 2, 2022, "02"), ("c", 3, 2023, "01"), ("d", 4, 2022, None), ("e", 5, 2022, "2A")]


def test_contracts_equal_the_query_forms(spark, root):
    old = load(spark, *OLD)
    new = load(spark, ("n", 9, 2022, "01"), ("m", 8, 2022, "75"), ("o", 7, 2022, None))
    K.replace_departments(old.where("year = 2022"), "x.t", ["01", "02"], within={"year": 2022})
    K.replace_departments(old.where("year = 2023"), "x.t", ["01"], within={"year": 2023})
    assert rows(K.read_table(spark, "x.t")) == rows(old) and K.table_exists(spark, "x.t")
    assert K.read_table(spark, "x.t").schema == old.schema
    expected = rows(K.replace_departments_query(old, new, ["01", "02"], within={"year": 2022}))
    K.replace_departments(new, "x.t", ["01", "02"], within={"year": 2022})
    assert rows(K.read_table(spark, "x.t")) == expected
    now = load(spark, *expected)
    again = load(spark, ("p", 6, 2022, "2A"))
    expected = rows(K.replace_present_query(now, again, within={"year": 2022}))
    K.replace_present(again, "x.t", within={"year": 2022})
    assert rows(K.read_table(spark, "x.t")) == expected
    table = K.versioned(spark, "x.t")
    assert rows(table.read(2)) == rows(old)   # as of an earlier commit
    K.replace_departments(load(spark), "x.t", ["2A"], within={"year": 2022}, keep_if_empty=True)
    assert rows(K.read_table(spark, "x.t")) == expected
    K.replace_departments(load(spark), "x.t", ["2A"], within={"year": 2022})
    assert "2A" not in {r[3] for r in rows(K.read_table(spark, "x.t"))}
    K.drop_tables(spark, ["x.t"])
    assert not K.table_exists(spark, "x.t")


def test_full_replace_and_new_columns(spark, root):
    a = spark.createDataFrame([("1", "01")], "id string, departement string")
    K.replace_table(a, "x.full")
    b = spark.createDataFrame([("2", "02", 5), ("3", None, 6)], "id string, departement string, n int")
    K.replace_table(b, "x.full")
    assert rows(K.read_table(spark, "x.full")) == rows(b)
    K.truncate_load(a.limit(0), "x.load")
    assert K.read_table(spark, "x.load").count() == 0 and K.read_table(spark, "x.load").columns == a.columns
    K.truncate_load(a, "x.load")
    assert rows(K.read_table(spark, "x.load")) == rows(a)
    K.replace_departments(a, "x.grow", ["01"])
    K.replace_departments(b, "x.grow", ["02"])
    assert rows(K.read_table(spark, "x.grow")) == [("1", "01", None)] + rows(b) or rows(
        K.read_table(spark, "x.grow").select("id", "departement", "n")) == sorted([("1", "01", None), *rows(b)], key=str)
    with pytest.raises(ValueError):
        K.replace_departments(spark.createDataFrame([(1, "01")], "id int, departement string"), "x.grow", ["01"])


class Killed(BaseException):
    pass


STEPS = ["_stage", "_newest", "_put"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("late", [False, True])
def test_a_writer_killed_at_any_step_leaves_a_whole_table(spark, root, monkeypatch, step, late):
    deps = ["01", "02", "2A"]
    old = load(spark, *[(f"o{d}", 1, 2022, d) for d in deps])
    new = load(spark, *[(f"n{d}", 2, 2022, d) for d in deps])
    K.replace_departments(old, "x.kill", deps)
    real = getattr(V.VersionedTable, step)

    def dies(self, *args):
        if late:
            real(self, *args)
        raise Killed
    with monkeypatch.context() as m:
        m.setattr(V.VersionedTable, step, dies)
        with pytest.raises(Killed):
            K.replace_departments(new, "x.kill", deps)
    committed = step == "_put" and late
    assert rows(K.read_table(spark, "x.kill")) == rows(new if committed else old)
    K.replace_departments(new, "x.kill", deps)   # run again
    assert rows(K.read_table(spark, "x.kill")) == rows(new)
    K.versioned(spark, "x.kill").vacuum(keep=1)
    assert rows(K.read_table(spark, "x.kill")) == rows(new)
    assert len(K.versioned(spark, "x.kill")._list("data")) == 1


def test_concurrent_writers_both_commit(spark, root, monkeypatch):
    table = K.versioned(spark, "x.race")
    table.replace_departments(load(spark, *OLD), ["01"])
    real, met = V.VersionedTable._newest, threading.Barrier(2)

    def newest(self):
        found = real(self)
        if found[0] == 1:
            met.wait(60)   # both have read the first manifest
        return found
    monkeypatch.setattr(V.VersionedTable, "_newest", newest)
    errors = []

    def write(dep):
        try:
            K.versioned(spark, "x.race").replace_departments(load(spark, (f"n{dep}", 0, 2024, dep)), [dep])
        except BaseException as e:  # noqa: BLE001
            errors.append(e)
    both = [threading.Thread(target=write, args=(d,)) for d in ("02", "2A")]
    for t in both:
        t.start()
    for t in both:
        t.join(120)
    assert not errors and table.versions() == [1, 2, 3]
    kept = [r for r in OLD if r[3] not in ("02", "2A")]
    assert rows(table.read()) == sorted([*kept, ("n02", 0, 2024, "02"), ("n2A", 0, 2024, "2A")], key=str)


def test_a_failing_load_changes_nothing(spark, root):
    from pyspark.sql import functions as F
    good = load(spark, ("a", 1, 2022, "01"))
    K.replace_departments(good, "x.fail", ["01"])
    with pytest.raises(Exception, match="broken source"):
        K.replace_departments(good.withColumn("v", F.raise_error(F.lit("broken source")).cast("int")), "x.fail", ["01"])
    assert K.versioned(spark, "x.fail").versions() == [1]
