"""Record boundaries of delimited and JSON files read in many small splits."""

import csv
import gzip
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from geolake.sources import parse as P
from geolake.sources import readers as R
from geolake.sources import records as X
from geolake.sources import schemas as S


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "4000")
    spark.conf.set(keys[1], "0")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(rnd):
    kind = rnd.random()
    if kind < 0.2:
        return ""
    if kind < 0.5:
        return rnd.choice(["a", 'b"c', "x y", '5" pipe', "é", "''"])
    return "".join(rnd.choice(['a', '"', "\n", ",", ";", "z", '""', " ", "q\\"]) for _ in range(rnd.randint(1, 12)))


def write_csv(path, rows, sep=",", end="\n", encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as f:
        csv.writer(f, delimiter=sep, lineterminator=end).writerows(rows)


@pytest.mark.parametrize("sep,end", [(",", "\n"), (";", "\r\n")])
def test_delimited_files_as_pandas_reads_them(small_splits, tmp_path, sep, end):
    spark, rnd = small_splits, random.Random(len(end))
    for k in range(2):
        write_csv(tmp_path / f"{k}.csv", [["id", "a", "b", "c"]] + [[f"{k}-{i}", cell(rnd), cell(rnd), cell(rnd)] for i in range(700)], sep, end)
    expected = pd.concat([pd.read_csv(tmp_path / f"{k}.csv", sep=sep, dtype=str, keep_default_na=False) for k in range(2)])
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 6
    rows = X.read_delimited(spark, str(tmp_path), sep, place=True).orderBy("_place").collect()
    got = [tuple(r[c] or "" for c in ("id", "a", "b", "c")) for r in rows]
    assert got == [tuple(r) for r in expected.itertuples(index=False)]
    assert all(r[c] != "" for r in rows for c in ("a", "b", "c"))   # empty fields are NULL


def test_lines_without_line_ends_in_fields(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [["id", "t"], ["1", 'rue "A", 5'], ["2", "x"], ["3", 'é "']], encoding="latin-1")
    (tmp_path / "b.csv").write_text("id,u,t\n4,U,T\n\n  \n5,,\n")   # another header, blank lines
    assert not X.has_open_lines(spark, str(tmp_path), ",", "ISO-8859-1")
    got = sorted(tuple(r) for r in X.read_delimited(spark, str(tmp_path), ",", "ISO-8859-1").select("id", "t", "u").collect())
    assert got == [("1", 'rue "A", 5', None), ("2", "x", None), ("3", 'é "', None), ("4", "T", "U"), ("5", None, None)]


def test_gzip_and_header_only_files(spark, tmp_path):
    with gzip.open(tmp_path / "75.csv.gz", "wt") as f:
        f.write('id,t\n1,"a\nb"\n')
    (tmp_path / "13.csv").write_text("id,t\n")
    rows = X.read_delimited(spark, str(tmp_path)).collect()
    assert [(r.id, r.t) for r in rows] == [("1", "a\nb")]


def test_a_quote_that_is_never_closed_is_a_reject(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"x\ny"\n2,"open\n' + "3,z\n" * 2000)
    (tmp_path / "b.csv").write_text("id,t\n9,ok\n")
    records, rejects = X.delimited_records(small_splits, str(tmp_path), ",")
    assert sorted(r.value for r in records.where("not first").collect()) == ['1,"x\ny"', "9,ok"]
    assert rejects.count() == 2001 and {r.reason for r in rejects.collect()} == {"a quote is never closed"}


def test_building_table_with_quoted_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,adresse,WKT\n1,"rue ""A"", 5",POINT (1 2)\n2,"two\nlines",POINT (3 4)\n')
    rows = {r.id: (r.adresse, r.WKT) for r in R.read_building_table(spark, str(tmp_path)).collect()}
    assert rows == {"1": ('rue "A", 5', "POINT (1 2)"), "2": ("two\nlines", "POINT (3 4)")}


# ------------------------------------------------------------ JSON
def collection(rnd, n):
    feats = [{"type": "Feature", "properties": {"id": str(i), "t": rnd.choice(["a{b}", 'q"}{', "\\", 'x"y\\"}', None, "é"])},
              "geometry": {"type": "Point", "coordinates": [i, 1.5]}} for i in range(n)]
    return feats, {"type": "FeatureCollection", "name": "a}{b", "crs": {"type": "name", "properties": {"name": "x"}},
                   "other": [{"z": 1}, {"z": {"y": 2}}], "features": feats, "meta": {"k": {"n": [1]}}}


@pytest.mark.parametrize("layout", [{}, {"indent": 1}, {"separators": (",", ":")}])
def test_documents_of_any_layout(small_splits, tmp_path, layout):
    feats, doc = collection(random.Random(1), 500)
    few, other = collection(random.Random(2), 3)
    (tmp_path / "75.json").write_text(json.dumps(doc, **layout))
    (tmp_path / "2A.json").write_text(json.dumps(other, **layout) + "\n")
    (tmp_path / "13.json").write_text(json.dumps({"features": []}))
    assert small_splits.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
    records, rejects = X.json_records(small_splits, str(tmp_path), "features")
    got = {}
    for r in records.orderBy("file", "place").collect():
        got.setdefault(r.file[-7:], []).append(json.loads(r.value))
    assert got == {"75.json": feats, "/2A.json": few} or got == {"75.json"[-7:]: feats, "2A.json"[-7:]: few}
    assert rejects.count() == 0


def test_a_cut_document_loses_its_last_object_only(small_splits, tmp_path):
    feats, doc = collection(random.Random(3), 400)
    (tmp_path / "a.json").write_text(json.dumps(doc)[:20_000])
    records, rejects = X.json_records(small_splits, str(tmp_path), "features")
    got = [json.loads(r.value) for r in records.orderBy("place").collect()]
    assert got == feats[:len(got)] and len(got) > 100
    assert [r.reason for r in rejects.collect()] == ["the document ends inside an object"]


def test_collections_and_element_documents_equal_their_line_forms(small_splits, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType
    props = StructType([StructField("id", StringType()), StructField("t", StringType())])
    feats, doc = collection(random.Random(4), 200)
    (tmp_path / "docs").mkdir()
    (tmp_path / "lines").mkdir()
    (tmp_path / "docs" / "cadastre-75-sections.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "lines" / "75.geojsonl").write_text("\n".join(map(json.dumps, feats)))
    a = R.read_geojson(small_splits, str(tmp_path / "docs"), props, line_delimited=False)
    b = R.read_geojson(small_splits, str(tmp_path / "lines"), props)
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)
    assert {r.file_departement for r in a.collect()} == {"75"}
    elements = [{"type": "node", "id": i, "lat": 48.0, "lon": 2.0, "tags": {"name": "}{"}} for i in range(300)]
    (tmp_path / "o.json").write_text(json.dumps({"version": 0.6, "osm3s": {"t": "x"}, "elements": elements}, indent=1))
    (tmp_path / "o.jsonl").write_text("\n".join(map(json.dumps, elements)))
    a = R.read_osm(small_splits, str(tmp_path / "o.json"), line_delimited=False)
    b = R.read_osm(small_splits, str(tmp_path / "o.jsonl"))
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str) and a.count() == 300


def test_broken_lines_are_rejects(spark):
    lines = spark.createDataFrame([('{"type": "node", "id": 1}',), ('{"type": "node", "id":',), ("",), ("[1]",), ('{"id": "x", "type": "way"}',)], "value string")
    rows = P.parse_osm(lines).select("type", "id").collect()
    assert sorted((r.type, r.id) for r in rows if r.id is not None) == [("node", 1)]
    assert {r.type for r in rows} == {"node", "way"} and len(rows) == 2   # a field of another type is NULL
    bad = P.json_rejects(lines.withColumn("n", F.lit(1)), S.OSM_ELEMENT, place=["n"])
    assert bad.columns == ["n", "record", "reason"]
    assert sorted(r.record for r in bad.collect()) == sorted(['{"type": "node", "id":', "[1]"])


def test_department_of_a_file(spark):
    paths = {"file:/a/75.geojsonl": "75", "file:/a/cadastre-2A-sections.json.gz": "2A", "file:/x/971/sections.json": "971",
             "file:/75/13/all.json": "13", "file:/a/part-00000-1234.json": None, "file:/data/y2023.csv": None, "file:/75x/a.json": None}
    df = spark.createDataFrame([(p,) for p in paths], "p string").select("p", R.department_of(F.col("p")).alias("d"))
    assert {r.p: r.d for r in df.collect()} == paths
