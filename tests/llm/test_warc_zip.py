import io
import zipfile

import pytest

from geolake.llm import warc_zip as wz


def pages():
    rows = [(5, "http://a/", "<p>same é</p>"), (2, "http://b/", "<p>same é</p>"), (9, None, "other"), (3, "u\r\nWARC-Type: x", ""), (4, "http://c/", None),
            (2, "http://b/", "<p>same é</p>"), (None, "http://d/", "other"), (None, "http://e/", "lonely"), (11, "http://f/", "x" * 500_000),
            (12, "http://g/", "\r\n\r\nWARC/1.1\r\n")]
    return rows + [(100 + i, f"http://h/{i}", "hot") for i in range(300)]


def expected(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        raw, lead = (h or "").encode(), first.get(h or "")
        again = len(raw) >= min_bytes and lead is not None and lead != i
        out.append((i, len(raw), wz.b32_sha1(raw), "revisit" if again else "response", lead if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_round_trip(spark, tmp_path, min_bytes, monkeypatch):
    monkeypatch.setattr(wz, "ARCHIVE_BYTES", 2000)
    rows = pages()
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, sha string")
    manifest = wz.write_archives(df, str(tmp_path / "w"), min_bytes)
    got = wz.read_archives(manifest, with_payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows, min_bytes)
    html = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None}
    assert all(r.payload == html[r.page_id] for r in got if r.record_type == "response" and r.page_id is not None)
    for m in manifest.collect():
        with zipfile.ZipFile(m.uri.removeprefix("file://")) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert wz.read_archives(wz.write_archives(df, str(tmp_path / "e"))).count() == 0


def directory(raw):
    return wz.ZipDirectory(lambda size, at: raw[at:at + size], len(raw))


@pytest.mark.parametrize("limit", [None, 5])
def test_directories(monkeypatch, limit):
    if limit:  # as if sizes, offsets and counts overflowed: ZIP64 records
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.comment = b"PK comment"
        for i in range(5):
            z.writestr(f"d/é{i}", bytes([i]) * 40)
        z.writestr("packed", b"a" * 90, zipfile.ZIP_DEFLATED)
    raw = raw.getvalue()
    assert (b"PK\x06\x06" in raw) == bool(limit)
    d = directory(raw)
    assert len(d.members) == 6
    for i in range(5):
        at, size = d.place(f"d/é{i}")
        assert raw[at:at + size] == bytes([i]) * 40
    with pytest.raises(ValueError):
        d.place("packed")
    with pytest.raises(ValueError):
        directory(b"not a zip file at all")
