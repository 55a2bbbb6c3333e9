import io
import zipfile

import duckdb
import pytest

from statlake.llm import warc
from statlake.llm.zip_archive import ZipReader, ZipWriter


def _reader(data):
    return ZipReader(lambda at, n: data[at:at + n], len(data))


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("prefix", [b"", b"#!/bin/sh\n" * 30])
def test_our_packages(zip64, prefix):
    out = io.BytesIO()
    z = ZipWriter(out, zip64)
    want = {"a/b.txt": b"hello" * 100, "empty": b"", "naïve": b"\0\xff" * 9}
    for name, data in want.items():
        z.begin(name)
        for i in range(0, len(data), 70):
            assert z.write(data[i:i + 70]) == i
        z.end()
    z.close()
    data = prefix + out.getvalue()
    with zipfile.ZipFile(io.BytesIO(data)) as f:
        assert f.testzip() is None and {n: f.read(n) for n in f.namelist()} == want
    r = _reader(data)
    assert {m.name: data[r.stored(m):r.stored(m) + m.size] for m in r.members} == want


def test_packages_of_others():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as f:
        f.comment = b"PK\5\6 not the end"
        with f.open(zipfile.ZipInfo("x"), "w", force_zip64=True) as m:
            m.write(b"12345")
        f.writestr(zipfile.ZipInfo("packed", (1980, 1, 1, 0, 0, 0)), b"z" * 500, zipfile.ZIP_DEFLATED)
    data = out.getvalue()
    r = _reader(data)
    by = {m.name: m for m in r.members}
    assert data[r.stored(by["x"]):][:5] == b"12345"
    with pytest.raises(ValueError):
        r.stored(by["packed"])
    for bad in (b"", b"PK", data[:-30]):
        with pytest.raises(ValueError):
            _reader(bad)


def test_many_members_need_zip64():
    out = io.BytesIO()
    z = ZipWriter(out)
    for i in range(0x10001):
        z.begin(str(i))
        z.end()
    z.close()
    assert len(_reader(out.getvalue()).members) == 0x10001


def test_records_round_trip():
    for payload in (b"", b"x\r\n\r\ny", "é".encode() * 5000):
        r = warc.parse(warc.record(7, "http://a/\r\nb é", payload, None, "2024-01-01T00:00:00Z"))
        assert r["payload"] == payload and r["page_id"] == 7 and r["record_type"] == "response" and "\n" not in r["url"]
        r = warc.parse(warc.record(None, None, payload, 3, "2024-01-01T00:00:00Z"))
        assert (r["page_id"], r["refers_to"], r["record_type"], r["payload_bytes"], r["payload"]) == (None, 3, "revisit", len(payload), None)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 40}</p>" * (i % 9), 1) for i in range(200)]
    rows += [(500, None, None, 1), (501, "u", "", 1), (None, "u", "<p>1</p>", 1), (None, "u", "alone", 1), (600, "u", "big " * 200_000, 1),
             (601, "u", "big " * 200_000, 1), (0, "again", "", 1), (602, "ü", "ünï", 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, refers_to int")


def test_query_matches_sql(pages):
    got = warc.op4_query(pages).toPandas()
    con = duckdb.connect()
    con.register("pages", pages.toPandas().astype({"page_id": "Int64"}))
    want = con.execute(warc.ORACLE).df()
    cols = sorted(got.columns)
    key = lambda d: sorted(map(tuple, d[cols].astype(object).where(d[cols].notna(), None).values.tolist()), key=str)
    norm = lambda rows: [tuple(int(x) if isinstance(x, float) else x for x in r) for r in rows]
    assert sorted(norm(key(got)), key=str) == sorted(norm(key(want)), key=str)


def test_payloads_threshold_and_packages(pages):
    manifest = warc.write_archives(pages, least=100, zip64=True, package_bytes=5000)
    assert manifest.count() > 4 and sum(r["n_records"] for r in manifest.collect()) == pages.count()
    got = warc.read_archives(manifest).collect()
    want = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    assert len(got) == pages.count()
    for r in got:
        if r["record_type"] == "response" and r["page_id"]:
            assert bytes(r["payload"]) == want[r["page_id"]]
        if r["record_type"] == "revisit":
            assert r["payload_bytes"] >= 100 and want[r["refers_to"]] == want[r["page_id"]] and r["refers_to"] < r["page_id"]
    assert warc.op4_query(pages.filter("false")).count() == 0
