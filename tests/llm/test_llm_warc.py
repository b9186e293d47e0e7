import io
import struct
import zipfile

import pytest

from loglens.llm import warc_zip as W


def reader(data: bytes):
    return lambda at, n: data[at:at + n]


def unpacked(data: bytes) -> dict[str, bytes]:
    read = reader(data)
    return {name: read(W.data_offset(read, at), n) for name, (at, n) in W.members(read, len(data)).items()}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


ROWS = [(1, "http://a/", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (3, None, None), (4, "x", ""), (5, "u\r\nv", "line\r\n\r\nend"),
        (6, "http://c/", "z" * 300_000), (0, "http://d/", "only"), (9, "http://a/", "<p>é</p>")]


def test_query_equals_its_sql(spark, table_dir, twin):
    ours, theirs = twin(W, "op4_warc_zip", table_dir(pages=pages(spark, ROWS).repartition(3)))
    assert ours == theirs
    assert sum(r[3] == "revisit" for r in ours) == 3


def test_round_trip_of_payloads_over_many_packages(spark, scratch):
    folder = scratch("warc")
    packages = W.write_packages(pages(spark, ROWS).repartition(2), folder, package_bytes=100).cache()
    assert packages.count() > 4
    rows = W.read_records(W.plan_ranges(packages, folder, 50), folder, with_payload=True).collect()
    want = {i: (u, (h or "").encode()) for i, u, h in ROWS}
    assert sorted(r.page_id for r in rows) == sorted(want)
    for r in rows:
        url, payload = want[r.page_id]
        assert r.url == " ".join((url or "").split())
        assert r.payload_digest == r.stated_digest == W.payload_digest(payload)
        assert r.payload_bytes == len(payload)
        assert r.payload == (b"" if r.record_type == "revisit" else payload)


def test_short_payloads_null_and_repeated_ids(spark, scratch):
    folder = scratch("warc")
    rows = [(1, "a", "hi"), (2, "a", "hi"), (None, "a", "long enough"), (7, "a", "long enough"), (7, "a", "long enough"), (None, "b", "no other")]
    listing = W.write_packages(pages(spark, rows), folder, min_bytes=5)
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in W.read_records(W.plan_ranges(listing, folder), folder).collect())
    assert got == sorted([("1", "response", None), ("2", "response", None), ("7", "response", None), ("7", "response", None),
                          ("None", "revisit", 7), ("None", "response", None)], key=lambda x: (x[0], x[1]))


def test_empty_table_and_clashing_columns(spark, scratch, table_dir):
    assert W.QUERIES["op4_warc_zip"](spark, table_dir(pages=pages(spark, []))).collect() == []
    df = spark.createDataFrame([(1, "u", "h", "x", 2)], "page_id long, url string, html string, first string, again int")
    folder = scratch("warc")
    assert W.read_records(W.plan_ranges(W.write_packages(df, folder), folder), folder).count() == 1


def test_package_is_a_zip_with_stored_members():
    w = W.PackageWriter()
    w.add(5, W.record(5, "u", b"body", W.payload_digest(b"body")))
    data = w.package()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None
        assert [(i.filename, i.compress_type) for i in z.infolist()] == [(W.ARCHIVE, 0), (W.INDEX, 0)]
        assert unpacked(data) == {n: z.read(n) for n in z.namelist()}


def test_zip64_directory_of_many_members_and_comments():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(66_000):
            z.writestr(zipfile.ZipInfo(f"m{i}"), str(i) if i % 1000 == 0 else "")
        z.comment = b"PK\x05\x06 not the end record"
    found = unpacked(out.getvalue())
    assert len(found) == 66_000 and found["m65000"] == b"65000"


def test_zip64_extra_fields_of_large_members():
    name, body = b"big", b"payload"
    local = struct.pack("<4sHHHHHIIIHH", W.LOCAL, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 3, 20) + name + struct.pack("<HHQQ", 1, 16, 7, 7)
    extra = struct.pack("<HHB", 0x9999, 1, 0) + struct.pack("<HHQQQ", 1, 24, 7, 7, 0)
    central = struct.pack("<4sHHHHHHIIIHHHHHII", W.CENTRAL, 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 3, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = len(local) + len(body)
    end64 = struct.pack("<4sQHHIIQQQQ", W.END64, 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = struct.pack("<4sIQI", W.LOCATOR64, 0, at + len(central), 1)
    end = struct.pack("<4sHHHHIIH", W.END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    assert unpacked(local + body + central + end64 + locator + end) == {"big": body}


def test_compressed_members_are_not_listed_and_junk_is_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("packed", "x" * 100, zipfile.ZIP_DEFLATED)
        z.writestr("plain", "y")
    assert set(unpacked(out.getvalue())) == {"plain"}
    with pytest.raises(W.ZipError):
        W.members(reader(b"no zip at all" * 9), 117)
