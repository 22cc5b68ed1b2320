import io
import zipfile

import pytest

from trendlens.llm import archive as A


class Range(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_members_with_and_without_zip64():
    for count in (3, 70_000):
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
            for k in range(count):
                z.writestr(f"m{k}", b"x" * (k % 7))
            with z.open(zipfile.ZipInfo("big"), "w", force_zip64=True) as f:
                f.write(b"stored")
            z.writestr("deflated", b"y" * 100, zipfile.ZIP_DEFLATED)
            z.comment = b"a note"
        found = A.members(Range(raw.getvalue()), len(raw.getvalue()))
        assert len(found) == count + 1 and "deflated" not in found
        place, length = found["big"]
        assert raw.getvalue()[place:place + length] == b"stored"
        place, length = found["m2"]
        assert raw.getvalue()[place:place + length] == b"xx"


def test_zip64_values_in_the_directory_entry():
    import struct
    data = b"PK\3\4" + b"\0" * 22 + struct.pack("<HH", 1, 0) + b"n" + b"payload"
    extra = struct.pack("<HHQQQ", 1, 24, 7, 7, 0)
    entry = (b"PK\1\2" + b"\0" * 16 + struct.pack("<II", 0xFFFFFFFF, 0xFFFFFFFF)
             + struct.pack("<HHH", 1, len(extra), 0) + b"\0" * 8 + struct.pack("<I", 0xFFFFFFFF)
             + b"n" + extra)
    big = b"PK\6\6" + struct.pack("<Q", 44) + b"\0" * 12 + struct.pack(
        "<QQQQ", 1, 1, len(entry), len(data))
    find = b"PK\6\7" + struct.pack("<IQI", 0, len(data) + len(entry), 1)
    end = b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    raw = data + entry + big + find + end
    place, length = A.members(Range(raw), len(raw))["n"]
    assert raw[place:place + length] == b"payload"


def test_broken_packages_are_refused():
    with pytest.raises(ValueError):
        A.members(Range(b"no package" * 10), 100)
    raw = A.record(1, "u", b"payload" * 30, "0" * 64, None)
    with pytest.raises(ValueError):
        A.parse(raw)


def test_round_trip_with_edge_rows(spark, tmp_path):
    big = "p" * 300
    rows = [(1, "http://a", "x"), (2, "http://b", "x"), (5, None, big), (3, "u\r\nX: y", big),
            (4, "u", None), (6, "u", ""), (None, "u", big), (7, "u", "é" * 200_000), (3, "v", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'c' AS digest", "1 AS refers_to")
    packages = A.write(pages, f"file://{tmp_path}/packages", package_bytes=2000)
    assert packages.agg({"records": "sum"}).first()[0] == len(rows)
    got = A.read(packages).collect()
    assert len(got) == len(rows)
    by = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in got)
    assert by == sorted([
        ("1", "response", "None", 1), ("2", "response", "None", 1), ("5", "revisit", "3", 300),
        ("3", "response", "None", 300), ("3", "revisit", "3", 300), ("4", "response", "None", 0),
        ("6", "response", "None", 0), ("None", "response", "None", 300),
        ("7", "response", "None", 400_000)])
    assert {bytes(r.payload) for r in got if r.page_id == 7} == {("é" * 200_000).encode()}
    assert {r.url for r in got if r.page_id == 3} == {"u  X: y", "v"}
    empty = A.archived(spark.createDataFrame([], "page_id long, url string, html string"))
    assert empty.collect() == []
