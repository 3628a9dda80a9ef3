import glob
import gzip
import hashlib
import io

import pytest

from ledgermill.llm import warc_writer as w

PAGES = "page_id long, url string, html string"
LONG = "x" * 100


def rows():
    out = [(k, f"http://a.example/{k}?q=ü b", f"<p>{k}</p>" + "é" * k) for k in range(40)]
    out += [(100, "u", LONG), (90, "u", LONG), (95, None, LONG), (200, "v", "x" * 99), (201, "v", "x" * 99), (300, "w", None), (301, "w", ""), (302, "n\nX: y", "z" * 300_000)]
    out += [(400, "t", "same" * 30), (400, "t", "same" * 30), (None, "null", LONG)]
    out += [(500, "a", LONG), (500, "b", "other" * 40), (500, "c", "<p>same id, other pages</p>"), (501, "d", "other" * 40)]
    return out


def expected(data):
    first = {}
    for k, _, h in data:
        if k is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, k), k)
    out = []
    for k, _, h in data:
        body = (h or "").encode()
        to = first.get(h) if k is not None and len(body) >= 100 and first[h] < k else None
        out.append((k, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("roll, span", [(1 << 30, 1 << 30), (500, 2000)])
def test_round_trip(spark, folder, roll, span):
    pages = spark.createDataFrame(rows(), PAGES)
    out = w.round_trip(pages, "file://" + folder, roll_bytes=roll, range_bytes=span)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out.collect()), key=str)
    assert got == expected(rows())
    files = w.read_manifest(spark, "file://" + folder).collect()
    assert len(files) > 5 if span == 2000 else len(files) == 1
    for f in files:
        data = open(f"{folder}/{f.file}", "rb").read()
        assert hashlib.sha256(data).hexdigest() == f.sha256 and len(data) == f.bytes
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == f.records
    assert not glob.glob(folder + "/_tmp*")


def test_same_bytes_whatever_the_partitions(spark, folder):
    pages = spark.createDataFrame(rows(), PAGES)
    sums = []
    for k in (1, 7):
        w.write(pages.repartition(k), f"file://{folder}/{k}", roll_bytes=700, range_bytes=3000)
        sums.append(sorted((r.file, r.sha256) for r in w.read_manifest(spark, f"file://{folder}/{k}").collect()))
    assert sums[0] == sums[1]


def test_headers_cannot_be_broken_and_damage_is_found():
    data = w.member(w.record(7, "http://a/\r\nEvil: 1", b"body", None, "2024-01-01T00:00:00Z"), 6)
    (fields, block, offset), = w.parse(io.BytesIO(data))
    assert "Evil" not in fields and block.endswith(b"\r\n\r\nbody") and offset == 0
    plain = bytearray(gzip.decompress(data))
    plain[-6] ^= 1
    with pytest.raises(ValueError, match="digest"):
        list(w.parse(io.BytesIO(w.member(bytes(plain), 6))))
    with pytest.raises((ValueError, Exception)):
        list(w.parse(io.BytesIO(data[:-9])))


def test_empty(spark, folder):
    assert w.round_trip(spark.createDataFrame([], PAGES), "file://" + folder).count() == 0


def test_ids_beyond_the_floats_beside_a_null_id(spark, folder):
    big = 1 << 53
    data = [(big + 1, "a", LONG), (big + 2, "b", LONG), (big + 3, "c", "<p>own</p>"), (None, "n", LONG), ((1 << 63) - 1, "d", LONG), (-big - 1, "e", "other" * 40), (-big, "f", "other" * 40)]
    out = w.round_trip(spark.createDataFrame(data, PAGES).coalesce(1), "file://" + folder).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str)
    assert got == expected(data) and sum(r.record_type == "revisit" for r in out) == 3
    (f,) = w.read_manifest(spark, "file://" + folder).collect()
    assert (f.first_id, f.last_id) == (None, (1 << 63) - 1)
    with open(f"{folder}/{f.file}", "rb") as stream:
        heads = [fields for fields, _, _ in w.parse(stream)]
    ids = {h["WARC-Record-ID"] for h in heads}
    assert all(h["WARC-Refers-To"] in ids for h in heads if h["WARC-Type"] == "revisit")
