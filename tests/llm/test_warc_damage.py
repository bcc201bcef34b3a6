"""What can't be read of an archive is told, not passed over."""

import gzip

from tidemark.llm import warc


def test_damage_is_told(spark, tmp_path):
    rows = [(k, f"page {k} " * 50, None) for k in range(20)]
    m = warc.write_warc(spark.createDataFrame(rows, "page_id long, html string, url string").coalesce(1), f"file://{tmp_path}/w").first()
    path = m.file.removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    whole = warc.read_warc(spark, spark.createDataFrame([tuple(m)], "file string, bytes long, records long")).collect()
    at = {r.record_id: r.offset for r in whole}
    assert len(at) == m.records == 20 and all(r.http_length == len(r.payload) for r in whole)
    raw[at["<urn:page:7>"] + 30] ^= 0xFF
    short = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 900\r\n\r\nHTTP/1.1 200 OK\r\n\r\nshort")
    open(path, "wb").write(bytes(raw) + short + b"junk after the end")
    n = len(raw) + len(short) + 18
    for split in (100, 700, 1 << 20):
        got = warc.read_warc(spark, spark.createDataFrame([(m.file, n, 20)], "file string, bytes long, records long"), split_bytes=split).collect()
        assert sorted(r.record_id for r in got if r.record_id) == sorted(i for i in at if i != "<urn:page:7>")
        assert {at["<urn:page:7>"], len(raw)} <= {r.offset for r in got if r.record_type == "damaged"}
