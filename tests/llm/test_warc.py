import hashlib

import zstandard

from ledgerline.llm import warc as w
from ledgerline.session import new_scratch_dir


def _round_trip(spark, df):
    path = new_scratch_dir(spark, "test-warc")
    w.write_archives(df, path)
    return path, w.read_archives(spark, path).collect()


def test_bytes_come_back(spark):
    same, small = "<p>" + "same page " * 40, "<p>short</p>"
    rows = [(i, f"http://x/{i}", f"<html>{i} é中 " + "text of the page " * (i % 50)) for i in range(300)]
    rows += [(400, "http://a", same), (399, "http://b\r\nX: y", same), (401, None, same), (402, "u", small), (403, "u", small)]
    rows += [(404, "u", None), (405, "u", ""), (399, "http://b\r\nX: y", same), (None, "n", same), (None, None, None)]
    path, got = _round_trip(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    for i, url, html in rows:
        data = (html or "").encode()
        assert by[i]["payload_digest"] == hashlib.sha256(data).hexdigest() or i is None
        if i is not None:
            assert by[i]["payload_bytes"] == len(data)
            if by[i]["record_type"] == "response":
                assert bytes(by[i]["payload"]) == data
    assert by[399]["record_type"] == "response" and by[399]["url"] == "http://b%0D%0AX: y"
    assert [by[i]["refers_to"] for i in (400, 401)] == [399, 399]
    assert {by[i]["record_type"] for i in (402, 403, 404, 405)} == {"response"}
    assert sorted(r["record_type"] for r in got if r["page_id"] is None) == ["response", "revisit"]


def test_archive_is_plain_zstandard(spark):
    rows = [(i, f"http://x/{i}", f"<html>{i} " + "text of the page " * 30) for i in range(400)]
    path, _ = _round_trip(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    archive = bytes(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).first()["content"])
    assert archive[:4] == b"\x5d\x2a\x4d\x18"  # the dictionary leads
    assert len(archive) < sum(len(r[2]) for r in rows) / 3
    size = int.from_bytes(archive[4:8], "little")
    dictionary = zstandard.ZstdDecompressor().decompress(archive[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    with reader.stream_reader(archive[8 + size :], read_across_frames=True) as f:
        text = f.read()
    assert text.count(b"WARC/1.1\r\n") == 400


def test_damage_is_noticed():
    data = w.record(1, "u", b"x" * 200, "0" * 64, True, None)
    archive = zstandard.ZstdCompressor(write_checksum=True).compress(data)
    assert next(w.records_in(archive)) == data
    for bad in (archive[:-9], b"junk" + archive):
        try:
            list(w.records_in(bad))
        except (ValueError, zstandard.ZstdError):
            continue
        raise AssertionError("damage was not noticed")


def test_empty(spark):
    assert _round_trip(spark, spark.createDataFrame([], "page_id long, url string, html string, extra int"))[1] == []
