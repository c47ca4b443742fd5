import base64
import hashlib
import io

import zstandard

from voltframe.llm import warc

PAGE = "page_id bigint, url string, html string, digest string, kind string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGE)


def test_round_trip(spark, tmp_path):
    rows = [(1, "http://a", "one"), (2, "http://b", "two"), (3, "http://c", "one"), (5, None, None), (4, "u", ""),
            (6, "http://long", "ä" * 300_000), (7, "a\nb", "one"), (7, "a\nb", "one"), (None, "n", "two")]
    path = str(tmp_path / "w")
    warc.write_archives(frame(spark, rows), path)
    got = warc.read_archives(spark, path).collect()
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = []
    for i, url, html in rows:
        raw = (html or "").encode()
        refers = first.get(html or "") if i is None or i > first[html or ""] else None
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, "revisit" if refers is not None else "response", refers, len(raw), digest))
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"])
                   for r in got), key=str) == sorted(want, key=str)
    # Plain Zstandard tools unpack a bundle to WARC; the index finds single records.
    for r in warc.record_index(spark, path).collect():
        data = open(r["path"].removeprefix("file:"), "rb").read()
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert plain.startswith(b"WARC/1.1\r\n")
        packed = data[r["frame_start"]:r["frame_start"] + r["frame_bytes"]]
        raw = zstandard.ZstdDecompressor().decompress(packed)[r["offset"]:r["offset"] + r["length"]]
        headers, _ = next(warc.parse_records(raw))
        assert headers["WARC-Record-ID"] == f"<urn:page:{'' if r['page_id'] is None else r['page_id']}>"
        if r["page_id"] is not None:
            assert warc.BundleReader(data).find(r["page_id"])[0]["WARC-Record-ID"] == headers["WARC-Record-ID"]


def test_frames_and_threshold(spark, tmp_path, monkeypatch):
    rows = [(k, "u", "p" * (k % 5)) for k in range(40)]
    got = warc.archive_and_read(frame(spark, rows), str(tmp_path / "x")).collect()
    assert sum(r["record_type"] == "response" for r in got) == 5
    few = str(tmp_path / "y")
    warc.write_archives(frame(spark, rows), few, min_payload_bytes=3)
    got = warc.read_archives(spark, few).collect()
    assert sum(r["record_type"] == "revisit" for r in got) == 14  # 8 of 3 bytes and 8 of 4, less one each
    bundle = warc.Bundle()
    for k in range(2000):
        bundle.add(k, warc.record(k, "http://x", b"z" * 500, "D", None))
    reader = warc.BundleReader(bundle.close())
    assert len(reader.frames) > 4 and len(list(reader.records())) == 2000


def test_empty(spark, tmp_path):
    assert warc.archive_and_read(frame(spark, []), str(tmp_path / "e")).count() == 0
