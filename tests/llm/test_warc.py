import base64
import gzip
import hashlib
import random

import pytest
from lateship.llm import warc
from lateship.session import shared_dir

WEIRD = "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\n漢字" * 5


def pages():
    rnd = random.Random(4)
    big = "".join(chr(rnd.choice((97, 233, 0x6F22, 0x1F642, 10, 13))) for _ in range(6_000))
    return [(1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (3, None, None), (4, "http://b", ""), (5, "u", WEIRD), (6, "u", WEIRD),
            (7, "u", "x" * 99), (8, "u", "same"), (9, "u", "same"), (9, "u", "same"), (11, "dup", "twice"), (11, "dup", "twice"),
            (12, "", big + "!"), (12, "", big + "!"), (None, "n", "null id"), (None, "n", "same")]


def expected(rows, revisit_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            h = h or ""
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        own = first.get(h or "")
        again = i != own and len(data) >= revisit_bytes
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", own if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment,archive,revisit", [(100, 5000, 0), (32 << 10, 8 << 20, 0), (61, 4000, 6)])
def test_round_trip(spark, segment, archive, revisit):
    path = f"{shared_dir(spark, 'warc-test')}/a"
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").repartition(3)
    warc.write_archives(df, path, "page_id", "url", "html", revisit_bytes=revisit, segment_bytes=segment, archive_bytes=archive)
    got = warc.read_archives(spark, path).collect()
    assert sorted([(int(r.row_id) if r.row_id else None, r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None)
                   for r in got], key=str) == expected(pages(), revisit)
    assert all(r.error is None for r in got)
    html = {(i or None): (h or "").encode() for i, _, h in pages()[:8]}
    for r in got:
        if r.record_type == "response" and r.row_id and int(r.row_id) in html:
            assert bytes(r.payload) == html[int(r.row_id)]


def test_many_copies_without_an_id_are_records_of_their_own(spark):
    """Above the segment size: each copy is a group of its own segments."""
    text = "word " * 2000
    rows = [(None, "n", text)] * 3000 + [(4, "u", text + "x")] * 3 + [(9, "u", text + "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    path = f"{shared_dir(spark, 'warc-test')}/a"
    warc.write_archives(df, path, "page_id", "url", "html", archive_bytes=100_000)   # archives cut records
    origins = []
    for r in spark.read.format("binaryFile").load(path).select("content").collect():
        origins += [f["warc-segment-origin-id"] for f, _ in warc.parse_archive(bytes(r.content)) if f["warc-type"] == "continuation"]
    most = max(origins.count(o) for o in set(origins[:50]))
    assert len(set(origins)) == 3003 and most <= len(text) // warc.SEGMENT_BYTES + 1
    got = warc.read_archives(spark, path).collect()
    assert sorted([(int(r.row_id) if r.row_id else None, r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None)
                   for r in got], key=str) == expected(rows)
    assert all(r.error is None for r in got)


def test_most_pages_are_segmented(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    path = f"{shared_dir(spark, 'warc-test')}/a"
    warc.write_archives(pages, path, "page_id", "url", "html")
    kinds = [f["warc-type"] for r in spark.read.format("binaryFile").load(path).select("content").collect()
             for f, _ in warc.parse_archive(bytes(r.content)) if f.get("warc-segment-number", "1") == "1" and "warc-segment-number" in f]
    assert 2 * len(kinds) > pages.count()


def test_empty_table(spark):
    path = f"{shared_dir(spark, 'warc-test')}/a"
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path, "page_id", "url", "html")
    assert warc.read_archives(spark, path).count() == 0


def test_records_parse_back():
    digest = warc.sha1_base32(b"payload" * 100)
    records = warc.build_records(5, "http://x/ y", b"payload" * 100, digest, 700, None, "2020-01-01T00:00:00Z", 64)
    data = b"\r\n\r\n".join(records) + b"\r\n\r\n"
    for raw in (data, gzip.compress(data)):
        got = list(warc.parse_archive(raw))
        assert [f["warc-type"] for f, _ in got] == ["response"] + ["continuation"] * (len(records) - 1)
        assert got[0][0]["warc-target-uri"] == "http://x/%20y"
        assert [f.get("warc-segment-number") for f, _ in got] == [str(i + 1) for i in range(len(records))]
        assert warc.decode_block(b"".join(b for _, b in got)) == b"payload" * 100
    with pytest.raises(ValueError):
        list(warc.parse_archive(data[:-80]))
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"hello"))


def test_damage_is_reported():
    def part(n, block, total=None):
        return {"segment": n, "block": block, "total": total}
    assert warc.reassemble([part(2, b"b", 2), part(1, b"a")]) == (b"ab", 1)
    assert warc.reassemble([part(2, b"b", 2), part(1, b"a"), part(1, b"a"), part(2, b"b", 2)]) == (b"ab", 2)
    for parts, why in (([part(2, b"b", 2)], "missing"), ([part(1, b"a"), part(3, b"c", 3)], "missing"), ([part(1, b"a")], "last"),
                       ([part(1, b"a"), part(2, b"b", 5)], "total"), ([part(1, b"a"), part(1, b"x"), part(2, b"b", 2)], "conflict")):
        with pytest.raises(ValueError, match=why):
            warc.reassemble(parts)
    row = {"record_type": "response", "row_id": "1", "refers_to": None, "payload_digest": "WRONG", "payload_bytes": None, "parts": None}
    assert warc._finish({**row, "payload": warc.HTTP_HEAD + b"3\r\nabc\r\n0\r\n\r\n"})[0][-1] == "digest differs"
    assert warc._finish({**row, "payload": warc.HTTP_HEAD + b"9\r\nabc\r\n0\r\n\r\n"})[0][-1] is not None
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
