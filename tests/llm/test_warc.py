import gzip
import hashlib
import io
import os
import random

import pytest

from gridmart.llm import warc
from gridmart.llm.queries import op13_of

SCHEMA = "page_id long, url string, html string, payload string, type int, id long, _same string, error string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", "z") for r in rows], SCHEMA).repartition(3)


def brute(rows, least=1000):
    groups = {}
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = max((x for x in groups[data] if x is not None), default=None)
        again = len(data) >= least and first is not None and first != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return out


def edge_rows():
    r = random.Random(2)
    big = "".join(r.choice("abcdé \r\n\t<>") for _ in range(3000))
    huge = "x" * 2_000_000 + "日本"
    return [(1, "http://a/1", big), (2, "http://a/2", big), (7, "http://a/7", big), (7, "http://a/7", big), (3, None, big), (None, "u", big),
            (4, "http://b/\r\nWARC-Type: x", None), (5, "http://b/ é", ""), (6, None, None), (8, "h", "small"), (9, "h", "small"),
            (10, "h", huge), (11, "h", huge), (12, "h", "y" * 999), (13, "h", "y" * 999), (14, "h", "é" * 500), (15, "h", "é" * 500),
            (-3, "h", "é" * 500), (None, "u", "z" * 1500), (None, "v", "z" * 1500), (16, "", "\r\n\r\n" * 300), (17, "", "WARC/1.1\r\n\r\n")]


def rows_of(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in df.collect()), key=str)


def test_pages_against_brute_force(spark, scratch):
    rows = edge_rows()
    got = op13_of(frame(spark, rows), scratch)
    assert rows_of(got) == sorted(brute(rows), key=str)
    assert got.filter("error IS NOT NULL").count() == 0


def test_empty_table(spark, scratch):
    assert op13_of(frame(spark, []), scratch).collect() == []


def test_payloads_come_back(spark, scratch):
    rows = edge_rows()
    path = warc.write_archives(frame(spark, rows), scratch.path("w"), scratch, archive_bytes=4000)
    assert len(warc.archives(path)) > 3                        # archives are of bounded size
    back = warc.read_archives(spark, path).filter("type = 'response'").collect()
    want = sorted((h or "").encode() for (i, _, h), b in zip(rows, brute(rows), strict=True) if b[3] == "response")
    assert sorted(bytes(r["payload"]) for r in back) == want
    assert warc.read_archives(spark, path, payload=False).filter("payload IS NOT NULL").count() == 0
    assert not [f for f in os.listdir(warc.filesystem(path)[1]) if f.startswith("_")]


def test_each_record_is_a_gzip_member_of_its_own(spark, scratch):
    path = warc.write_archives(frame(spark, edge_rows()).coalesce(1), scratch.path("w"), scratch)
    store, _ = warc.filesystem(path)
    info, = warc.archives(path)
    data = store.open_input_file(info.path).readall()
    starts = [r["offset"] for r in warc.records(io.BytesIO(data))]
    assert starts[0] == 0 and len(starts) == 1 + len(edge_rows())
    for a, b in zip(starts, [*starts[1:], len(data)], strict=True):
        assert gzip.decompress(data[a:b]).startswith(b"WARC/1.1\r\n")


def test_append_and_overwrite(spark, scratch):
    path = scratch.path("w")
    for n in (1, 2):
        warc.write_archives(frame(spark, [(n, "u", "a")]), path, scratch)
    assert warc.read_archives(spark, path).filter("type = 'response'").count() == 2
    warc.page_records(frame(spark, [(3, "u", "b")]), scratch).write.format("warc").mode("overwrite").save(path)
    assert [r["id"] for r in warc.read_archives(spark, path).filter("type = 'response'").collect()] == ["3"]


def one(body=b"hello " * 50, **head):
    row = {"type": "response", "record_id": "urn:uuid:1", "payload": body, "id": "1"}
    return warc.page_record({**row, **head})


@pytest.mark.parametrize("chunk", [1, 3, 7, 64, 1 << 18])
def test_chunks_of_any_size(chunk):
    data = one() + one(b"", id="2") + one(os.urandom(5000), id="3")
    got = list(warc.records(io.BytesIO(data), chunk=chunk))
    assert [(r["id"], r["error"]) for r in got] == [("1", None), ("2", None), ("3", None)]
    assert got == list(warc.records(io.BytesIO(data)))


def broken(what):
    good, text = one(), gzip.decompress(one())
    head, block = text.split(b"\r\n\r\n", 1)
    swap = {"payload digest": text.replace(b"hello hello", b"hello jello"),
            "short": text.replace(b"Content-Length: 3", b"Content-Length: 9", 1), "long": text.replace(b"Content-Length: 3", b"Content-Length: 1", 1),
            "no length": text.replace(b"Content-Length", b"Content-Size", 1), "not warc": b"HELLO" + text, "no end": head, "twice": text + text}
    if what in swap:
        return gzip.compress(swap[what])
    if what == "cut":
        return good[: len(good) // 2]
    return good[:60] + bytes(b ^ 0x55 for b in good[60:90]) + good[90:]


@pytest.mark.parametrize("what", ["payload digest", "short", "long", "no length", "not warc", "no end", "twice", "cut", "flipped"])
def test_damage_is_told_and_reading_goes_on(what):
    data = one(id="a") + broken(what) + one(os.urandom(900), id="b") + one(id="c")
    got = list(warc.records(io.BytesIO(data), chunk=50))
    good = [r["id"] for r in got if r["error"] is None]
    assert good == ["a", "b", "c"] and len(got) == 4


def test_cut_at_the_end():
    data = one(id="a") + one(id="b")[:-5]
    got = list(warc.records(io.BytesIO(data)))
    assert [r["error"] for r in got] == [None, "damaged: the member is cut off"]


def test_records_of_other_writers():
    """Folded and lower-case heads, base 16 digests, no HTTP head, other digests."""
    body = b"plain"
    text = (b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:uuid:9>\r\nWARC-Target-URI: http://a/\r\n  b\r\n"
            b"WARC-Payload-Digest: SHA1:" + hashlib.sha1(body).hexdigest().encode() + b"\r\nWARC-Block-Digest: md5:00\r\nContent-Length: 5\r\n\r\n")
    got, = warc.records(io.BytesIO(gzip.compress(text + body + b"\r\n\r\n")))
    assert (got["type"], got["uri"], got["payload"], got["error"]) == ("resource", "http://a/ b", body, None)


def test_a_revisit_without_its_response(spark, scratch):
    path = warc.write_archives(frame(spark, [(1, "u", "a" * 2000), (2, "u", "a" * 2000)]), scratch.path("w"), scratch)
    found = warc.read_archives(spark, path)
    assert warc.resolved(found).filter("error IS NOT NULL").count() == 0
    alone = warc.resolved(found.filter("type = 'revisit'")).collect()
    assert [r["error"] for r in alone] == ["the response is not there"]


def test_attempts_that_fail_leave_nothing(spark, scratch):
    path = scratch.path("w")
    warc.write_archives(frame(spark, [(1, "u", "a")]), path, scratch)
    bad = spark.createDataFrame([("revisit", "r", "no hex", "1", 5)], "type string, record_id string, payload_digest string, id string, payload_bytes long")
    with pytest.raises(Exception):
        bad.write.format("warc").mode("append").save(path)
    assert [f for f in os.listdir(warc.filesystem(path)[1]) if not f.endswith(".warc.gz")] == []
    assert warc.read_archives(spark, path).filter("type = 'response'").count() == 1
