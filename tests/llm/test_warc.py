"""Archives: exact round trip, revisits, framing and digest errors, long and missing payloads."""
import gzip
import hashlib
import io
import random
import zlib

import pytest

from tradelake.llm import warc
from tradelake.llm.queries import op3_warc

SCHEMA = "page_id bigint, url string, html string, digest int, revisit int, payload string"


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, 2, "clash") for i, u, h in rows], SCHEMA)


def brute(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = b in first and i != first[b]
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


def read(spark, archives, **k):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in warc.read_archives(spark, archives, **k).collect()), key=str)


def test_round_trip_with_defined_cases(spark):
    rng = random.Random(2)
    long = "é" * 3_000_000
    same = "<p>" + "x" * 100 + "</p>"
    big = (1 << 53) + 1
    rows = [(5, "http://a/", same), (3, "http://b/\r\nx: y", same), (9, None, same), (9, "http://c/", same), (1, "u", None),
            (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (7, "u", long), (big, "u", long), (None, "u", same),
            (None, "u", "alone" * 50), (8, "u", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n")]
    rows += [(100 + k, "u", "".join(rng.choice("ab<>\n") for _ in range(rng.randint(0, 5000)))) for k in range(40)]
    pages = _pages(spark, rows)
    for size in (warc.ARCHIVE_BYTES, 2000):  # one archive a task, and many
        archives = warc.write_archives(pages, archive_bytes=size)
        assert read(spark, archives) == brute(rows)
    assert sum(r.records for r in archives.collect()) == len(rows)
    texts = {r.page_id: r.payload for r in warc.read_archives(spark, archives).collect() if r.record_type == "response"}
    assert bytes(texts[7]).decode() == long and bytes(texts[8]).decode() == rows[12][2]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op3_warc(spark, sf).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    archives = warc.write_archives(_pages(spark, []))
    assert archives.count() == 0 and warc.read_archives(spark, archives).count() == 0


def _record(payload=b"hello", **k):
    d = hashlib.sha256(payload).hexdigest()
    return warc.record_bytes(k.get("page", 1), "u", payload, d, k.get("refers"), k.get("revisit", False))


def test_members_are_gzip_members():
    data = gzip.compress(_record(b"one")) + gzip.compress(_record(b"two" * 100_000, page=2))
    got = [warc.parse_record(h, b) for h, b in warc.RecordReader(io.BytesIO(data))]
    assert [(r[0], r[2]) for r in got] == [(1, 3), (2, 300_000)]
    assert gzip.decompress(data).count(b"WARC/1.1") == 2


@pytest.mark.parametrize("damage", ["cut", "digest", "length", "payload", "version"])
def test_damage_is_an_error(damage):
    raw = _record(b"hello world")
    data = gzip.compress(raw)
    if damage == "cut":
        data = data[:-12]
    elif damage == "digest":
        data = gzip.compress(raw.replace(b"hello", b"jello"))
    elif damage == "length":
        n = raw.rindex(b"Content-Length: ", 0, raw.index(b"\r\n\r\n"))
        data = gzip.compress(raw[:n] + b"Content-Length: 20\r\n" + raw[raw.index(b"\r\n", n) + 2:])
    elif damage == "payload":
        data = gzip.compress(_record(b"hello").replace(hashlib.sha256(b"hello").hexdigest().encode(), b"0" * 64))
    else:
        data = gzip.compress(raw.replace(b"WARC/1.1", b"HTTP/1.1", 1))
    with pytest.raises((warc.BadRecord, zlib.error)):
        for h, b in warc.RecordReader(io.BytesIO(data)):
            warc.parse_record(h, b)
