import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from quotegrid.llm import archives
from quotegrid.session import scratch_path

ROWS = [
    (1, "http://a/ü?x=1#y", "x" * 999),
    (2, "u", "x" * 999),
    (3, "u", "é" * 600),
    (4, None, "é" * 600),
    (4, None, "é" * 600),
    (None, "n", "é" * 600),
    (7, "v", None),
    (8, "v", ""),
    (9, "w\r\nWARC-Type: metadata", "big " * 100_000),
    (10, "w", "big " * 100_000),
    (11, "q", "\r\n\r\nWARC/1.1\r\n" * 400),
    (None, "z", "short"),
    (None, "z", "short"),
    (12, "", "\x00" * 70_000),
    (5, "e", "only\n" * 20_000),
    (5, "e", "only\n" * 20_000),
]


def first(x):
    return x is not None, x or 0


def brute(rows):
    same = {}
    for page, _, html in rows:
        same.setdefault((html or "").encode(), []).append(page)
    out = []
    for body, pages in same.items():
        *others, last = sorted(pages, key=first)
        for page in others:
            copy = len(body) >= 1000
            out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if copy else "response", last if copy else None))
        out.append((last, len(body), hashlib.sha1(body).hexdigest(), "response", None))
    return sorted(out, key=str)


def pages(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("clash") for c in ("chunk", "data", "k", "plan", "digest", "last", "uri")})


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [1000, archives.CHUNK])
def test_records_and_payloads_are_read_back(spark, size):
    folder = scratch_path(spark, "archives")
    index = archives.write_archives(pages(spark), folder, size=size, most=2000)
    assert found(archives.read_records(index, folder)) == brute(ROWS)
    assert index.select("record_id").distinct().count() == len(ROWS)
    assert index.select("archive").distinct().count() > 1
    payloads, types, uris = {}, {}, set()
    rows = archives.read_archives(index, folder, size=700).collect()
    for r in sorted(rows, key=lambda r: (r.record_id, r.chunk)):
        body = payloads[r.record_id] = payloads.get(r.record_id, b"") + bytes(r.data)
        types[r.record_id] = r.record_type, r.payload_digest, r.payload_bytes
        uris.add(r.uri)
        assert len(r.data) <= 700 and r.digest_so_far == hashlib.sha1(body).hexdigest()
    for name, (kind, digest, n) in types.items():
        assert payloads[name] == b"" if kind == "revisit" else (hashlib.sha1(payloads[name]).hexdigest(), len(payloads[name])) == (digest, n)
    assert uris == {u or "" for _, u, _ in ROWS}


def test_revisits_refer_to_a_record_of_the_same_payload(spark):
    folder = scratch_path(spark, "archives")
    rows = archives.read_records(archives.write_archives(pages(spark), folder), folder).collect()
    kept = {r.page_id: r.payload_digest for r in rows if r.record_type == "response" and r.payload_bytes >= 1000}
    revisits = [r for r in rows if r.record_type == "revisit"]
    assert len(revisits) == 5 and all(kept[r.refers_to] == r.payload_digest for r in revisits)


def test_index_gives_members_that_stand_alone(spark):
    folder = scratch_path(spark, "archives")
    for r in archives.write_archives(pages(spark), folder).collect():
        with open(os.path.join(folder, r.archive), "rb") as f:
            f.seek(r.offset)
            record = gzip.decompress(f.read(r.length))
        assert record.startswith(b"WARC/1.1\r\n") and f"<{r.record_id}>".encode() in record
        assert record.endswith(b"\r\n\r\n")


def test_archives_that_no_index_names_are_not_read(spark):
    folder = scratch_path(spark, "archives")
    index = archives.write_archives(pages(spark), folder)
    archives.write_archives(pages(spark), folder)  # as a lost task would leave them
    assert archives.read_records(index, folder).count() == len(ROWS)


def test_a_changed_payload_is_refused(spark):
    folder = scratch_path(spark, "archives")
    index = archives.write_archives(pages(spark, [(1, "u", "word " * 400)]), folder)
    name = os.path.join(folder, index.first()["archive"])
    with open(name, "rb") as f:
        record = gzip.decompress(f.read())
    bad = gzip.compress(record.replace(b"word word", b"word w0rd", 1))
    with pytest.raises(ValueError, match="not the one"):
        import io

        list(archives.read_stream(io.BytesIO(bad)))
    with pytest.raises(ValueError, match="inside a record"):
        list(archives.read_stream(io.BytesIO(gzip.compress(record[:-30]))))


def test_empty_table(spark):
    folder = scratch_path(spark, "archives")
    index = archives.write_archives(pages(spark).limit(0), folder)
    assert index.count() == 0 and archives.read_records(index, folder).count() == 0
    with pytest.raises(ValueError):
        archives.write_archives(pages(spark), folder, size=10)
