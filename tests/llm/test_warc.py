"""Archives read back give the pages, and transactions come together by their identifiers."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first string, token string, salt string"
ODD = [None, "", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n", "<p>é 日本 😀</p>", "x" * 300_000, "\r\n\r\n", " "]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", "f", "t", "s") for r in rows], SCHEMA).repartition(3)


def wanted(rows, least=0):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        again = len(data) >= least and ids and page != min(ids)
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", min(ids) if again else None))
    return sorted(out, key=str)


def round_trip(spark, tmp_path, rows, **options):
    path = f"{tmp_path}/archive"
    warc.write(pages(spark, rows), path, **options)
    found = warc.resolved(warc.assemble(warc.read(spark, path)))
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()], key=str), path


def test_round_trip_with_copies_and_odd_rows(spark, tmp_path):
    rows = [(i, f"http://h{i}.example/a b?q=ü#x" if i % 2 else None, ODD[i % len(ODD)]) for i in range(60)]
    rows += [(None, "nothing", "a page without id"), (None, "", ODD[3]), (3, "http://h3.example/again", ODD[3]), (70, "u", "own")]
    rows += [(100 + i, "http://many.example/", "everyone has this") for i in range(500)]
    got, path = round_trip(spark, tmp_path, rows)
    assert got == wanted(rows)
    records = warc.read(spark, path, payload=True)
    assert records.where("intact = false").count() == 0
    kept = {bytes(r.block).decode() for r in records.where("record_type = 'response'").collect()}
    assert kept == {h or "" for _, _, h in rows}
    captures = warc.assemble(records)
    assert captures.count() == len(rows)
    assert captures.where("size(requests) <> 1 OR size(metadata) <> 1 OR response IS NULL").count() == 0
    urls = [r.url for r in warc.resolved(captures).collect()]
    assert sorted(urls, key=str) == sorted([u for _, u, _ in rows], key=str)


def test_least_bytes_and_small_files(spark, tmp_path):
    rows = [(i, "http://a.example/", "tiny" if i % 2 else "a longer page") for i in range(40)]
    got, path = round_trip(spark, tmp_path, rows, least_bytes=6, file_bytes=4096, compression="none")
    assert got == wanted(rows, 6)
    files = list((tmp_path / "archive").glob("part-*"))
    assert len(files) > 10
    for file in files:
        assert file.read_bytes().startswith(b"WARC/1.1\r\nWARC-Type: request\r\n") and file.read_bytes().endswith(b"\r\n\r\n")


def test_empty(spark, tmp_path):
    assert round_trip(spark, tmp_path, [])[0] == []


def archive(*records: tuple[str, str, list[str], bytes]) -> list[bytes]:
    out = []
    for name, kind, others, block in records:
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nwarc-record-id: <{name}>\r\n" + "".join(f"WARC-Concurrent-To: <{o}>\r\n" for o in others)
        out.append(head.encode() + f"Content-Type: text/plain\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
    return out


def test_foreign_archives_and_all_directions(spark, tmp_path):
    records = archive(
        ("r1", "response", [], b"one"), ("q1", "request", ["r1"], b"ask"), ("m1", "metadata", ["q1"], b"late"),
        ("r2", "response", ["q2", "m2"], b"two"), ("q2", "request", [], b"ask"), ("m2", "metadata", [], b"about"),
        ("m3", "metadata", ["m2"], b"more"), ("q9", "request", ["gone"], b"lost"), ("x", "resource", [], b""), ("w", "warcinfo", [], b"software: x"),
    )
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "members.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records[:5]))
    (tmp_path / "in" / "plain.warc").write_bytes(b"".join(records[5:]))
    (tmp_path / "in" / "again.warc").write_bytes(b"".join(records[:2]))
    found = warc.assemble(warc.read(spark, f"{tmp_path}/in"))
    names = lambda c: F.transform(c, lambda r: r["record_id"])
    got = {(r[0], r[1], tuple(r[2]), tuple(r[3])) for r in found.select("capture_id", "response.record_type", names("requests"), names("metadata")).collect()}
    assert got == {
        ("<r1>", "response", ("<q1>",), ("<m1>",)), ("<r2>", "response", ("<q2>",), ("<m2>", "<m3>")),
        ("<q9>", None, ("<q9>",), ()), ("<x>", "resource", (), ()), ("<w>", None, (), ("<w>",)),
    }


def test_broken_files_are_errors():
    whole = b"".join(archive(("a", "response", [], b"12345")))
    assert [b for _, b in warc.parsed(whole)] == [b"12345"]
    for bad in (whole[:-6], b"HTTP/1.1 200 OK\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.parsed(bad))
