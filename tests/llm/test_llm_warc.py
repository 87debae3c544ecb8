"""The content-addressed archive: contract, exact records, damage, and WARC files."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from folioflow.llm import warc
from folioflow.llm.queries import ORACLE

DDL = "page_id bigint, url string, html string, payload string, row int, first string"
BIG = "<p>" + "long page\r\n\r\n" * 40
ROWS = [
    (5, "http://a/x y\r\nEvil: 1", BIG), (2, "http://b/", BIG), (2, "http://b/", BIG), (9, None, BIG), (None, "http://c", BIG),
    (1, "http://d", None), (3, "http://e", ""), (4, "http://f", "short"), (6, "http://g", "short"), (7, "", "é中😀" * 50), (8, "http://é/", "é中😀" * 50),
    (None, "http://n", "no id " * 30), (None, "http://n", "no id " * 30), (10, "http://h", "ends in line ends " * 9 + "\r\n\r\n\r\n"), (11, "http://i", "x" * 300_000),
    (12, "http://j", "99 bytes " * 11), (13, "http://j", "99 bytes " * 11), (14, "http://k", "100 bytes " * 10), (15, "http://k", "100 bytes " * 10),
    (16, "http://l", "WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n" * 5),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "p", 1, "f") for r in rows], DDL)


def brute(rows):
    bodies = {}
    for n, (page_id, _, html) in enumerate(rows):
        bodies.setdefault((html or "").encode(), []).append((page_id is None, page_id or 0, n))
    for body, found in bodies.items():
        no_id, first, _ = min(found)
        for place, (_, _, n) in enumerate(sorted(found)):
            later = place > 0 and len(body) >= 100
            yield rows[n][0], len(body), hashlib.sha256(body).hexdigest(), "revisit" if later else "response", first if later and not no_id else None


def test_contract(spark):
    got = [tuple(r) for r in warc.digest(pages(spark)).collect()]
    assert sorted(got, key=repr) == sorted(brute(ROWS), key=repr)
    assert warc.digest(pages(spark, [])).collect() == []


def test_sql_says_the_same(spark):
    rows = [r for r in ROWS if r[0] is not None]
    pages_table = pages(spark, rows).toArrow()  # noqa: F841
    want = duckdb.sql(ORACLE["op13_warc"].replace("FROM pages", "FROM pages_table")).fetchall()
    assert sorted(want, key=repr) == sorted((tuple(r) for r in warc.digest(pages(spark, rows)).collect()), key=repr)


def test_records_come_back(spark, tmp_path):
    archive = warc.Archive(spark, str(tmp_path / "a")).write(pages(spark))
    stored = archive.payloads().collect()
    assert len(stored) == len({(h or "").encode() for _, _, h in ROWS})
    restored = archive.restored().collect()
    assert len(restored) == len(ROWS) and len({r.record for r in restored}) == len(ROWS)
    of_page = {}
    for r in restored:
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"Evil" not in head.replace(b"%0D%0AEvil", b"")
        assert int(re.search(rb"\r\nContent-Length: (\d+)", head)[1]) == len(block) - 4 and block.endswith(b"\r\n\r\n")
        of_page.setdefault(r.page_id, []).append((head, block.partition(b"\r\n\r\n")[2][:-4]))
    assert of_page[14][0][1] == b"100 bytes " * 10 and of_page[15][0][1] == b""
    name = re.search(rb"WARC-Record-ID: (\S+)\r\n", of_page[14][0][0])[1]
    assert b"WARC-Refers-To: " + name in of_page[15][0][0] and b"WARC-Refers-To-Target-URI: http://k" in of_page[15][0][0]
    assert b"WARC-Target-URI: http://a/x%20y%0D%0AEvil:%201\r\n" in of_page[5][0][0] and b"\r\nWARC-Target" not in of_page[9][0][0]
    names = re.findall(rb"WARC-Record-ID: (\S+)", b"".join(bytes(r.record) for r in restored))
    assert len(set(names)) == len(ROWS)


def test_damage_is_found(spark, tmp_path):
    folder = str(tmp_path / "a")
    archive = warc.Archive(spark, folder).write(pages(spark))
    damaged = archive.payloads().select("payload_digest", F.concat("payload", F.lit(b"!")).alias("payload"))
    damaged.write.parquet(f"{folder}/other")
    archive.headers().write.parquet(f"{folder}/bad/headers")
    spark.read.parquet(f"{folder}/other").write.parquet(f"{folder}/bad/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.Archive(spark, f"{folder}/bad").resolved().collect()
    archive.headers().write.parquet(f"{folder}/less/headers")
    spark.read.parquet(f"{folder}/payloads").limit(2).write.parquet(f"{folder}/less/payloads")
    with pytest.raises(Exception, match="no payload of digest"):
        warc.Archive(spark, f"{folder}/less").resolved().collect()


def test_files_and_back(spark, tmp_path):
    archive = warc.Archive(spark, str(tmp_path / "a")).write(pages(spark))
    warc.write_warc(archive.restored().coalesce(3), str(tmp_path / "files"))
    found = warc.read_warc(spark, str(tmp_path / "files")).collect()
    mine = {bytes(r.record) for r in archive.restored().collect()}
    assert {bytes(r.header) + bytes(r.payload) + b"\r\n\r\n" for r in found} == mine and len(found) == len(mine)
    full = {r.payload_digest for r in found if b"WARC-Type: response" in bytes(r.header)}
    assert full == {hashlib.sha256((h or "").encode()).hexdigest() for _, _, h in ROWS}


def test_broken_files():
    head = b"WARC/1.1\r\nContent-Length: 3"
    assert list(warc.records_in([head, b"abc", head, b"abc"])) == [(head + b"\r\n\r\n", b"abc")] * 2
    for pieces in ([head, b"ab"], [head, b"abcd"], [b"HTTP/1.1"], [b"WARC/1.1\r\nX: 1", b""], [head]):
        with pytest.raises(ValueError):
            list(warc.records_in(pieces))
