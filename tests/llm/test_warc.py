import gzip
import hashlib

import odd
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import storage, warc

BIG = "<html>" + "é" * 1000 + "</html>"


def captured(rows):
    """What must be read back for (page_id, url, html) rows."""
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h] = max(last.get(h, i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = last.get(h) if len(data) >= 1000 else None
        refers = first if first is not None and first != i else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a.example.com/x", BIG),
    (2, "http://b.example.com/y?z=1", BIG),
    (3, "http://b.example.com/y?z=1", BIG),
    (4, "http://b.example.com/y", "small"),
    (5, "http://c.example.com/y", "small"),
    (6, None, None),
    (7, "", ""),
    (8, "no scheme", "x"),
    (9, "http://t.example.com/a\tb\nc", "y" * 3000),
    (10, "http://l.example.com/" + "p" * 3000, "long url"),
    (11, "http://l.example.com/" + "p" * 3000 + "q", "long url too"),
    (5, "http://c.example.com/y", "small"),
    (None, "http://n.example.com/", BIG),
    (12, "http://big.example.com/", "z" * 3_000_000),
]


@pytest.mark.parametrize("lines", [3000, 2])
def test_pages_come_back(spark, monkeypatch, lines):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    hot = [(100 + i, "http://hot.example.com/", f"page {i}") for i in range(50)]
    pages = odd.pages(spark, ROWS + hot)
    archive = warc.write(pages)
    assert [tuple(r) for r in odd.rows_of(warc.lookup(archive, pages))] == captured(ROWS + hot)
    one = warc.lookup(archive, odd.pages(spark, [(120, "http://hot.example.com/", None), (999, "http://hot.example.com/", None), (1, "http://none/", None)]), payload=True)
    assert [(r["page_id"], bytes(r["payload"])) for r in one.collect()] == [(120, b"page 20")]


def test_archives_are_warc_files(spark):
    archive = warc.write(odd.pages(spark, ROWS))
    files = {r["file"] for r in archive.captures.collect()}
    for name in files:
        with gzip.open(name.removeprefix("file:"), "rb") as f:
            data = f.read()
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    kinds = {r["page_id"]: r["record_type"] for r in archive.captures.collect()}
    assert kinds[1] == kinds[2] == kinds[None] == "revisit" and kinds[3] == "response"


def test_directory_is_sparse_and_sorted(spark, monkeypatch):
    monkeypatch.setattr(warc, "MAX_ENTRIES", 8)
    monkeypatch.setattr(warc, "BLOCK_LINES", 1)
    rows = [(i, f"http://h{i % 7}.example.com/{i}", "") for i in range(200)]
    archive = warc.write(odd.pages(spark, rows))
    entries = archive.directory.collect()
    assert sum(r["lines"] for r in entries) == 200
    # Each writing task may end with a block that is not full.
    assert len(entries) <= 8 / 2 + len({r["file"] for r in entries})
    assert warc.lookup(archive, odd.pages(spark, rows)).count() == 200


def test_empty_table(spark):
    archive = warc.write(odd.pages(spark, []))
    assert warc.lookup(archive, odd.pages(spark, ROWS)).count() == 0


def test_damaged_payload_is_noticed():
    good = warc.record(1, "http://a/", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.parse(good)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"payload\r\n", b"paYload\r\n"))


def test_keys_reverse_the_host(spark):
    rows = [(1, "http://WWW.Example.com/A?b"), (2, None), (3, "x/y")]
    df = spark.createDataFrame(rows, "i int, url string").select("i", warc.sort_key("url").alias("k"))
    assert {r["i"]: r["k"] for r in df.collect()} == {1: "com,example,www)/A?b", 2: "", 3: ")/x/y"}
    assert storage.shared_folder(spark)


def test_blocks_of_one_long_head_stay_in_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    head = "http://x.example.com/" + "k" * 300
    # Later blocks of the head begin with smaller page ids, and the pages behind begin in its last block.
    rows = [(900 - i, f"{head}{i:03}", f"page {i}") for i in range(10)]
    rows += [(2000 + i, f"http://x.example.com/l{i}", f"behind {i}") for i in range(10)]
    archive = warc.write(odd.pages(spark, rows))
    entries = archive.directory.collect()
    assert len({r["key"] for r in entries}) < len(entries)
    assert [tuple(r) for r in odd.rows_of(warc.lookup(archive, odd.pages(spark, rows)))] == captured(rows)


def test_reads_are_dealt_to_tasks_by_captures(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK_CAPTURES", 100)
    pages = spark.range(950).selectExpr("id as page_id", "concat('http://h', id % 7, '.example.com/', id) as url", "cast(id as string) as html")
    got = warc.lookup(warc.write(pages), pages)
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 950 and len(tasks) == 10 and max(tasks) < 300
