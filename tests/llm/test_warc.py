import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import CLASHING, _EXTRA, written
from tidemark.llm.warc import read_warc, task_keys, write_warc

PAGES = f"page_id long, url string, html string, {CLASHING}"


def pages():
    big, other = "<p>same</p>" * 200, "<p>ünder</p>" * 300
    return [(1, "http://a/1", big), (5, "http://a/5", big), (3, None, big), (2, "http://b/ü\n2", "small"), (4, "http://b/4", "small"),
            (6, "http://c", None), (7, "http://c", ""), (8, "http://d", other), (8, "http://d", other), (9, "http://e", "z" * 300_000),
            (None, "http://f", big), (None, None, "null id")]


def table(spark, folder, rows=None, files=3):
    return written(spark, folder, [(*r, *_EXTRA) for r in (pages() if rows is None else rows)], PAGES, files)


def test_round_trip(spark, folder):
    found = read_warc(spark, write_warc(table(spark, folder), f"{folder}/warc", roll_bytes=800)).collect()
    assert len({r.file for r in found}) > 1
    expected = []
    for page_id, _, html in pages():
        data = (html or "").encode()
        again = html and len(data) >= 1000 and html.startswith("<p>same") and page_id != 5
        expected.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 5 if again else None))
    # of two equal rows one is the response
    k = max(i for i, e in enumerate(expected) if e[0] == 8)
    expected[k] = (*expected[k][:3], "revisit", 8)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=key) == sorted(expected, key=key)
    texts = {r.page_id: bytes(r.payload) for r in found if r.record_type == "response" and r.page_id is not None}
    assert texts[9] == b"z" * 300_000 and texts[6] == b"" and "ünder".encode() in texts[8]
    order = [r.page_id for r in sorted(found, key=lambda r: (r.file, r.place))]
    assert order == [None, None, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9]


def test_files_do_not_depend_on_the_partitioning(spark, folder):
    rows = [r for r in pages() if r[0] is not None]
    one = write_warc(table(spark, folder, rows, 1), f"{folder}/one", roll_bytes=800)
    two = write_warc(table(spark, folder, rows, 5), f"{folder}/two", roll_bytes=800)
    read = lambda path: {p.name: p.read_bytes() for p in Path(path).glob("*.warc.gz")}
    assert read(one) == read(two) and len(read(one)) > 1
    assert not list(Path(one, "_temporary").iterdir())
    first = gzip.decompress(next(iter(sorted(read(one).items())))[1])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_uncommitted_files_are_not_read_and_damage_is_seen(spark, folder):
    path = write_warc(table(spark, folder), f"{folder}/warc")
    Path(path, "part-999999.warc.gz").write_bytes(b"not in the manifest")
    assert read_warc(spark, path).count() == len(pages())
    file = Path(path, "part-000000.warc.gz")
    data = gzip.decompress(file.read_bytes()).replace(b"small", b"smelt")
    file.write_bytes(b"".join(gzip.compress(b"WARC/1.1" + part) for part in data.split(b"WARC/1.1")[1:]))
    with pytest.raises(Exception, match="damaged"):
        read_warc(spark, path).collect()


def test_empty_table(spark, folder):
    assert read_warc(spark, write_warc(table(spark, folder, []), f"{folder}/warc")).count() == 0


def test_every_file_has_a_task_of_its_own(spark):
    keys = spark.createDataFrame([(k,) for k in task_keys(spark, 9)], "task int").repartition(9, "task")
    assert keys.select(F.spark_partition_id().alias("p")).distinct().count() == 9
