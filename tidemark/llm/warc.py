"""WARC archives: a deterministic sharded writer, and the reader.

Records are compressed where they are read. Their sort keys and compressed sizes alone are then range
sorted and summed up, which fixes the first key of each file; the same rows give the same files
whatever the partitioning. A task per file sorts its records, writes them under a temporary name and
renames the file. The manifest is written last and commits: readers open only what it lists. A task
that runs twice writes the same bytes again.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import Batches, identified, in_batches, text_of
from tidemark.session import settle, settle_sized

DATE = "2000-01-01T00:00:00Z"  # records carry no time of their own, and two runs must agree
BROADCAST_BYTES = 16 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without time or name
    return packer.compress(data) + packer.flush()


def _line(value: object) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", str(value))


def build_record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One compressed record: headers without the None values, lengths and digests made anew."""
    sha = hashlib.sha1(block).hexdigest()
    headers = [*headers, ("WARC-Block-Digest", f"sha1:{sha}"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {_line(v)}\r\n" for k, v in headers if v is not None)
    return _gzip(head.encode() + b"\r\n" + block + b"\r\n\r\n")


def page_record(page_id: int | None, url: str | None, payload: bytes, refers: tuple | None) -> tuple[bytes, str]:
    """The record of a page and its payload digest; ``refers`` names the page a revisit repeats."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", record_id(page_id, url, digest)),
        ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"), ("X-Page-Id", page_id),
        ("X-Payload-Length", len(payload)),
    ]
    if refers:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(*refers, digest)),
                    ("WARC-Refers-To-Target-URI", refers[1]), ("X-Refers-To-Page-Id", refers[0])]
    return build_record(headers, http if refers else http + payload), digest


_RECORD = pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("url", pa.string()), ("size", pa.int64()),
                     ("record", pa.binary())])
_RECORD_DDL = "page_id long, digest string, url string, size long, record binary"


def _build(batches: Batches) -> Batches:
    for batch in batches:
        def rows(batch=batch):
            for page_id, url, payload, revisit, to_page, to_url in zip(*(c.to_pylist() for c in batch.columns)):
                record, digest = page_record(page_id, url, payload, (to_page, to_url) if revisit else None)
                yield page_id, digest, url, len(record), record

        yield from in_batches(rows(), _RECORD, lambda row: row[3])


def repeats(pages: DataFrame, least: int = 1000) -> DataFrame:
    """uid, to_page, to_url of each row of uid, page_id, url, payload whose payload another row stands for.

    Payloads of ``least`` bytes or more are compared by length and SHA-256; of equal ones the largest
    page_id stands (the first row of several, NULL last). Groups meet as one partial aggregate per
    task; the lookup that follows has one row per group on its other side, so its hot keys can split.
    """
    marks = settle(pages.select(
        "uid", "page_id", "url", F.octet_length("payload").alias("bytes"),
        F.sha2("payload", 256).alias("sha")).where(F.col("bytes") >= least))
    best = F.max(F.struct("page_id", (-F.col("uid")).alias("first"), "url")).alias("best")
    groups = marks.groupBy("bytes", "sha").agg(best, F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "bytes", "sha", "best")
    return marks.select("uid", "bytes", "sha").join(groups, ["bytes", "sha"]).where(
        F.col("uid") != -F.col("best.first")).select(
        "uid", F.col("best.page_id").alias("to_page"), F.col("best.url").alias("to_url"))


# NULL identifiers sort first
_KEY = ["has_id", "page_id", "digest", "url"]


def _keyed(records: DataFrame) -> DataFrame:
    return records.withColumns({"has_id": F.col("page_id").isNotNull(), "page_id": F.coalesce("page_id", F.lit(0)),
                                "url": F.coalesce("url", F.lit(""))})


_SUMS = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("size", pa.int64()), ("has_id", pa.bool_()),
                   ("page_id", pa.int64()), ("digest", pa.string()), ("url", pa.string())])


def _running(batches: Batches) -> Batches:
    total = 0
    for batch in batches:
        sizes = batch.column("size").to_pylist()
        before = []
        for size in sizes:
            before.append(total)
            total += size
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), pa.array(before, pa.int64()), batch.column("size"),
             *(batch.column(c) for c in _KEY)], schema=_SUMS)


def file_starts(records: DataFrame, roll_bytes: int) -> list[tuple]:
    """The first sort key of every file: a new one starts where the compressed bytes so far pass a multiple
    of ``roll_bytes``. One sum per sorting task and one key per file come to the driver."""
    sorted_keys = _keyed(records).select("size", *_KEY).repartitionByRange(*_KEY).sortWithinPartitions(*_KEY, "size")
    sums = settle(sorted_keys.withColumn("part", F.spark_partition_id()).mapInArrow(
        _running, "part int, before long, size long, has_id boolean, page_id long, digest string, url string"))
    offsets, total = {}, 0
    for part, size in sorted(map(tuple, sums.groupBy("part").agg(F.sum("size")).collect())):
        offsets[part] = total
        total += size
    if not offsets:
        return []
    start = records.sparkSession.createDataFrame(list(offsets.items()), "part int, start long")
    keys = sums.join(F.broadcast(start), "part").select(
        F.floor((F.col("start") + F.col("before")) / roll_bytes).alias("file"), F.struct(*_KEY).alias("key"))
    return [tuple(r["key"]) for r in keys.groupBy("file").agg(F.min("key").alias("key")).orderBy("key").collect()]


def _file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return pa.fs.FileSystem.from_uri(path)


def task_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of n partitions a number that hash partitioning deals to it, so that n files meet n tasks."""
    task = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("task")
    found = spark.range(20 * n + 100).groupBy(task).agg(F.min("id").cast("int").alias("key")).collect()
    keys = {r["task"]: r["key"] for r in found}
    return [keys.get(k, k) for k in range(n)]


def _place(starts: list[tuple], tasks: list[int]):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in _KEY))
            files = [bisect.bisect_right(starts, key) - 1 for key in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tasks[f] for f in files], pa.int32()), pa.array(files, pa.int32()), *batch.columns],
                names=["task", "file", *batch.schema.names])

    return run


_MANIFEST = pa.schema([("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def _write(path: str):
    """Streams the sorted records of each file into it."""

    def close(system: pa.fs.FileSystem, base: str, file: int, temporary: str, out, seen: list) -> tuple:
        out.close()
        name = f"part-{file:06d}.warc.gz"
        system.move(temporary, f"{base}/{name}")
        return name, seen[0], seen[1], seen[2].hexdigest()

    def rows(batches: Batches) -> Iterator[tuple]:
        system, base = _file_system(path)
        now, out, temporary, seen = None, None, "", []
        for batch in batches:
            for file, record in zip(batch.column("file").to_pylist(), batch.column("record").to_pylist()):
                if file != now:
                    if out:
                        yield close(system, base, now, temporary, out, seen)
                    now, temporary, seen = file, f"{base}/_temporary/{uuid.uuid4().hex}", [0, 0, hashlib.sha256()]
                    out = system.open_output_stream(temporary, compression=None)
                    record = build_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, None, str(file))),
                                           ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                                          b"format: WARC File Format 1.1\r\n") + record
                out.write(record)
                seen[0] += 1
                seen[1] += len(record)
                seen[2].update(record)
        if out:
            yield close(system, base, now, temporary, out, seen)

    def run(batches: Batches) -> Batches:
        yield from in_batches(rows(batches), _MANIFEST)

    return run


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               roll_bytes: int = 16 << 20, least: int = 1000) -> str:
    """Writes one record per row of ``pages`` below ``path`` and returns ``path`` (an action).

    Of rows with equal payloads of at least ``least`` bytes one is a response and the others revisit
    it (see ``repeats``). Records lie in the order of page_id, digest and url, NULL identifiers first;
    a file ends once it holds ``roll_bytes`` compressed, at the end of a record (rows that are equal in
    all three share a file). NULL html counts as empty; a NULL url leaves its header out; control
    characters in a url are percent-encoded. An empty table writes an empty manifest. ``path`` must be
    a new folder that all executors reach. Only the three named columns are read.
    """
    spark = pages.sparkSession
    rows = identified(pages, {"page_id": F.col(f"`{page_id}`").cast("long"), "url": F.col(f"`{url}`").cast("string"),
                            "payload": text_of(html).cast("binary")})
    found, size = settle_sized(repeats(rows, least).withColumn("revisit", F.lit(True)))
    joined = rows.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "uid", "left")
    # built twice, for their sizes and to be written: cheaper than to keep them in between
    records = joined.select(
        "page_id", "url", "payload", F.coalesce("revisit", F.lit(False)).alias("revisit"), "to_page", "to_url"
    ).mapInArrow(_build, _RECORD_DDL)
    starts = file_starts(settle(records.drop("record")), roll_bytes)
    system, base = _file_system(path)
    system.create_dir(f"{base}/_temporary", recursive=True)
    keyed = _keyed(records).select(*_KEY, "size", "record")
    tasks = max(1, len(starts))
    numbers = [T.StructField(c, T.IntegerType()) for c in ("task", "file")]
    placed = keyed.mapInArrow(_place(starts, task_keys(spark, tasks)), T.StructType([*numbers, *keyed.schema.fields]))
    placed.repartition(tasks, "task").sortWithinPartitions("file", *_KEY, "size").mapInArrow(
        _write(path), "name string, records long, bytes long, sha256 string").write.json(f"{path}/manifest")
    return path


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a compressed archive, read as a stream."""
    buffer, inflate = b"", None
    data = b""
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                break
        inflate = inflate or zlib.decompressobj(31)
        buffer += inflate.decompress(data)
        data = inflate.unused_data
        if inflate.eof:  # a record is one gzip member
            head, _, rest = buffer.partition(b"\r\n\r\n")
            headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            length = int(headers["Content-Length"])
            if rest[length:] != b"\r\n\r\n":
                raise ValueError(f"record {headers.get('WARC-Record-ID')} does not end where it should")
            yield headers, rest[:length]
            buffer, inflate = b"", None
    if buffer or inflate:
        raise ValueError("the archive ends inside a record")


_READ = pa.schema([("file", pa.string()), ("place", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("payload", pa.binary())])
_READ_DDL = ("file string, place long, page_id long, url string, record_type string, refers_to long, "
             "payload_bytes long, payload_digest string, payload binary")


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _read(path: str):
    def rows(names: list[str]) -> Iterator[tuple]:
        system, base = _file_system(path)
        for name in names:
            with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                for place, (headers, block) in enumerate(parse(stream)):
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    if hashlib.sha1(block).hexdigest() != headers["WARC-Block-Digest"].removeprefix("sha1:"):
                        raise ValueError(f"{name}: record {place} is damaged")
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest, length = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
                    revisit = headers["WARC-Type"] == "revisit"
                    if not revisit and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{name}: payload {place} is damaged")
                    yield (name, place, _number(headers.get("X-Page-Id")), headers.get("WARC-Target-URI"),
                           headers["WARC-Type"], _number(headers.get("X-Refers-To-Page-Id")), length, digest,
                           None if revisit else payload)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield from in_batches(rows(batch.column(0).to_pylist()), _READ, lambda row: len(row[-1] or b""))

    return run


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every page record of the archives that the manifest lists, checked against its digests.

    Columns: file, place, page_id, url, record_type, refers_to (the page that a revisit repeats),
    payload_bytes, payload_digest (hexadecimal SHA-1), payload (NULL for a revisit). A damaged record
    raises.
    """
    manifest = spark.read.schema("name string, records long, bytes long, sha256 string").json(f"{path}/manifest")
    files = manifest.count()
    return manifest.select("name").repartition(max(1, files)).mapInArrow(_read(path), _READ_DDL)
