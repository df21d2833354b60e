"""The message log: offsets, restarts, lost segments and writers that meet."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources.log import LogIndex, append_log, read_log, stream_log
from tidemark.sources.messages import publish, read_stream
from tidemark.streaming.queries import drain, write_table


def messages(spark, rows):
    return spark.createDataFrame([(k, v, t) for k, v, t in rows], "key string, value string, second long").select(
        "key", "value", F.timestamp_seconds("second").alias("timestamp"))


def some(n, start=0, hot=3):
    """A third of the messages have one key, some have none."""
    return [("hot" if k % hot == 0 else None if k % 7 == 0 else f"k{k % 11}", f"v{start + k}", 1_700_000_000 + start + k) for k in range(n)]


def offsets(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.partition, []).append((r.offset, r.value.decode()))
    return {p: sorted(held) for p, held in found.items()}


def run(spark, folder, **options):
    drain(write_table(stream_log(spark, f"{folder}/log", "t", **options), f"{folder}/out", f"{folder}/checkpoint", "append", "available"))
    return spark.read.parquet(f"{folder}/out") if any(n.startswith("batch") for n in os.listdir(f"{folder}/out")) else None


def test_offsets_have_no_gaps_and_keys_keep_their_partition_and_order(spark, folder):
    assert append_log(messages(spark, some(200)), f"{folder}/log", "t", partitions=4, segment_rows=16) == 0
    assert append_log(messages(spark, some(90, 200)), f"{folder}/log", "t", partitions=4, segment_rows=16) == 1
    frame = read_log(spark, f"{folder}/log", "t")
    assert dict(frame.dtypes) == {"key": "binary", "value": "binary", "topic": "string", "partition": "int", "offset": "bigint", "timestamp": "timestamp"}
    found = offsets(frame)
    assert all([o for o, _ in held] == list(range(len(held))) for held in found.values()) and sum(map(len, found.values())) == 290
    of_key = {}
    for r in sorted(frame.collect(), key=lambda r: r.offset):
        if r.key is not None:
            of_key.setdefault(r.key.decode(), []).append((r.partition, int(r.value[1:])))
    assert all(len({p for p, _ in held}) == 1 and [v for _, v in held] == sorted(v for _, v in held) for held in of_key.values())


def test_a_restarted_query_goes_on_at_its_offsets(spark, folder):
    append_log(messages(spark, some(60)), f"{folder}/log", "t", partitions=3, segment_rows=7)
    assert run(spark, folder, starting="earliest").count() == 60
    append_log(messages(spark, some(30, 60)), f"{folder}/log", "t", partitions=3, segment_rows=7)
    append_log(messages(spark, some(5, 90)), f"{folder}/log", "t", partitions=5)
    kept = run(spark, folder, starting="earliest")
    assert offsets(kept) == offsets(read_log(spark, f"{folder}/log", "t")) and kept.count() == 95
    assert run(spark, folder, starting="earliest").count() == 95


@pytest.mark.parametrize("starting, expected", [("earliest", 50), ("latest", 10), (json.dumps({"0": 15, "1": 3}), None)])
def test_where_a_query_starts(spark, folder, starting, expected):
    append_log(messages(spark, some(40)), f"{folder}/log", "t", partitions=2)
    ends = LogIndex(f"{folder}/log", "t").refresh().ends()
    run(spark, folder, starting=starting)
    append_log(messages(spark, some(10, 40)), f"{folder}/log", "t", partitions=2)
    kept = run(spark, folder, starting=starting)
    if expected is None:
        expected = sum(r.offset >= {0: 15, 1: 3}[r.partition] for r in read_log(spark, f"{folder}/log", "t").collect())
    assert kept.count() == expected and sum(ends.values()) == 40


def test_a_start_beyond_the_end_raises(spark, folder):
    append_log(messages(spark, some(4)), f"{folder}/log", "t", partitions=1)
    with pytest.raises(Exception, match="no such offsets"):
        run(spark, folder, starting=json.dumps({"0": 5}))


def test_a_lost_segment_is_skipped_or_raises(spark, folder):
    append_log(messages(spark, some(100)), f"{folder}/log", "t", partitions=2, segment_rows=10)
    base, end, path = LogIndex(f"{folder}/log", "t").refresh().segments[0][1]
    os.remove(f"{folder}/log/t/segments/{path}")
    with pytest.raises(Exception, match="lost"):
        run(spark, folder, starting="earliest", fail_on_data_loss=True)
    kept = run(spark, f"{folder}/second", starting="earliest", fail_on_data_loss=False) if os.makedirs(f"{folder}/second") else None
    assert kept is None
    os.symlink(f"{folder}/log", f"{folder}/second/log")
    kept = run(spark, f"{folder}/second", starting="earliest", fail_on_data_loss=False)
    assert kept.count() == 100 - (end - base) and not kept.where(f"partition = 0 AND offset >= {base} AND offset < {end}").count()


def test_a_writer_that_lost_the_race_commits_behind_the_other(spark, folder, monkeypatch):
    from tidemark.sources import log

    append_log(messages(spark, some(10)), f"{folder}/log", "t", partitions=1)
    own, met = log.put_file, []

    def late(spark_, path, text):
        if not met:
            met.append(path)
            assert own(spark_, path, json.dumps({"append": "other", "segments": json.loads(text)["segments"]}))
        return own(spark_, path, text)

    monkeypatch.setattr(log, "put_file", late)
    assert append_log(messages(spark, some(5, 10)), f"{folder}/log", "t", partitions=1) == 2
    assert [o for o, _ in offsets(read_log(spark, f"{folder}/log", "t"))[0]] == list(range(20))
    assert not own(spark, f"{folder}/log/t/commits/{2:020d}.json", "{}")


def test_an_append_is_done_once(spark, folder):
    rows = messages(spark, some(10))
    assert append_log(rows, f"{folder}/log", "t", append="a") == 0 and append_log(rows, f"{folder}/log", "t", append="a") is None
    assert read_log(spark, f"{folder}/log", "t").count() == 10
    assert read_log(spark, f"{folder}/log", "none").count() == 0


def test_publish_and_read_a_stream_type(spark, folder):
    rows = spark.createDataFrame([(1, "A", 2.5), (2, "B", 3.5)], "trade_id long, symbol string, price double")
    publish(rows, "trade", log=f"{folder}/log")
    rows.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    query = publish(stream, "trade", log=f"{folder}/log", checkpoint=f"{folder}/published")
    query.processAllAvailable()
    query.stop()
    read = read_stream(spark, "trade", "log", path=f"{folder}/log", starting="earliest")
    drain(write_table(read, f"{folder}/out", f"{folder}/checkpoint", "append", "available"))
    kept = spark.read.parquet(f"{folder}/out").selectExpr("string(key) AS key", "string(value) AS value", "topic").collect()
    assert sorted(r.key for r in kept) == ["A", "A", "B", "B"] and {r.topic for r in kept} == {"market_trade"}
