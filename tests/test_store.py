import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.test_streaming import archived, feed, message, source
from tidemark.operators.cleaning import normalize_trade
from tidemark.sources import archive
from tidemark.streaming import queries as live, sinks, store


def batches(*groups):
    return iter([pa.RecordBatch.from_pydict({"line": list(g)}) for g in groups])


def stored(spark, folder):
    return sorted(r.line for r in store.read_points(spark, folder).collect())


def test_only_committed_files_are_read(spark, folder):
    writer = store.FolderWriter(folder, "b0")
    first = writer.write(batches(["x 1", "y 2"], []))
    assert first.lines == 2 and writer.write(batches()) == store.Delivery(0)

    def failing():
        yield from batches(["z 3"])
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(failing())
    again = writer.write(batches(["z 3"]))  # the failed task alone is tried again
    assert len(os.listdir(f"{folder}/lines")) == 2
    store.FolderWriter(folder, "b1").write(batches(["never 1"]))  # an executor that is lost before its commit
    writer.commit([first, None, again])
    assert stored(spark, folder) == ["x 1", "y 2", "z 3"]
    assert {(r.batch, r.lines) for r in store.deliveries(spark, folder).collect()} == {("b0", 2), ("b0", 1)}
    other = store.FolderWriter(folder, "b2")
    gone = other.write(batches(["w 4"]))
    other.abort([gone, None])
    assert gone.file not in os.listdir(f"{folder}/lines") and len(stored(spark, folder)) == 3


def test_a_batch_is_delivered_once(spark, folder):
    lines = spark.range(100, numPartitions=3).select(F.concat(F.lit("m v="), "id").alias("line"))
    target = store.line_store(f"{folder}/s")
    assert store.deliver(lines, target, "q-0") and not store.deliver(lines, target, "q-0")
    assert store.deliver(lines.limit(0), target, "q-1")
    assert store.read_points(spark, f"{folder}/s").groupBy("batch").count().collect() == [("q-0", 100)]
    assert store.deliveries(spark, f"{folder}/s").agg(F.sum("lines")).first()[0] == 100
    with pytest.raises(ValueError):
        store.line_store()


def test_a_failing_task_commits_nothing(spark, folder):
    bad = F.when(F.col("id") == 99, F.raise_error(F.lit("broken row"))).otherwise(F.concat(F.lit("m v="), "id"))
    lines = spark.range(100, numPartitions=3).select(bad.cast("string").alias("line"))
    with pytest.raises(Exception, match="broken row"):
        store.deliver(lines, store.line_store(f"{folder}/s"), "q-0")
    assert not os.path.exists(f"{folder}/s/commits")


def test_sent_lines_are_recorded(spark, folder):
    def save(lines):
        with open(f"{folder}/{os.getpid()}-{id(lines)}.sent", "a") as handle:
            handle.writelines(line + "\n" for line in lines)

    lines = spark.range(10, numPartitions=2).select(F.concat(F.lit("m v="), "id").alias("line"))
    assert sinks.send_lines(lines, save, f"{folder}/ledger", "q-0")
    assert not sinks.send_lines(lines, save, f"{folder}/ledger", "q-0")
    assert spark.read.text(f"{folder}/*.sent").count() == 10
    assert sorted(r.lines for r in store.deliveries(spark, f"{folder}/ledger").collect()) == [5, 5]


def test_both_sinks_read_the_source_once_and_recover_alone(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(value):
        seen.add(1)
        return True

    def rows():
        return normalize_trade(source(spark, f"{folder}/in").filter(counted("value")))

    def run(**targets):
        live.drain(sinks.write_both(rows(), "trade", f"{folder}/archive", f"{folder}/cp", trigger="available",
                                    clock=lambda: 86_400 * 9, **targets))

    feed(spark, f"{folder}/in", [message(1), message(2, seconds=1), "poison"])
    run(store=f"{folder}/store")
    assert seen.value == 3 and archived(spark, folder).count() == 2 and len(stored(spark, f"{folder}/store")) == 2

    def broken(lines):
        raise OSError("store is down")

    feed(spark, f"{folder}/in", [message(3, seconds=2)])
    with pytest.raises(Exception, match="store is down"):
        run(writer=broken)
    assert archived(spark, folder).count() == 3 and seen.value == 4  # archived, without points
    feed(spark, f"{folder}/in", [message(4, seconds=3)])
    run(store=f"{folder}/store")
    assert seen.value == 5  # the failed batch is not read again
    assert archived(spark, folder).count() == 4 and len(stored(spark, f"{folder}/store")) == 4
    assert archive.read_batches(spark, f"{folder}/archive", "trade", [86_400 * 9]).count() == 4
    with pytest.raises(ValueError):
        sinks.write_both(rows(), "trade", folder, folder)
