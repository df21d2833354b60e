import json
import os
import pathlib
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.cleaning import normalize_trade
from tidemark.sources import archive, files, messages
from tidemark.streaming import queries as live, sinks

T0 = datetime(2024, 1, 1)
SCHEMA = "symbol string, event_time timestamp, value double, id long"


def message(i, symbol="A", price="1.5", seconds=0):
    millis = 1704067200000 + seconds * 1000
    return json.dumps({"e": "trade", "E": millis, "s": symbol, "t": i, "p": price, "q": "2", "T": millis,
                       "m": True, "M": True})


def feed(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)


def source(spark, path):
    return messages.read_stream(spark, "trade", "files", path=path)


def rows_stream(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)


def archived(spark, folder):
    return archive.open_archive(spark, f"{folder}/archive", "trade")


def run_stream(spark, folder):
    started = live.start_stream(
        source(spark, f"{folder}/in"), "trade", f"{folder}/archive", f"{folder}/checkpoints",
        points_path=f"{folder}/points", archive_trigger="available", points_trigger="available")
    live.drain(started.archive, started.points)


def test_restart_adds_only_new_messages(spark, folder):
    feed(spark, f"{folder}/in", [message(1), message(2, price=""), "poison", message(3, price="abc")])
    run_stream(spark, folder)
    assert archived(spark, folder).count() == 2
    run_stream(spark, folder)
    assert archived(spark, folder).count() == 2
    feed(spark, f"{folder}/in", [message(4, seconds=9)])
    run_stream(spark, folder)
    assert {r.trade_id for r in archived(spark, folder).collect()} == {1, 3, 4}
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/points").collect()
    assert len(lines) == 3


def test_repeated_batch_replaces_itself(spark, folder):
    batch = spark.createDataFrame([(1,)], "trade_id long")
    sinks.archive_batch(batch, f"{folder}/a/query_id=q", 0, 100)
    sinks.archive_batch(batch, f"{folder}/a/query_id=q", 0, 200)
    rows = spark.read.parquet(f"{folder}/a").collect()
    assert [(r.trade_id, r.ingest_epoch) for r in rows] == [(1, 200)]


def test_failing_sink_stops_the_query_without_a_commit(spark, folder):
    feed(spark, f"{folder}/in", [message(1)])
    rows = normalize_trade(source(spark, f"{folder}/in"))

    def broken(lines):
        raise OSError("store is down")

    query = sinks.write_points(rows, "trade", f"{folder}/cp", writer=broken, trigger="available")
    with pytest.raises(Exception, match="store is down"):
        live.drain(query)
    good = sinks.write_points(rows, "trade", f"{folder}/cp", path=f"{folder}/points", trigger="available")
    live.drain(good)
    assert spark.read.option("recursiveFileLookup", "true").text(f"{folder}/points").count() == 1


def test_points_need_one_target(spark, folder):
    with pytest.raises(ValueError):
        sinks.write_points(None, "trade", folder)


def test_late_rows_are_dropped(spark, folder):
    rows_stream(spark, f"{folder}/in", [("A", T0, 1.0, 1), ("A", T0 + timedelta(hours=2), 1.0, 2)])
    stream = rows_stream(spark, f"{folder}/in2", [("A", T0 + timedelta(hours=2), 1.0, 2)])
    panel = live.live_windows(stream, "event_time", "10 minutes", ["symbol"], {"n": F.count(F.lit(1))}, "1 minute")

    def run():
        live.drain(live.write_table(panel, f"{folder}/out", f"{folder}/cp", "append", "available"))

    run()
    rows_stream(spark, f"{folder}/in2", [("A", T0, 1.0, 3), ("A", T0 + timedelta(hours=5), 1.0, 4)])
    run()
    out = spark.read.parquet(f"{folder}/out").collect()
    assert [(r.window_start, r.n) for r in out] == [(T0 + timedelta(hours=2), 1)]


def test_dedup_and_latest(spark, folder):
    rows = [("A", T0, 1.0, 1), ("A", T0, 2.0, 2), ("B", T0, 3.0, 3)]
    stream = rows_stream(spark, f"{folder}/in", rows)
    live.drain(live.write_table(live.live_dedup(stream, "1 minute"), f"{folder}/d", f"{folder}/cd", "append", "available"))
    assert spark.read.parquet(f"{folder}/d").count() == 2
    newest = live.live_latest(stream, ["symbol"], "event_time", "id")
    live.drain(live.write_table(newest, f"{folder}/l", f"{folder}/cl", "update", "available"))
    assert {(r.symbol, r.id) for r in spark.read.parquet(f"{folder}/l").collect()} == {("A", 2), ("B", 3)}


def test_await_any_and_triggers(spark):
    assert sinks.trigger_options(None) == {}
    assert sinks.trigger_options("available") == {"availableNow": True}
    assert sinks.trigger_options("60 seconds") == {"processingTime": "60 seconds"}


def write_batches(spark, folder, epochs):
    for i, epoch in enumerate(epochs):
        rows = spark.createDataFrame([(i, "trade", "A", 1.0, 1.0, T0, True)], archive.TABLE_SCHEMAS["trade"])
        sinks.archive_batch(rows, f"{folder}/trade/query_id=q", i, epoch)


def test_archive_selection_and_pruning(spark, folder):
    day = 86_400
    write_batches(spark, folder, [10 * day + i for i in range(6)] + [20 * day])
    chosen = archive.read_archive(spark, folder, "trade", 20 * day + 5, days_ago=1, max_batches=3)
    assert {r.ingest_epoch for r in chosen.collect()} == {10 * day + i for i in (3, 4, 5)}
    assert len(chosen.inputFiles()) == 3
    newest = archive.read_archive(spark, folder, "trade", 20 * day + 5, days_ago=0, max_batches=2)
    assert {r.ingest_epoch for r in newest.collect()} == {20 * day, 10 * day + 5}
    since = archive.read_since(spark, folder, "trade", 20 * day + 5, clock_skew=60)
    assert {r.ingest_epoch for r in since.collect()} == {20 * day}
    current = archive.read_current(spark, folder, "trade", 20 * day + 5, max_batches=9)
    assert current.count() == 1


def test_selection_lists_folders_and_starts_no_job(spark, folder):
    write_batches(spark, folder, [100, 200, 300])
    rows = spark.createDataFrame([(9, "trade", "B", 1.0, 1.0, T0, True)], archive.TABLE_SCHEMAS["trade"])
    rows.write.parquet(f"{folder}/trade/400")  # the plain layout: a folder per epoch
    context = spark.sparkContext
    context.setJobGroup("selection", "selection")
    try:
        assert archive.newest_batches(spark, folder, "trade", 1000, 0, 3) == [400, 300, 200]
        chosen = archive.read_archive(spark, folder, "trade", 1000, days_ago=0, max_batches=2)
        assert not context.statusTracker().getJobIdsForGroup("selection")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert {(r.ingest_epoch, r.symbol) for r in chosen.collect()} == {(400, "B"), (300, "A")}
    assert archive.read_batches(spark, folder, "trade", [7]).count() == 0
    assert archive.read_archive(spark, folder, "ticker", 1000).count() == 0


def test_an_index_lists_few_folders_of_a_long_archive(spark, folder, monkeypatch):
    day = 86_400
    write_batches(spark, folder, [d * day + h for d in range(100, 110) for h in (0, 7)])
    base, marks = f"{folder}/trade", {f"q~{b}": e for b, e in enumerate(d * day + h for d in range(100, 110) for h in (0, 7))}
    shutil.rmtree(f"{base}/_days")  # an archive from before there was an index
    cases = [lambda: archive.newest_batches(spark, folder, "trade", 109 * day + 9, 1, 3),
             lambda: sorted(r.ingest_epoch for r in archive.read_since(spark, folder, "trade", 108 * day + 5, 0).collect()),
             lambda: sorted(r.ingest_epoch for r in archive.read_batches(spark, folder, "trade", [103 * day, 104 * day + 7]).collect()),
             lambda: archive.newest_batches(spark, folder, "trade", 500 * day, 0, 1000)]
    before = [case() for case in cases]
    assert before[0] == [108 * day + 7, 108 * day, 107 * day + 7] and len(before[3]) == 20
    archive.index_archive(spark, folder, "trade")
    found = {p.name.partition("~")[2]: int(p.name.partition("~")[0]) for p in pathlib.Path(base, "_days").glob("*/[0-9]*")}
    assert found == marks
    for year in range(1000, 1365):  # days without a batch that is wanted
        os.makedirs(f"{base}/_days/{year}")
    asked = []
    monkeypatch.setattr(archive, "names", lambda s, path: asked.append(path) or files.names(s, path))
    monkeypatch.setattr(archive, "_listed", None)
    counts = []
    for case, wanted in zip(cases[:3], before):
        asked.clear()
        assert case() == wanted
        counts.append(len(asked))
    assert counts[0] == 3 and counts[2] == 3  # the days, and two of them
    monkeypatch.undo()
    kept = spark.read.parquet(f"{base}/query_id=q/batch_id=19").drop("ingest_epoch")
    rows = spark.createDataFrame(kept.collect(), kept.schema)
    sinks.archive_batch(rows, f"{base}/query_id=q", 19, 120 * day)  # a second attempt, days later
    assert archive.newest_batches(spark, folder, "trade", 500 * day, 0, 2) == [120 * day, 109 * day]
    sinks.archive_batch(rows.limit(0), f"{base}/query_id=q", 19, 121 * day)
    assert archive.newest_batches(spark, folder, "trade", 500 * day, 0, 1) == [109 * day]
    assert archive.open_archive(spark, folder, "trade").count() == 19


def test_plain_folders_get_no_index(spark, folder):
    write_batches(spark, folder, [100])
    os.rename(f"{folder}/trade/query_id=q/batch_id=0/ingest_epoch=100", f"{folder}/trade/400")
    archive.index_archive(spark, folder, "trade")
    assert not os.path.exists(f"{folder}/trade/_days/_ready")
    assert archive.newest_batches(spark, folder, "trade", 1000, 0) == [400]


def test_a_registered_stream_has_a_table_and_lines(spark, folder):
    from tidemark.operators.points import to_line_protocol
    from tidemark.schemas import stream_spec, table_ddl

    empty = spark.createDataFrame([], table_ddl("depth"))
    assert empty.columns == list(stream_spec("depth").output)
    empty.write.parquet(f"{folder}/depth")
    assert archive.register_tables(spark, folder, tables=["depth"], nested=True) == ["depth"]
    assert spark.table("depth").count() == 0
    assert to_line_protocol(empty.withColumn("symbol", F.lit("A")), "depth", time=empty.columns[0]).count() == 0


def test_tables_in_a_database(spark, folder):
    write_batches(spark, folder, [1, 2])
    archive.register_tables(spark, folder, database="market_test", tables=["trade"])
    try:
        assert spark.table("market_test.trade").count() == 2
    finally:
        spark.sql("DROP DATABASE market_test CASCADE")


def test_files(spark, folder):
    with open(f"{folder}/snapshot.json", "w") as handle:
        json.dump([{"symbol": "AUSDT", "quoteVolume": "1.5", "count": 3}, {"symbol": "B"}], handle)
    rows = files.read_snapshot(spark, f"{folder}/snapshot.json").collect()
    assert [(r.symbol, r.quoteVolume) for r in rows] == [("AUSDT", "1.5"), ("B", None)]
    frame = spark.range(50).selectExpr("id", "id * 0.5 as half").repartition(5)
    files.export_csv(frame, f"{folder}/csv", single_file=True)
    back = files.read_series_csv(spark, f"{folder}/csv")
    assert back.count() == 50 and dict(back.dtypes)["half"] == "double"
    assert files.read_series_csv(spark, f"{folder}/csv", schema="id long, half double").count() == 50


def test_publish_replaces_old_predictions(spark, folder):
    def frame(n):
        return spark.createDataFrame([(T0, "A", 1.0, 2.0, 3.0, 4)] * n, archive.TABLE_SCHEMAS["ticker_predict"])

    for n in (3, 1):
        path = sinks.publish_forecast(frame(n), folder, points_path=f"{folder}/points")
    assert spark.read.parquet(path).count() == 1
    lines = [r.value for r in spark.read.text(f"{folder}/points").collect()]
    assert lines == ["ticker,symbol=A last_price=1.0,best_bid_price=2.0,best_ask_price=3.0,trade_count=4i "
                     "1704067200000000000"]
    with pytest.raises(ValueError):
        sinks.replace_points(frame(1))


def test_points_reach_a_writer_on_the_executors(spark, folder):
    import uuid

    feed(spark, f"{folder}/in", [message(1), message(2, symbol="B", seconds=1)])
    rows = normalize_trade(source(spark, f"{folder}/in"))

    def save(lines):
        with open(f"{folder}/{uuid.uuid4().hex}.lines", "w") as handle:
            handle.writelines(line + "\n" for line in lines)

    live.drain(sinks.write_points(rows, "trade", f"{folder}/cp", writer=save, trigger="available"))
    stored = sorted(r.value for r in spark.read.text(f"{folder}/*.lines").collect())
    assert stored == ["trade,symbol=A price=1.5,quantity=2.0 1704067200000000000",
                      "trade,symbol=B price=1.5,quantity=2.0 1704067201000000000"]


def test_run_all_stops_the_rest_when_one_fails(spark, folder):
    feed(spark, f"{folder}/in", [message(1)])
    rows = normalize_trade(source(spark, f"{folder}/in"))

    def broken(lines):
        raise OSError("store is down")

    spark.streams.resetTerminated()
    good = sinks.write_archive(rows, f"{folder}/archive", "trade", f"{folder}/c1", "1 hour")
    bad = sinks.write_points(rows, "trade", f"{folder}/c2", writer=broken)
    with pytest.raises(Exception, match="store is down"):
        live.run_all(spark, good, bad, timeout=120)
    assert not good.isActive and not bad.isActive
    spark.streams.resetTerminated()


BOOK = ("symbol string, update_id long, best_bid_price double, best_bid_qty double, best_ask_price double, "
        "best_ask_qty double, event_time timestamp")


def book_rows():
    return [(s, i, 10.0 + i % 7, 1.0, 11.0 + i % 5, float(i), T0 + timedelta(seconds=40 * i))
            for i in range(60) for s in ("A", "B")]


def test_panels_give_the_same_rows_on_a_stream(spark, folder):
    from tidemark.plans import dashboards as d

    batch = spark.createDataFrame(book_rows(), BOOK)
    batch.repartition(3).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(BOOK).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
    marked = stream.withWatermark("event_time", "1 hour")
    for i, panel in enumerate((d.spread_percent_windows, d.bid_ask_windows)):
        live.drain(live.write_table(panel(marked, "5 minutes"), f"{folder}/o{i}", f"{folder}/c{i}", "complete", "available"))
        expected = {tuple(r) for r in panel(batch, "5 minutes").collect()}
        assert {tuple(r) for r in spark.read.parquet(f"{folder}/o{i}").collect()} == expected


def test_table_as_csv(spark, folder):
    stream = rows_stream(spark, f"{folder}/in", [("A", T0, 1.0, 1)])
    live.drain(live.write_table(stream, f"{folder}/o", f"{folder}/c", "append", "available", fmt="csv"))
    row = files.read_series_csv(spark, f"{folder}/o/batch_id=0").first()
    assert (row.symbol, row.value) == ("A", 1.0)


def changes(spark, folder, batches):
    for n, rows in batches.items():
        spark.createDataFrame(rows, "k string, v long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch_id={n}")


def test_merged_updates_read_the_same_and_open_few_folders(spark, folder):
    changes(spark, folder, {n: [("a", n), (f"k{n}", n)] for n in range(6)})
    expected = {"a": 5, **{f"k{n}": n for n in range(6)}}
    read = lambda: dict(live.read_updates(spark, folder, ["k"]).collect())
    assert read() == expected
    before = live.read_updates(spark, folder, ["k"])
    assert live.merge_updates(spark, folder, ["k"]) == 4 and read() == expected
    opened = {f.rpartition("/")[0] for f in live.read_updates(spark, folder, ["k"]).inputFiles()}
    assert len(opened) == 2
    # a reader from before the merge still has its files; the newest batch may come again
    assert dict(before.collect()) == expected
    changes(spark, folder, {5: [("a", 50)], 6: [("a", 60)], 7: [("b", 7)]})
    assert live.merge_updates(spark, folder, ["k"]) == 6
    assert read() == {**{k: v for k, v in expected.items() if k != "k5"}, "a": 60, "b": 7}
    assert live.merge_updates(spark, folder, ["k"]) is None
    left = set(files.subfolders(spark, folder, "batch_id="))
    assert left == {5, 6, 7} and list(files.subfolders(spark, f"{folder}/_merged", "last=")) == [4, 6]


def test_a_small_file_is_swapped_or_stays(spark, folder):
    assert files.get_file(spark, f"{folder}/a/b") is None
    assert files.put_file(spark, f"{folder}/a/b", "one") and not files.put_file(spark, f"{folder}/a/b", "two")
    assert files.get_file(spark, f"{folder}/a/b") == "one"
    assert files.put_file(spark, f"{folder}/a/b", "zwölf", replace=True) and files.get_file(spark, f"{folder}/a/b") == "zwölf"


def test_idle_keys_leave_the_state(spark, folder):
    def run(rows):
        stream = rows_stream(spark, f"{folder}/in", rows)
        newest = live.live_latest_expiring(stream, ["symbol"], "event_time", "1 minute", "1 hour", "id", ["symbol", "id", "value"])
        query = live.write_table(newest, f"{folder}/out", f"{folder}/cp", "update", "available", rocksdb=True)
        live.drain(query)
        state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        return {r.symbol: r.id for r in live.read_updates(spark, f"{folder}/out", ["symbol"]).collect()}, state[-1]["numRowsTotal"]

    found, _ = run([("A", T0, 1.0, 1), ("A", T0, 1.0, 3), ("A", T0, 1.0, 2), ("B", T0, 1.0, 4), ("B", None, 1.0, 9)])
    assert found == {"A": 3, "B": 4}
    found, small = run([("B", T0 + timedelta(hours=5), 1.0, 5), ("C", T0 + timedelta(hours=5), 1.0, None)])
    # A is idle; a late row of it changes nothing
    found, small = run([("A", T0 - timedelta(hours=1), 1.0, 6), ("C", T0 + timedelta(hours=5), 1.0, 7), ("B", T0 + timedelta(hours=4), 1.0, 8)])
    assert found == {"A": 3, "B": 5, "C": 7}
    found, large = run([(f"K{k}", T0 + timedelta(hours=5), 1.0, k) for k in range(40)])
    assert large > small
    run([("Z", T0 + timedelta(hours=50), 1.0, 1)])
    found, after = run([("Z", T0 + timedelta(hours=50), 1.0, 2)])
    assert after < large and len(found) == 44 and found["Z"] == 2


def test_a_table_sees_new_batches_and_not_those_written_again(spark, folder):
    archive.register_tables(spark, f"{folder}/archive", database="market_live", tables=["trade"])
    try:
        table = spark.table("market_live.trade")
        assert table.count() == 0
        for n in (1, 2):
            feed(spark, f"{folder}/in", [message(n)])
            rows = normalize_trade(source(spark, f"{folder}/in"))
            live.drain(sinks.write_archive(rows, f"{folder}/archive", "trade", f"{folder}/cp", "available", table="market_live.trade"))
            assert spark.table("market_live.trade").count() == n
        row = spark.table("market_live.trade").where("batch_id = 1").first()
        at = f"{folder}/archive/trade"
        again = spark.table("market_live.trade").where("batch_id = 1").drop("query_id", "batch_id", "ingest_epoch")
        sinks.archive_batch(spark.createDataFrame(again.collect(), again.schema), f"{at}/query_id={row.query_id}", 1, row.ingest_epoch + 9)
        sinks.commit_partition(spark, "market_live.trade", at, row.query_id, 1)
        assert sorted(r.ingest_epoch for r in spark.table("market_live.trade").where("batch_id = 1").collect()) == [row.ingest_epoch + 9]
    finally:
        spark.sql("DROP DATABASE market_live CASCADE")
