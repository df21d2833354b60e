from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import selection as sel
from tidemark.operators.joins import _with_salts, hot_keys, lookup_join
from tidemark.operators.windows import aggregate_window, epoch_micros, interval_micros
from tidemark.plans import dashboards as d, views as v

T0 = datetime(2024, 1, 1)


def frame(spark, rows, schema="symbol string, event_time timestamp, value double, id long"):
    return spark.createDataFrame(rows, schema)


def test_latest_breaks_ties_and_keeps_nulls(spark):
    rows = frame(spark, [("A", T0, 1.0, 1), ("A", T0 + timedelta(1), 2.0, 2), ("A", T0 + timedelta(1), None, 3),
                         ("B", T0, 5.0, 9)])
    newest = {r.symbol: r for r in sel.latest(rows, ["symbol"], "event_time", "id").collect()}
    assert newest["A"].id == 3 and newest["A"].value is None
    assert newest["B"].value == 5.0
    texts = rows.withColumn("note", F.concat("symbol", F.col("id").cast("string")))
    newest = {r.symbol: r for r in sel.latest(texts, ["symbol"], "event_time", "id").collect()}
    assert newest["A"].note == "A3"


def test_latest_is_a_hash_aggregate(spark):
    rows = frame(spark, [("A", T0, 1.0, 1)])
    plan = sel.latest(rows, ["symbol"], "event_time", "id")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_dedup_keeps_the_smallest(spark):
    rows = frame(spark, [("A", T0, 2.0, 1), ("A", T0, 1.0, 7), ("A", T0, 1.0, 5), ("B", T0, 9.0, 1)])
    kept = {(r.symbol, r.value, r.id) for r in sel.dedup(rows).collect()}
    assert kept == {("A", 1.0, 5), ("B", 9.0, 1)}


def test_bounds(spark):
    rows = frame(spark, [("A", T0 + timedelta(hours=h), float(h), h) for h in range(6)])
    assert sel.time_range(rows, "event_time", T0, T0 + timedelta(hours=2)).count() == 2
    assert sel.last_interval(rows, "event_time", T0 + timedelta(hours=3), "2 hours").count() == 3
    assert sel.temporal_range(rows, "event_time").count() == 6
    assert sel.temporal_range(rows, "event_time", hi=T0 + timedelta(hours=1)).count() == 1


def test_empty_windows(spark):
    rows = frame(spark, [("A", T0 + timedelta(seconds=12), 1.0, 1), ("B", T0 + timedelta(seconds=1), 3.0, 2),
                         ("B", T0 + timedelta(seconds=2), 5.0, 3), (None, T0, 7.0, 4)])
    aggs = {"mean": F.avg("value")}
    args = ("event_time", "5 seconds", ["symbol"], aggs, T0, T0 + timedelta(seconds=20))
    dense = aggregate_window(rows, *args, fill_empty=True).collect()
    assert len(dense) == 12
    filled = {(r.symbol, r.window_start): r.mean for r in dense if r.mean is not None}
    assert filled == {("A", T0 + timedelta(seconds=10)): 1.0, ("B", T0): 4.0, (None, T0): 7.0}
    assert aggregate_window(rows, *args).count() == 3
    with pytest.raises(ValueError):
        aggregate_window(rows, "event_time", "5 seconds", ["symbol"], aggs, fill_empty=True)
    assert aggregate_window(rows, "event_time", "1 day", ["symbol"], aggs, T0, T0, True).count() == 0


def test_a_dense_key_fills_several_tasks(spark):
    rows = frame(spark, [("A", T0, 1.0, 1)])
    dense = aggregate_window(rows, "event_time", "1 second", ["symbol"], {"mean": F.avg("value")}, T0,
                             T0 + timedelta(days=2), True)
    sizes = [r["count"] for r in dense.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 172_800 and len(sizes) > 1


def test_dense_panels_outside_utc(spark):
    rows = frame(spark, [("A", T0 + timedelta(hours=5), 1.0, 1)])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        dense = aggregate_window(rows, "event_time", "1 hour", ["symbol"], {"mean": F.avg("value")}, T0,
                                 T0 + timedelta(days=1), True)
        found = [(r.h, r.mean) for r in dense.select(F.unix_micros("window_start").alias("h"), "mean").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(found) == 24 and [h for h, m in found if m == 1.0] == [epoch_micros(T0 + timedelta(hours=5))]


def test_latest_with_missing_ties_and_times(spark):
    rows = frame(spark, [("A", T0, 1.0, None), ("A", T0 - timedelta(hours=1), 2.0, 9), ("B", None, 3.0, 1)])
    narrow = sel.latest(rows, ["symbol"], "event_time", "id")
    text = sel.latest(rows.withColumn("t", F.lit("x")), ["symbol"], "event_time", "id")
    for found in (narrow, text):
        assert {r.symbol: r.value for r in found.collect()} == {"A": 1.0, "B": 3.0}
    named = rows.withColumn("t", F.col("value").cast("string"))
    assert {r.symbol: r.value for r in sel.latest(named, ["symbol"], "event_time", "t").collect()}["A"] == 1.0


def test_a_heat_map_has_no_hidden_limit(spark):
    cells = spark.range(12_000).select(
        F.col("id").cast("string").alias("symbol"), F.col("id").cast("double").alias("price_change_percent"),
        F.lit("all").alias("constant"), F.lit(T0).alias("close_time"))
    found = v.heatmap_normalized(cells)
    assert found.count() == 12_000
    assert found.agg(F.min("normalized"), F.max("normalized")).first() == (0.0, 1.0)
    few = {r.symbol: r.normalized for r in v.heatmap_normalized(cells, row_limit=3).collect()}
    assert few == {"0": 0.0, "1": 1 / 11_999, "10": 10 / 11_999}


def test_intervals():
    assert interval_micros("5 seconds") == 5_000_000
    assert epoch_micros("1970-01-02") == 86_400_000_000
    with pytest.raises(ValueError):
        interval_micros("a while")


def test_spread_without_usable_bid(spark):
    rows = spark.createDataFrame(
        [("A", 1, 0.0, 1.0, 2.0, 1.0, T0), ("B", 2, 2.0, 1.0, 3.0, 1.0, T0), ("C", 3, 2.0, 1.0, None, 1.0, T0)],
        "symbol string, update_id long, best_bid_price double, best_bid_qty double, best_ask_price double, "
        "best_ask_qty double, event_time timestamp")
    windows = {r.symbol: r.spread_percentage for r in d.spread_percent_windows(rows, "1 minute").collect()}
    assert windows["A"] != windows["A"] and windows["B"] == 50.0 and "C" not in windows
    latest = {r.symbol: r.spread_percentage for r in d.latest_spread(rows, T0 + timedelta(seconds=5)).collect()}
    assert latest["B"] == 50.0 and "C" not in latest


def test_top_symbols(spark):
    rows = spark.createDataFrame(
        [("AUSDT", "5"), ("BUSDT", None), ("CUSDT", "x"), ("DBTC", "99"), ("EUSDT", "50.5")],
        "symbol string, quoteVolume string")
    assert [r.symbol for r in sel.top_symbols(rows, limit=3).collect()] == ["eusdt", "ausdt", "busdt"]


def test_page_and_series_limit(spark):
    rows = frame(spark, [(s, T0 + timedelta(hours=h), float(ord(s)), h) for s in "ABC" for h in range(4)])
    assert [r.id for r in sel.page(rows, ["event_time", "symbol"], 2, 3).collect()] == [1, 1]
    kept = sel.limit_series(rows, "symbol", F.avg("value"), 2)
    assert {r.symbol for r in kept.collect()} == {"B", "C"}


def test_normalized_heatmap_of_equal_cells(spark):
    rows = spark.createDataFrame([("A", "all", 1.0, T0), ("B", "all", 1.0, T0)],
                                 "symbol string, constant string, price_change_percent double, close_time timestamp")
    assert {r.normalized for r in v.heatmap_normalized(rows).collect()} == {0.0}


def test_paging_after_a_row_gives_every_row_once(spark):
    rows = frame(spark, [(s, None if k == 0 else T0 + timedelta(hours=k % 3), None if k == 1 else float(k % 2), k)
                         for s in ("A", None, "B") for k in range(5)])
    order, seen, after = ["symbol", "event_time", "value", "id"], [], None
    while found := sel.page_after(rows, order, 4, after).collect():
        seen += [tuple(r[c] for c in order) for r in found]
        after = seen[-1]
    assert seen == [tuple(r[c] for c in order) for r in rows.orderBy(*order).collect()]


@pytest.mark.parametrize("limit", [10_000, 0])
def test_lookup_join_with_and_without_broadcast(spark, limit):
    left = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    table = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    for how, size in (("left", 1000), ("inner", 667)):
        joined = lookup_join(left, table, ["k"], how=how, broadcast_bytes=limit)
        assert joined.columns == ["k", "v", "name"]
        assert joined.count() == size
        assert joined.filter("k = 1 and name = 'b'").count() == 333


def test_copies_of_one_row_spread_over_the_salts(spark):
    left = spark.range(400, numPartitions=8).select(F.lit(1).alias("k"))
    table = spark.createDataFrame([(1, "b")], "k int, name string")
    joined = lookup_join(left, table, ["k"], broadcast_bytes=0)
    assert joined.filter("name = 'b'").count() == 400
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "SPARK_PARTITION_ID" in plan


def test_only_hot_keys_are_repeated(spark):
    n = 30_000  # a third of the rows has one key, a tenth none, the rest are keys of their own
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id"))
    left = spark.range(n, numPartitions=6).select(key.cast("long").alias("k"), F.col("id").alias("v"))
    table = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).union(
        spark.createDataFrame([(None, -1)], "k long, w long"))
    hot, found = hot_keys(left, ["k"], 100)
    salts = {r["_hash"]: r["_salts"] for r in hot.collect()}
    wanted = {r["k"]: r["h"] for r in spark.createDataFrame([(0,), (None,)], "k long").select("k", F.xxhash64("k").alias("h")).collect()}
    assert found == 2 and set(salts) == set(wanted.values())
    assert salts[wanted[0]] in (33, 34) and 5 <= salts[wanted[None]] <= 8
    joined = lookup_join(left, table, ["k"], broadcast_bytes=0, slices=100)
    assert joined.count() == n
    assert joined.filter(~F.col("w").eqNullSafe(F.coalesce(F.col("k") * 2, F.lit(-1)))).count() == 0
    exploded = _with_salts(table, ["k"], hot).select(F.sum(F.coalesce("_salts", F.lit(1)))).first()[0]
    assert exploded == n + 1 + sum(salts.values()) - 2
    even = lookup_join(table, table.withColumnRenamed("w", "u"), ["k"], broadcast_bytes=0, slices=100)
    assert "_salt" not in even._jdf.queryExecution().optimizedPlan().toString() and even.count() == n + 1
    assert lookup_join(left.limit(0), table, ["k"], broadcast_bytes=0).count() == 0


def test_measured_size(spark):
    from tidemark.session import settle_sized

    rows = spark.createDataFrame([("abc", [1.0] * 10, 1)], "s string, a array<double>, n long")
    table, size = settle_sized(rows)
    assert table.first() == rows.first() and size == 16 + 24 + 3 + 80
    assert settle_sized(rows.limit(0))[1] == 0


def test_clear_scratch(spark, tmp_path, monkeypatch):
    from tidemark import session

    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    table = session.settle(spark.range(5))
    assert table.count() == 5
    assert session.clear_scratch(spark) and not (tmp_path / "tidemark").exists()
