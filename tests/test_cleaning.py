import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators.cleaning import (
    NORMALIZERS, normalize, normalize_book_ticker, normalize_messages, normalize_trade, normalizer,
)
from tidemark.schemas import DEPTH, REGISTRY, RawField, StreamSpec, declared_type, register, stream_spec
from tidemark.sources import messages


def trade(**changes):
    base = {"e": "trade", "E": 1704067200123, "s": "BTCUSDT", "t": 1, "p": "10.5", "q": "2",
            "T": 1704067200123, "m": True, "M": True}
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v != "missing"})


ROWS = [
    trade(t=1),
    trade(t=2, p=""),
    trade(t=3, E="missing"),
    trade(t=4, q=None),
    "not json",
    trade(t=5, p="abc"),
    trade(t=6, p="NaN"),
    trade(t=7, p=10.5),
    trade(t=8, m=False, s="ETHUSDT"),
    trade(t=9, s=""),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame([(r,) for r in ROWS], "value string")


def test_lenient_keeps_unreadable_prices(raw):
    rows = {r.trade_id: r for r in normalize_trade(raw).collect()}
    assert set(rows) == {1, 5, 6, 7, 8}
    assert rows[5].price is None
    assert math.isnan(rows[6].price)
    assert rows[7].price == 10.5
    assert rows[1].trade_time == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert rows[8].is_market_maker is False


def test_strict_drops_them(raw):
    assert {r.trade_id for r in normalize_trade(raw, strict=True).collect()} == {1, 7, 8}


def test_symbol_filter(raw):
    assert [r.trade_id for r in normalize_trade(raw, symbols=["ETHUSDT"]).collect()] == [8]


@pytest.mark.parametrize("case_sensitive", ["true", "false"])
def test_names_that_differ_in_case(spark, raw, case_sensitive):
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", case_sensitive)
    try:
        assert normalize_trade(raw).count() == 5
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def test_binary_payload_and_single_parse(spark, raw):
    binary = raw.select(F.col("value").cast("binary").alias("value"))
    rows = normalize_trade(binary)
    assert rows.count() == 5
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_book_time_comes_from_the_envelope(spark):
    payload = json.dumps({"u": 1, "s": "A", "b": "1", "B": "2", "a": "3", "A": "4"})
    rows = spark.createDataFrame([(payload, datetime(2024, 5, 1))], "value string, timestamp timestamp")
    row = normalize_book_ticker(rows, event_time="timestamp").first()
    assert (row.best_ask_price, row.event_time) == (3.0, datetime(2024, 5, 1))
    assert normalize_book_ticker(rows).first().event_time is not None


def test_declared_types():
    assert declared_type(["null", "long"]) == T.LongType()
    assert declared_type("bytes") == T.StringType()
    assert declared_type({"type": "array", "items": {"type": "array", "items": "string"}}) == T.ArrayType(
        T.ArrayType(T.StringType())
    )
    nested = {"type": "record", "fields": [{"name": "a", "type": {"type": "record", "fields": [
        {"name": "b", "type": ["null", "double"]}]}}]}
    assert declared_type(nested).simpleString() == "struct<a:struct<b:double>>"


def test_depth_arrays(spark):
    payload = json.dumps({"e": "d", "E": 1, "s": "A", "U": 1, "u": 2, "b": [["1", "2"]], "a": []})
    row = messages.decode_json(spark.createDataFrame([(payload,)], "value string"), DEPTH).first()
    assert row.bids == [["1", "2"]] and row.asks == []


def test_new_stream_type(spark):
    spec = register(StreamSpec(
        "markPrice", (RawField("s", "string", "symbol"), RawField("p", "string", "mark", "number"),
                      RawField("E", "long", "at", "millis")),
        ("symbol", "mark", "at"), ("mark",), "at", "at"))
    try:
        rows = spark.createDataFrame([('{"s":"A","p":"1.5","E":1000}',), ('{"s":"A","E":1000}',)], "value string")
        assert normalize(rows, "markPrice").count() == 1
    finally:
        del REGISTRY[spec.name]
    with pytest.raises(KeyError):
        stream_spec("markPrice")


def test_messages_round_trip(spark, raw, folder):
    clean = normalize_trade(raw, strict=True).withColumns(
        {"event_ms": F.unix_millis("trade_time"), "is_best_match": F.lit(True)})
    messages.publish(clean, "trade", path=f"{folder}/out")
    back = normalize_trade(spark.read.text(f"{folder}/out"))
    assert sorted(back.collect()) == sorted(normalize_trade(raw, strict=True).collect())
    assert {r.topic for r in messages.encode_messages(clean, "trade").collect()} == {"market_trade"}


def test_source_arguments(spark):
    with pytest.raises(ValueError):
        messages.read_stream(spark, "trade")
    with pytest.raises(ValueError):
        messages.read_stream(spark, "trade", "files")
    with pytest.raises(ValueError):
        messages.read_stream(spark, "trade", "carrier pigeon")


def test_no_message_stops_a_stream(spark, tmp_path):
    poison = [trade(t=1), trade(t=2, T=2**63 - 1), trade(t=3, T=-(2**63)), trade(t=4, p="Infinity"), trade(t=5, p="-Infinity")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(poison))
    rows = normalize_trade(spark.readStream.text(str(tmp_path / "in")))
    query = rows.writeStream.format("memory").queryName("poison").trigger(availableNow=True).start()
    query.awaitTermination(60)
    found = {r.trade_id: r for r in spark.table("poison").collect()}
    assert set(found) == {1, 2, 3, 4, 5} and found[2].trade_time is None is found[3].trade_time
    batch = spark.createDataFrame([(r,) for r in poison], "value string")
    assert [r.trade_id for r in normalize_trade(batch, strict=True).collect()] == [1]


def test_lines_without_infinite_values_and_line_breaks(spark):
    from tidemark.functions.encoding import has_fields, line_protocol

    fields = [("a", T.DoubleType()), ("b", T.DoubleType())]
    rows = spark.createDataFrame([("X\nY, Z", float("inf"), 1.5), ("W", float("nan"), float("-inf"))], "s string, a double, b double")
    lines = rows.filter(has_fields(fields)).select(line_protocol("m", F.col("s"), fields, F.timestamp_micros(F.lit(1))).alias("l"))
    assert [r.l for r in lines.collect()] == ["m,symbol=X\\ Y\\,\\ Z b=1.5 1000"]


def test_a_stream_brings_its_own_transform(raw):
    @normalizer("trade")
    def doubled(messages, strict, symbols, event_time):
        return normalize(messages, "trade", strict, symbols).withColumn("price", 2 * F.col("price"))

    try:
        found = {r.trade_id: r.price for r in normalize_messages(raw, "trade", strict=True).collect()}
    finally:
        del NORMALIZERS["trade"]
    plain = {r.trade_id: r.price for r in normalize_messages(raw, "trade", strict=True).collect()}
    assert found == {k: 2 * v for k, v in plain.items()} and plain
    assert set(NORMALIZERS) == {"bookTicker"}
