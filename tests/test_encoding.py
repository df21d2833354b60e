import random
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.encoding import escape_tag, float_text
from tidemark.operators.points import pivot_fields, to_line_protocol, to_points, upsert_points


def test_numbers_print_like_the_store_expects(spark):
    rng = random.Random(3)
    numbers = [0.0, -0.0, 1.0, 1e-5, 1.5e-4, 0.001, 123456.789, 1e7, 12345678.125, 9.9e15, 1e16, 2.5e+20, -2e-7,
               3.14, 100.0, 1e15]
    numbers += [round(rng.uniform(-1e6, 1e6), rng.randint(0, 6)) for _ in range(300)]
    numbers += [round(rng.random(), 4) * 10 ** rng.randint(-3, 9) for _ in range(300)]
    frame = spark.createDataFrame([(n,) for n in numbers], "x double")
    texts = [r.t for r in frame.select(float_text(F.col("x")).alias("t")).collect()]
    for number, text in zip(numbers, texts):
        assert float(text) == number
    assert texts[:16] == [repr(n) for n in numbers[:16]]


def test_line_leaves_out_missing_fields(spark):
    rows = spark.createDataFrame(
        [("BTC", 1.5, None, datetime(2024, 1, 1)), ("E H", float("nan"), 2.0, datetime(2024, 1, 1)),
         ("X", None, None, datetime(2024, 1, 1))],
        "symbol string, price double, quantity double, trade_time timestamp")
    lines = [r.line for r in to_line_protocol(rows, "trade").collect()]
    assert lines == [
        "trade,symbol=BTC price=1.5 1704067200000000000",
        "trade,symbol=E\\ H quantity=2.0 1704067200000000000",
    ]


def test_escape(spark):
    row = spark.createDataFrame([("a,b=c d",)], "t string").select(escape_tag(F.col("t")).alias("t")).first()
    assert row.t == "a\\,b\\=c\\ d"


def test_points_and_back(spark):
    rows = spark.createDataFrame(
        [("A", datetime(2024, 1, 1), 1.0, None), ("B", datetime(2024, 1, 1), 3.0, 4.0)],
        "symbol string, at timestamp, bid double, ask double")
    points = to_points(rows, "book", ["bid", "ask"], "at")
    assert points.count() == 3
    wide = pivot_fields(points, ["bid", "ask"])
    assert {tuple(r) for r in wide.collect()} == {
        ("A", datetime(2024, 1, 1), 1.0, None), ("B", datetime(2024, 1, 1), 3.0, 4.0)}


def test_last_write_wins(spark):
    rows = spark.createDataFrame(
        [("m", "A", "f", 1.0, datetime(2024, 1, 1), 1), ("m", "A", "f", 2.0, datetime(2024, 1, 1), 5),
         ("m", "A", "f", 3.0, datetime(2024, 1, 2), 2)],
        "measurement string, symbol string, field string, value double, time timestamp, seq int")
    assert sorted(r.value for r in upsert_points(rows, "seq").collect()) == [2.0, 3.0]


def test_line_with_exponents(spark):
    rows = spark.createDataFrame(
        [("A", 1e-5, 123456789.5, datetime(1970, 1, 1)), ("A", 2.5, 1e-5, datetime(1970, 1, 1)),
         ("A", None, 1e7, datetime(1970, 1, 1))],
        "symbol string, price double, quantity double, trade_time timestamp")
    assert [r.line for r in to_line_protocol(rows, "trade").collect()] == [
        "trade,symbol=A price=1e-05,quantity=123456789.5 0",
        "trade,symbol=A price=2.5,quantity=1e-05 0",
        "trade,symbol=A quantity=10000000.0 0",
    ]
