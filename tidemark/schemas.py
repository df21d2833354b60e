"""Declared record schemas and the registry of stream types."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

# Primitive type names of the declaration language and their Spark types.
PRIMITIVES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def declared_type(declaration: Any) -> T.DataType:
    """Spark type of a declared type: primitive name, union list, record, array or map.

    A union takes its first non-null branch; a name that is not known reads as text.
    """
    if isinstance(declaration, list):
        branches = [branch for branch in declaration if branch != "null"]
        return declared_type(branches[0]) if branches else T.StringType()
    if isinstance(declaration, dict):
        kind = declaration.get("type")
        if kind == "record":
            return T.StructType(
                [T.StructField(f["name"], declared_type(f["type"]), True) for f in declaration["fields"]]
            )
        if kind == "array":
            return T.ArrayType(declared_type(declaration["items"]))
        if kind == "map":
            return T.MapType(T.StringType(), declared_type(declaration["values"]))
        return declared_type(kind)
    return PRIMITIVES.get(declaration, T.StringType())


@dataclass(frozen=True)
class RawField:
    """One declared message field and the typed column it becomes.

    ``convert`` is ``keep`` (as declared), ``number`` (text to double), ``long`` or ``millis``
    (epoch milliseconds to timestamp). ``keep=False`` fields take part in cleaning only.
    """

    raw: str
    declared: Any
    name: str
    convert: str = "keep"
    keep: bool = True


@dataclass(frozen=True)
class StreamSpec:
    """Everything a source, sink or view needs to know about one stream type."""

    name: str
    fields: tuple[RawField, ...]
    output: tuple[str, ...]
    point_fields: tuple[str, ...]
    time_column: str
    id_column: str

    @property
    def declaration(self) -> dict[str, Any]:
        return {
            "type": "record",
            "name": self.name,
            "fields": [{"name": f.raw, "type": f.declared} for f in self.fields],
        }

    @property
    def raw_schema(self) -> T.StructType:
        return declared_type(self.declaration)


REGISTRY: dict[str, StreamSpec] = {}


def register(spec: StreamSpec) -> StreamSpec:
    """Add a stream type; every source, sink and view accepts its name afterwards."""
    REGISTRY[spec.name] = spec
    return spec


def stream_spec(stream: str | StreamSpec) -> StreamSpec:
    if isinstance(stream, StreamSpec):
        return stream
    if stream not in REGISTRY:
        raise KeyError(f"unknown stream {stream!r}; registered: {sorted(REGISTRY)}")
    return REGISTRY[stream]


# Message field letters, their declared types and the warehouse column names.
TRADE = register(
    StreamSpec(
        name="trade",
        fields=(
            RawField("e", "string", "event"),
            RawField("E", "long", "event_ms", keep=False),
            RawField("s", "string", "symbol"),
            RawField("t", "long", "trade_id"),
            RawField("p", "string", "price", "number"),
            RawField("q", "string", "quantity", "number"),
            RawField("T", "long", "trade_time", "millis"),
            RawField("m", "boolean", "is_market_maker"),
            RawField("M", "boolean", "is_best_match", keep=False),
        ),
        output=("trade_id", "event", "symbol", "price", "quantity", "trade_time", "is_market_maker"),
        point_fields=("price", "quantity"),
        time_column="trade_time",
        id_column="trade_id",
    )
)

TICKER = register(
    StreamSpec(
        name="ticker",
        fields=(
            RawField("e", "string", "event"),
            RawField("E", "long", "event_time", "millis"),
            RawField("s", "string", "symbol"),
            RawField("p", "string", "price_change", "number"),
            RawField("P", "string", "price_change_percent", "number"),
            RawField("w", "string", "weighted_avg_price", "number"),
            RawField("x", "string", "prev_close_price", "number"),
            RawField("c", "string", "last_price", "number"),
            RawField("Q", "string", "last_qty", "number"),
            RawField("b", "string", "best_bid_price", "number"),
            RawField("B", "string", "best_bid_qty", "number"),
            RawField("a", "string", "best_ask_price", "number"),
            RawField("A", "string", "best_ask_qty", "number"),
            RawField("o", "string", "open_price", "number"),
            RawField("h", "string", "high_price", "number"),
            RawField("l", "string", "low_price", "number"),
            RawField("v", "string", "base_volume", "number"),
            RawField("q", "string", "quote_volume", "number"),
            RawField("O", "long", "open_time", "millis"),
            RawField("C", "long", "close_time", "millis"),
            RawField("F", "long", "first_trade_id"),
            RawField("L", "long", "last_trade_id"),
            RawField("n", "int", "trade_count", "long"),
        ),
        output=(
            "event", "event_time", "symbol", "price_change", "price_change_percent",
            "weighted_avg_price", "prev_close_price", "last_price", "last_qty", "best_bid_price",
            "best_bid_qty", "best_ask_price", "best_ask_qty", "open_price", "high_price",
            "low_price", "base_volume", "quote_volume", "open_time", "close_time",
            "first_trade_id", "last_trade_id", "trade_count",
        ),
        point_fields=(
            "price_change", "price_change_percent", "weighted_avg_price", "prev_close_price",
            "last_price", "last_qty", "best_bid_price", "best_bid_qty", "best_ask_price",
            "best_ask_qty", "open_price", "high_price", "low_price", "base_volume",
            "quote_volume", "first_trade_id", "last_trade_id", "trade_count",
        ),
        time_column="close_time",
        id_column="last_trade_id",
    )
)

BOOK_TICKER = register(
    StreamSpec(
        name="bookTicker",
        fields=(
            RawField("u", "long", "update_id"),
            RawField("s", "string", "symbol"),
            RawField("b", "string", "best_bid_price", "number"),
            RawField("B", "string", "best_bid_qty", "number"),
            RawField("a", "string", "best_ask_price", "number"),
            RawField("A", "string", "best_ask_qty", "number"),
        ),
        output=(
            "symbol", "update_id", "best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty",
        ),
        point_fields=("best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty", "update_id"),
        time_column="event_time",
        id_column="update_id",
    )
)

DEPTH = register(
    StreamSpec(
        name="depth",
        fields=(
            RawField("e", "string", "event"),
            RawField("E", "long", "event_time", "millis"),
            RawField("s", "string", "symbol"),
            RawField("U", "long", "first_update_id"),
            RawField("u", "long", "final_update_id"),
            RawField("b", {"type": "array", "items": {"type": "array", "items": "string"}}, "bids"),
            RawField("a", {"type": "array", "items": {"type": "array", "items": "string"}}, "asks"),
        ),
        output=("event", "event_time", "symbol", "first_update_id", "final_update_id", "bids", "asks"),
        point_fields=(),
        time_column="event_time",
        id_column="final_update_id",
    )
)

# Column lists of the warehouse tables.
TABLE_SCHEMAS: dict[str, str] = {
    "trade": (
        "trade_id bigint, event string, symbol string, price double, quantity double, "
        "trade_time timestamp, is_market_maker boolean"
    ),
    "ticker": (
        "event string, event_time timestamp, symbol string, price_change double, "
        "price_change_percent double, weighted_avg_price double, prev_close_price double, "
        "last_price double, last_qty double, best_bid_price double, best_bid_qty double, "
        "best_ask_price double, best_ask_qty double, open_price double, high_price double, "
        "low_price double, base_volume double, quote_volume double, open_time timestamp, "
        "close_time timestamp, first_trade_id bigint, last_trade_id bigint, trade_count bigint"
    ),
    "bookTicker": (
        "symbol string, update_id bigint, best_bid_price double, best_bid_qty double, "
        "best_ask_price double, best_ask_qty double, event_time timestamp"
    ),
    "ticker_predict": (
        "event_time timestamp, symbol string, last_price double, best_bid_price double, "
        "best_ask_price double, trade_count bigint"
    ),
}


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns a forecast job reads, scales and encodes."""

    keys: tuple[str, ...] = ("symbol",)
    time_column: str = "event_time"
    features: tuple[str, ...] = ("last_price", "best_bid_price", "best_ask_price", "trade_count")
    time_features: tuple[str, ...] = (
        "month_sin", "day_sin", "weekday_sin", "hour_sin", "minute_sin", "second_sin",
    )


TICKER_FEATURES = FeatureSpec()


def table_ddl(name: str) -> str:
    """Columns of a warehouse table: a listed one, or what the registered stream puts out."""
    if name in TABLE_SCHEMAS:
        return TABLE_SCHEMAS[name]
    spec = stream_spec(name)
    kinds = {"number": "double", "long": "bigint", "millis": "timestamp"}
    fields = {f.name: kinds.get(f.convert) or declared_type(f.declared).simpleString() for f in spec.fields}
    return ", ".join(f"`{c}` {fields[c]}" for c in spec.output)
