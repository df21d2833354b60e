"""From raw messages to clean, typed rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.schemas import RawField, StreamSpec, declared_type, stream_spec
from tidemark.sources.messages import decode_json


# the epoch milliseconds that microseconds in a long can hold
MILLIS = (-(2**63 - 1) // 1000 + 1, (2**63 - 1) // 1000)


def clean_predicate(columns: Iterable[tuple[str, T.DataType]], finite: bool = False) -> Column:
    """True when every column is present: not NULL, text not empty, floating point not NaN; with
    ``finite`` not infinite either."""
    tests = []
    for name, kind in columns:
        column = F.col(name)
        tests.append(column.isNotNull())
        if isinstance(kind, T.StringType):
            tests.append(column != "")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            tests.append(~F.isnan(column))
            if finite:
                tests.append(F.abs(column) < float("inf"))
    return reduce(and_, tests)


def _typed(field: RawField) -> Column:
    column = F.col(field.name)
    if field.convert == "number":
        column = column.try_cast("double")
    elif field.convert == "long":
        column = column.cast("long")
    elif field.convert == "millis":
        column = F.when(column.between(*MILLIS), F.timestamp_millis(column))
    return column.alias(field.name)


def normalize(
    df: DataFrame,
    stream: str | StreamSpec,
    strict: bool = False,
    symbols: Sequence[str] | None = None,
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """Decode, clean and type the messages of one stream (batch or streaming).

    A message with a missing or empty declared field is dropped. A price text that is no number and a
    time beyond what a timestamp holds become NULL, "NaN" and "Infinity" stay; ``strict`` drops those
    rows too. No message can stop a stream.
    """
    spec = stream_spec(stream)
    decoded = decode_json(df, spec, passthrough=passthrough)
    clean = decoded.filter(clean_predicate((f.name, declared_type(f.declared)) for f in spec.fields))
    if symbols is not None:
        clean = clean.filter(F.col("symbol").isin(list(symbols)))
    by_name = {f.name: f for f in spec.fields}
    typed = clean.select(*[_typed(by_name[name]) for name in spec.output], *passthrough)
    if strict:
        kinds = {"number": T.DoubleType(), "millis": T.TimestampType()}
        checked = [(f.name, kinds[f.convert]) for f in spec.fields if f.convert in kinds and f.name in spec.output]
        if checked:
            typed = typed.filter(clean_predicate(checked, finite=True))
    return typed


def normalize_trade(df: DataFrame, strict: bool = False, symbols=None) -> DataFrame:
    return normalize(df, "trade", strict, symbols)


def normalize_ticker(df: DataFrame, strict: bool = False, symbols=None) -> DataFrame:
    return normalize(df, "ticker", strict, symbols)


# what turns a stream's messages into rows where declaring the fields does not suffice
NORMALIZERS: dict[str, Callable[..., DataFrame]] = {}


def normalizer(stream: str) -> Callable:
    """Registers a function (messages, strict, symbols, event_time) as the transform of a stream type; the
    live jobs use it from then on."""

    def keep(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        NORMALIZERS[stream] = function
        return function

    return keep


def normalize_messages(
    df: DataFrame, stream: str, strict: bool = False, symbols: Sequence[str] | None = None,
    event_time: str | None = None,
) -> DataFrame:
    """The messages of any stream type as rows, by its own transform or by its declared fields."""
    own = NORMALIZERS.get(stream)
    return own(df, strict, symbols, event_time) if own else normalize(df, stream, strict, symbols)


@normalizer("bookTicker")
def normalize_book_ticker(
    df: DataFrame, strict: bool = False, symbols=None, event_time: str | None = None
) -> DataFrame:
    """Best bid/ask rows; the message has no time, so ``event_time`` is the processing time or
    the named column of the envelope (such as the broker's ``timestamp``)."""
    carried = (event_time,) if event_time else ()
    rows = normalize(df, "bookTicker", strict, symbols, passthrough=carried)
    stamp = F.col(event_time).cast("timestamp") if event_time else F.current_timestamp()
    return rows.select(*stream_spec("bookTicker").output, stamp.alias("event_time"))
