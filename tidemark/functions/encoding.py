"""Text encodings: numbers, line protocol and JSON."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F, types as T


def float_text(x: Column) -> Column:
    """Shortest decimal text of a double: positional from 1e-4 up to 1e16, else ``1e-05`` style.

    Java prints an exponent below 1e-3 and from 1e7 on; the point store and its readers use the
    wider positional range. The digits are Java's: they always read back as the same number, but
    before Java 19 a few numbers get one digit more than needed.
    """
    plain = x.cast("string")
    fixed = F.regexp_replace(x.cast("decimal(38,21)").cast("string"), "0+$", "")
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    mantissa = F.regexp_replace(F.substring_index(plain, "E", 1), r"\.0$", "")
    exponent = F.substring_index(plain, "E", -1).try_cast("int")
    digits = F.abs(exponent).cast("string")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits),
    )
    size = F.abs(x)
    return (
        F.when(~F.contains(plain, F.lit("E")), plain)
        .when((size >= 1e-4) & (size < 1e16), fixed)
        .otherwise(scientific)
    )


def escape_tag(text: Column) -> Column:
    """Escape the separators of the line protocol inside a tag value; a line break, which would end the
    line, becomes a blank."""
    return F.regexp_replace(F.regexp_replace(text, r"[\r\n]+", " "), r"([,= ])", r"\\$1")


def present(name: str, kind: T.DataType) -> Column:
    """The field has a value the point store accepts."""
    value = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return value.isNotNull()


def has_fields(fields: Sequence[tuple[str, T.DataType]]) -> Column:
    """At least one field has such a value; a stream without fields has no points."""
    return reduce(or_, [present(name, kind) for name, kind in fields], F.lit(False))


def _exact_exponents(field_set: Column) -> Column:
    """Rewrite the values that Java printed with an exponent."""

    def rewrite(cell: Column) -> Column:
        text = F.substring_index(cell, "=", -1)
        number = F.concat(F.substring_index(cell, "=", 1), F.lit("="), float_text(text.cast("double")))
        return F.when(F.contains(text, F.lit("E")), number).otherwise(cell)

    careful = F.array_join(F.transform(F.split(field_set, ","), rewrite), ",")
    return F.when(F.contains(field_set, F.lit("E")), careful).otherwise(field_set)


def line_protocol(
    measurement: str,
    symbol: Column,
    fields: Sequence[tuple[str, T.DataType]],
    time: Column,
    integer_suffix: str = "",
) -> Column:
    """``measurement,symbol=S f1=v1,f2=v2 <epoch ns>``; NULL, NaN and infinite fields are left out.

    Filter by ``has_fields`` first: a filter on the line itself would build every line twice.
    ``integer_suffix="i"`` marks whole numbers as integers for the store.
    """
    values = []
    for name, kind in fields:
        value = F.col(name)
        if integer_suffix and not isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.concat(value.cast("string"), F.lit(integer_suffix))
        values.append(F.when(present(name, kind), value).alias(name))
    # The JSON writer skips NULLs and prints all numbers in one small expression; without quotes
    # and braces its text is the field set. Code written out per field would be too long for the
    # JVM to compile on wide rows. The lambda binds the text, which is used twice, to a variable.
    record = F.to_json(F.struct(*values))
    bare = F.replace(F.replace(record, F.lit('":'), F.lit("=")), F.lit('"'), F.lit(""))
    field_set = F.transform(F.array(F.btrim(bare, F.lit("{}"))), _exact_exponents)[0]
    return F.concat(
        F.lit(f"{measurement},symbol="),
        escape_tag(symbol),
        F.lit(" "),
        field_set,
        F.lit(" "),
        (F.unix_micros(time) * F.lit(1000)).cast("string"),
    )
