"""Price, spread and time-grain expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Time grain codes of the chart specifications.
GRAINS = {
    "PT1S": "second", "PT1M": "minute", "PT1H": "hour", "P1D": "day", "P1W": "week",
    "P1M": "month", "P1Y": "year",
}


def notional(price: str = "price", quantity: str = "quantity") -> Column:
    """Traded value of one row."""
    return F.col(price) * F.col(quantity)


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def spread_percent(bid: Column, ask: Column) -> Column:
    """(ask - bid) / bid in percent; NaN when a side is missing or the bid is zero."""
    usable = bid.isNotNull() & ask.isNotNull() & (bid != 0)
    return F.when(usable, (ask - bid) / bid * 100.0).otherwise(F.lit(float("nan")))


def truncate(t: Column, grain: str) -> Column:
    """Truncate to a chart grain (``P1D``, ``PT1S``, ...) or a unit name."""
    return F.date_trunc(GRAINS.get(grain, grain), t)


# microseconds that leave room for a tie in 38 digits: up to the year 30,000
FAR = 9 * 10**17


def recency(time: str, tie: str | None = None) -> Column:
    """One sortable number for (time, whole-number tie); NULL comes first in either, as in a struct.

    A decimal keeps ``max_by`` in hash aggregation, where a struct ordering would force every
    input partition to be sorted first. Times beyond ``FAR`` count as ``FAR``.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    micros = F.when(micros.isNull(), F.lit(-FAR - 1)).otherwise(F.greatest(F.least(micros, F.lit(FAR)), F.lit(-FAR)))
    if tie is None:
        return micros
    weight = F.lit(Decimal(10) ** 20).cast("decimal(21,0)")
    order = F.coalesce(F.col(tie).cast("long"), F.lit(-(2**63)))
    return micros.cast("decimal(18,0)") * weight + order.cast("decimal(19,0)")
