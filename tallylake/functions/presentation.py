"""Percentages, severity bands and number formats used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the output contract: upper bound (exclusive), label, colour.
SEVERITY_BANDS = (
    (5.0, "OK", "#1F4D3A"),
    (15.0, "ATENÇÃO", "#B8862C"),
    (None, "CRÍTICO", "#B23A2E"),
)

# A quality bar is four pixels wide per percentage point, up to full width.
BAR_SCALE, BAR_FULL = 4, 100


def percent(part: Column, total: Column) -> Column:
    """Share of ``part`` in ``total`` with two decimals; 0.0 of nothing.

    Rounds the double's exact value, ties to even, as the published reports do: the share is split
    into a high and a low half, so that its distance from the tie keeps its sign.
    """
    share = part / total * 100
    low = F.floor(share * 100)
    tie = (low * 2 + 1).cast("double")
    spread = share * F.lit(134217729.0)  # 2^27 + 1
    high = spread - (spread - share)
    over = (high * 200 - tie) + (share - high) * 200
    up = F.when(over > 0, 1).when(over < 0, 0).otherwise(low % 2)
    return F.when(total > 0, (low + up) / F.lit(100.0)).otherwise(F.lit(0.0))


def _band(value: Column, pick: int) -> Column:
    result = None
    for band in SEVERITY_BANDS:
        limit, label = band[0], F.lit(band[pick])
        if result is None:
            result = F.when(value < limit, label)
        elif limit is not None:
            result = result.when(value < limit, label)
        else:
            result = result.otherwise(label)
    return result


def severity_label(value: Column) -> Column:
    return _band(value, 1)


def severity_colour(value: Column) -> Column:
    return _band(value, 2)


def thousands(value: Column) -> Column:
    """1234567 -> ``1,234,567``."""
    return F.format_number(value, 0)


def brl(value: Column) -> Column:
    """1234.5 -> ``R$ 1.234,50``."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(value, 2), ",.", ".,"))


def bar_width(value: Column) -> Column:
    return F.least(value * BAR_SCALE, F.lit(float(BAR_FULL)))
