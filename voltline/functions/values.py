"""Cleaning and conversion of single values."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timeutil import _col

# What the German market files print for "no value".
NOT_AVAILABLE = ("N.A.",)
NOT_AVAILABLE_OR_INACTIVE = ("N.E.", "N.A.")

KELVIN_AT_ZERO_CELSIUS = 273.15


def decimal_comma(text: Column | str) -> Column:
    """`"1,5"` -> 1.5; anything unreadable -> NULL."""
    return F.translate(F.trim(_col(text)), ",", ".").try_cast("double")


def blank_to_null_double(text: Column | str) -> Column:
    """Blank cell -> NULL (not 0), else DOUBLE."""
    return F.nullif(F.trim(_col(text)), F.lit("")).try_cast("double")


def null_tokens(text: Column | str, tokens: tuple[str, ...]) -> Column:
    """NULL where the trimmed text is one of `tokens`."""
    text = F.trim(_col(text))
    return F.when(~text.isin(*tokens), text)


def nan_to_null(value: Column | str) -> Column:
    """NaN never enters a table."""
    value = _col(value)
    return F.when(~F.isnan(value), value)


def zero_to_null(value: Column | str) -> Column:
    """An exact 0.0 means "inactive" in the scarcity component."""
    return F.nullif(_col(value), F.lit(0.0))


def normalise_key(text: Column | str, width: int = 8) -> Column:
    """First run of digits, zero-padded on the left to `width`; longer runs are kept whole."""
    digits = F.nullif(F.regexp_extract(_col(text).cast("string"), r"(\d+)", 1), F.lit(""))
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def pad_key(text: Column | str, width: int = 8) -> Column:
    """Zero-pad on the left without ever cutting a longer value."""
    text = _col(text).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def kw_to_mw(kw: Column | str) -> Column:
    return _col(kw).cast("double") / 1000.0


def kelvin_to_celsius(kelvin: Column | str) -> Column:
    return _col(kelvin) - KELVIN_AT_ZERO_CELSIUS


def metres_to_mm(metres: Column | str) -> Column:
    return _col(metres) * 1000.0


def per_block_to_per_hour(price: Column | str, block_hours: int = 4) -> Column:
    return _col(price) / float(block_hours)


def wind_speed(u: Column | str, v: Column | str) -> Column:
    """Speed from its components; take it per cell, before any averaging."""
    return F.hypot(_col(u), _col(v))


def area_weight(latitude: Column | str) -> Column:
    """Relative area of a regular latitude/longitude cell."""
    return F.cos(F.radians(_col(latitude)))


def grid_index(value: Column | str, origin: float, step: float, size: int) -> Column:
    """Index of the nearest point of a regular axis, clipped to the axis.

    `step` may be negative (north-to-south latitudes); halves round to even. NULL
    and NaN have no index; however far a value lies off, it is clipped.
    """
    if not step or math.isnan(step):
        raise ValueError("grid step must be non-zero")
    number = _col(value).cast("double")
    raw = F.rint((number - F.lit(float(origin))) / F.lit(float(step)))
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(float(size - 1)), raw)).cast("int")
    return F.when(number.isNotNull() & ~F.isnan(number), clipped)
