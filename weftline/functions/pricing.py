"""Prices as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.rounding import rounded

#: Other decimal digits that a price may be written in, and what they stand for.
DIGITS_FROM, DIGITS_TO = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789"
#: A relative price gap of at most ... adds ... to a score.
BONUSES = ((0.0, 6.0), (0.02, 5.0), (0.05, 4.0), (0.10, 2.0))


def parsed_price(value: Column) -> Column:
    """A positive double, or null. All but digits and dots is dropped, a minus sign too."""
    text = F.translate(value.cast("string"), DIGITS_FROM, DIGITS_TO)
    price = F.regexp_replace(text, r"[^0-9.]", "").try_cast("double")
    return F.when(price > 0, price)


def price_gap(a: Column, b: Column) -> Column:
    """|a - b| over the larger; null unless both are known."""
    return F.abs(a - b) / F.greatest(a, b)


def price_bonus(a: Column, b: Column) -> Column:
    gap = price_gap(a, b)
    out = F.lit(None).cast("double")
    for most, bonus in reversed(BONUSES):
        out = F.when(gap <= most, bonus).otherwise(out)
    return F.when(a.isNull() | b.isNull(), 0.0).otherwise(F.coalesce(out, F.lit(0.0)))


def _two_decimals(price: Column) -> Column:
    return F.regexp_replace(F.format_string("%.2f", price), "0+$", "")


def formatted_price(value: Column) -> Column:
    """Whole prices without decimals, others with two at most, '-' for none."""
    price = parsed_price(value)
    return F.when(price.isNull(), "-").when(price == F.floor(price), F.floor(price).cast("string")).otherwise(_two_decimals(price))


def price_delta_text(a: Column, b: Column) -> Column:
    gap = price_gap(parsed_price(a), parsed_price(b))
    return F.when(gap.isNull(), "-").otherwise(F.format_string("%.1f%%", rounded(gap * 100)))


def price_context(a: Column, b: Column) -> Column:
    return F.concat(F.lit("inventory="), formatted_price(a), F.lit(", candidate="), formatted_price(b), F.lit(", delta="), price_delta_text(a, b))
