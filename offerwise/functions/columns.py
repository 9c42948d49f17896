from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; 0 unless the denominator is above 0."""
    return F.when(
        denominator > 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))


def flag_like(text: Column, pattern: str) -> Column:
    """1 where `text` matches the LIKE pattern, else 0 (also for NULL)."""
    return F.when(text.like(pattern), 1).otherwise(0)


def month_of(date: Column) -> Column:
    # trunc keeps a DATE; date_trunc would go through the session time zone.
    return F.trunc(date, "month")


def to_number(text: Column) -> Column:
    """Text as double, NULL where it is not a number."""
    return text.try_cast("double")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def is_close(a: Column, b: Column | float, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Equality within atol + rtol * |b|."""
    other = b if isinstance(b, Column) else F.lit(float(b))
    return F.abs(a - other) <= F.lit(atol) + F.lit(rtol) * F.abs(other)


def percent_label(share: Column) -> Column:
    """0.25 -> '25%'. Rounds, so 0.2499999 is not shown as 24%."""
    return F.concat(F.round(share * 100).cast("int").cast("string"), F.lit("%"))


def number(value: float) -> str:
    """A Python number as a double literal in SQL text."""
    return f"{float(value)!r}D"


def softmax(margins: Sequence[str]) -> list[str]:
    """Class probabilities of SQL margins.

    Written as 1 / (1 + sum of exp(other - own)), which cannot turn into NaN
    when exp overflows and compiles to less code than subtracting the greatest.
    """
    shares = []
    for own in margins:
        odds = [f"exp({other} - {own})" for other in margins if other != own]
        shares.append(f"1D / (1D + {' + '.join(odds)})")
    return shares


def discount_grid(top_percent: int = 30, step_percent: int = 5) -> list[float]:
    """Discounts 0, step, ..., top as fractions; the list index is the scenario id."""
    return [p / 100.0 for p in range(0, top_percent + 1, step_percent)]


def even_grid(low: float, high: float, points: int) -> list[float]:
    """`points` evenly spaced values from low to high, free of summing drift."""
    step = (high - low) / (points - 1)
    return [round(low + k * step, 12) for k in range(points)]


def hash_bucket(key: Column, seed: int = 42, buckets: int = 10_000) -> Column:
    """Bucket of a row that depends on its key only, not on how data is laid out."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets))


def keyed_digest(key: Column, seed: int | str = 42) -> Column:
    """A digest of a key and a seed, the same in every SQL engine: hex digits, evenly spread."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))).cast("binary"))


def arithmetic_bucket(key: Column, seed: int = 42, buckets: int = 10_000) -> Column:
    """Like `hash_bucket` for a non-negative integer key, in arithmetic any SQL engine has."""
    return (key.cast("bigint") % 1000003 * 7919 + seed) % buckets
