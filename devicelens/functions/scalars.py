"""Scalar column functions. All are built-in expressions and stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# -- repeatable pseudo-random values ------------------------------------------------------


def hash_int(key: Column, salt: str = "") -> Column:
    """Integer in [0, 2^32) from the MD5 of the key: the same in every engine and partitioning."""
    text = F.concat(key.cast("string"), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def unit_hash(key: Column, salt: str = "") -> Column:
    """Fraction in [0, 1), see :func:`hash_int`."""
    return hash_int(key, salt) / F.lit(4294967296.0)


def hash_bucket(key: Column, n: int, salt: str = "") -> Column:
    return (hash_int(key, salt) % n).cast("int")


def nth_of(values: Sequence[str], index: Column) -> Column:
    """Entry of a short fixed list, counted from 0."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def hash_category(key: Column, values: Sequence[str], salt: str = "") -> Column:
    """Give each key one entry of a fixed list."""
    return nth_of(values, hash_bucket(key, len(values), salt))


# -- time ---------------------------------------------------------------------------------


def start_of(unit: str, ts: Column) -> Column:
    """Start of the day, week, month … of a timestamp."""
    return F.date_trunc(unit, ts)


def add_time(ts: Column, hours: Column | int = 0, seconds: Column | int = 0) -> Column:
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)

    return ts + F.make_dt_interval(F.lit(0), lit(hours), F.lit(0), lit(seconds).cast("decimal(18,6)"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", start, end)


def micros(ts: Column) -> Column:
    """Microseconds since 1970, for timestamps with and without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def parse_time(text: Column, pattern: str | None = None) -> Column:
    """Timestamp of a text, null where it does not parse."""
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


# -- numbers ------------------------------------------------------------------------------


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def ratio(x: Column, y: Column) -> Column:
    """x / y, null where y is 0 or null."""
    return x / F.nullif(y, F.lit(0))


def half_even(x: Column, digits: int = 0) -> Column:
    """Round half to even, as Python's ``round`` does."""
    return F.bround(x, digits)


def wave(time: Column, frequency: float, amplitude: float) -> Column:
    return F.sin(2 * F.pi() * frequency * time) * amplitude


def pressure_from_temperature(temperature: Column, base: float, rate: float, reference: float = 15.0) -> Column:
    """Air pressure that falls by ``rate`` per degree above the reference temperature."""
    return F.lit(base) - (temperature - reference) * rate


def deviation(x: Column, smoothed: Column) -> Column:
    """Actual minus smoothed: positive where the value is above its recent mean (used in labelling)."""
    return x - smoothed


def smoothed_gap(x: Column, smoothed: Column) -> Column:
    """Smoothed minus actual, the sign used in the feature tables."""
    return smoothed - x


# -- choice -------------------------------------------------------------------------------


def rule_case(rules: Sequence[Column], outcomes: Sequence[float | int] | None = None, default: float | int = 0) -> Column:
    """Outcome of the first rule that holds, else the default. Outcomes are 1 when not given."""
    outcomes = [1] * len(rules) if outcomes is None else list(outcomes)
    if len(outcomes) != len(rules):
        raise ValueError("one outcome per rule is needed")
    choice = F.when(rules[0], F.lit(outcomes[0]))
    for rule, outcome in zip(rules[1:], outcomes[1:]):
        choice = choice.when(rule, F.lit(outcome))
    return choice.otherwise(F.lit(default))


def dot(values: Column, weights: Column) -> Column:
    """Inner product of two double arrays."""
    products = F.zip_with(values, weights, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


# -- text ---------------------------------------------------------------------------------


def user_slug(user: Column) -> Column:
    """Part of an e-mail address before the @, with dots as underscores."""
    return F.replace(F.element_at(F.split(user, "@"), 1), F.lit("."), F.lit("_"))


def prefixed(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value)
