"""Intervals as columns: struct<months int, days int, micros bigint>. Spark's calendar intervals can't be compared or stored, these can."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.datetime import NTZ, from_micros, micros

TYPE = "struct<months:int,days:int,micros:bigint>"
DAY = 86_400_000_000


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def make(months=0, days=0, micros_=0) -> Column:
    return F.struct(_c(months).cast("int").alias("months"), _c(days).cast("int").alias("days"), _c(micros_).cast("bigint").alias("micros"))


#: Months, days and microseconds of one unit.
_UNITS = {
    "year": (12, 0, 0), "quarter": (3, 0, 0), "month": (1, 0, 0), "week": (0, 7, 0), "day": (0, 1, 0), "hour": (0, 0, 3_600_000_000),
    "minute": (0, 0, 60_000_000), "second": (0, 0, 1_000_000), "millisecond": (0, 0, 1000), "microsecond": (0, 0, 1),
}


def of(n, unit: str) -> Column:
    """INTERVAL n unit."""
    m, d, u = _UNITS[unit.lower().rstrip("s")]
    n = _c(n).cast("bigint")
    return make(n * m, n * d, n * F.lit(u))


def total(iv: Column) -> Column:
    """What intervals are compared by: a month counts 30 days, a day 24 hours."""
    return (iv["months"].cast("decimal(38,0)") * 30 + iv["days"]) * F.lit(DAY) + iv["micros"]


def add(a: Column, b: Column) -> Column:
    return make(a["months"] + b["months"], a["days"] + b["days"], a["micros"] + b["micros"])


def negate(a: Column) -> Column:
    return make(-a["months"], -a["days"], -a["micros"])


def scale(a: Column, k) -> Column:
    """Whole multiples, and fractions that go down to smaller units (30 days a month)."""
    k = _c(k).cast("double")
    months = a["months"] * k
    days = a["days"] * k + (months - F.signum(months) * F.floor(F.abs(months))) * 30
    us = a["micros"] * k + (days - F.signum(days) * F.floor(F.abs(days))) * F.lit(float(DAY))
    whole = lambda x: F.signum(x) * F.floor(F.abs(x))
    return make(whole(months), whole(days), F.round(us))


def plus(ts, iv: Column) -> Column:
    """TIMESTAMP + interval: months first (clamped to the month's last day), then days, then time. A TIMESTAMP also from a DATE."""
    ts = _c(ts).cast(NTZ)
    moved = F.timestamp_add("DAY", iv["days"], F.timestamp_add("MONTH", iv["months"], ts))
    return from_micros(micros(moved) + iv["micros"])


def minus(ts, iv: Column) -> Column:
    return plus(ts, negate(iv))


def between(a, b) -> Column:
    """TIMESTAMP a - TIMESTAMP b: days and time, no months."""
    d = micros(a) - micros(b)
    days = F.signum(d.cast("double")).cast("bigint") * F.floor(F.abs(d) / F.lit(DAY))
    return make(0, days, d - days * F.lit(DAY))


def age(a, b) -> Column:
    """AGE(a, b): years and months by the calendar, then the days and time that are left."""
    a, b = _c(a).cast(NTZ), _c(b).cast(NTZ)
    late, early = F.greatest(a, b), F.least(a, b)
    raw = (F.year(late) - F.year(early)) * 12 + F.month(late) - F.month(early)
    # the day and time of day decide whether the last month is whole; the rest counts on from the day in the early month
    us = lambda t: micros(t) - micros(F.date_trunc("day", t).cast(NTZ))
    time = us(late) - us(early)
    borrow_day = F.when(time < 0, 1).otherwise(0)
    days = F.dayofmonth(late) - F.dayofmonth(early) - borrow_day
    borrow_month = F.when(days < 0, 1).otherwise(0)
    days = days + F.when(days < 0, F.dayofmonth(F.last_day(early))).otherwise(0)
    sign = F.when(a < b, -1).otherwise(1)
    return make((raw - borrow_month) * sign, days * sign, (time + borrow_day * F.lit(DAY)) * sign)


def format_interval(iv: Column) -> Column:
    """The text of an interval: ``1 year 2 mons 3 days 04:05:06``."""
    years, months = F.call_function("div", iv["months"], F.lit(12)), iv["months"] % 12

    def part(n: Column, one: str, many: str) -> Column:
        return F.when(n != 0, F.concat(n.cast("string"), F.when(n == 1, F.lit(f" {one}")).otherwise(F.lit(f" {many}"))))

    us = F.abs(iv["micros"])
    hours = F.call_function("div", us, F.lit(3_600_000_000))
    clock = F.concat(
        F.when(iv["micros"] < 0, F.lit("-")).otherwise(F.lit("")),
        F.when(hours < 10, F.lpad(hours.cast("string"), 2, "0")).otherwise(hours.cast("string")),
        F.lit(":"),
        F.lpad((F.call_function("div", us, F.lit(60_000_000)) % 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((F.call_function("div", us, F.lit(1_000_000)) % 60).cast("string"), 2, "0"),
        F.when(us % 1_000_000 != 0, F.concat(F.lit("."), F.rtrim(F.lpad((us % 1_000_000).cast("string"), 6, "0"), F.lit("0")))).otherwise(F.lit("")),
    )
    empty = (iv["months"] == 0) & (iv["days"] == 0)
    return F.concat_ws(" ", part(years, "year", "years"), part(months, "mon", "mons"), part(iv["days"], "day", "days"), F.when((iv["micros"] != 0) | empty, clock))
