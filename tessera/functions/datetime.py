"""Date and time functions. Intervals as columns are structs (months, days, micros), see ``interval``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def micros(ts) -> Column:
    """Microseconds since 1970 of a TIMESTAMP, as if in UTC (whatever the session's zone)."""
    ts = _c(ts).cast(NTZ)
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = F.hour(ts).cast("bigint") * 3600 + F.minute(ts) * 60
    return day * F.lit(86_400_000_000) + seconds * 1_000_000 + F.round(F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def from_micros(us) -> Column:
    """The TIMESTAMP of microseconds since 1970."""
    us = _c(us).cast("bigint")
    days = F.call_function("div", us - F.pmod(us, F.lit(86_400_000_000)), F.lit(86_400_000_000)).cast("int")
    rest = F.pmod(us, F.lit(86_400_000_000))
    start = F.date_add(F.lit("1970-01-01").cast("date"), days).cast(NTZ)
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (rest / F.lit(1_000_000)).cast("decimal(18,6)"))


def date_part(field: str, x) -> Column:
    """DATE_PART / EXTRACT. dow counts from Sunday 0, isodow from Monday 1; second and epoch have fractions (DOUBLE), the others are BIGINT."""
    x, f = _c(x), field.lower()
    year = F.year(x)
    ts = x.cast(NTZ)
    second = F.extract(F.lit("SECOND"), ts)
    native = {
        "year": year, "quarter": F.quarter(x), "month": F.month(x), "week": F.weekofyear(x), "day": F.dayofmonth(x), "doy": F.dayofyear(x),
        "hour": F.hour(ts), "minute": F.minute(ts), "dow": F.dayofweek(x) - 1, "isodow": F.weekday(x) + 1, "isoyear": F.extract(F.lit("YEAROFWEEK"), x),
        "decade": F.floor(year / 10), "century": F.ceil(year / 100), "millennium": F.ceil(year / 1000),
        "milliseconds": F.floor(second * 1000), "microseconds": F.floor(second * 1_000_000),
    }
    if f == "second":
        return second.cast("double")
    if f == "epoch":
        return micros(ts) / F.lit(1e6)
    return native[f].cast("bigint")


def date_trunc(unit: str, x, kind: str = NTZ) -> Column:
    """DATE_TRUNC in the argument's type: a DATE stays a DATE."""
    return F.date_trunc(unit, _c(x)).cast(kind)


def date_bin(stride_micros: int, source, origin) -> Column:
    """The start of the stride that holds ``source``, counted from ``origin``, also before it."""
    o = micros(origin)
    return from_micros(o + (micros(source) - o) - F.pmod(micros(source) - o, F.lit(stride_micros)))


#: Parts that keep a DATE a DATE.
_DAY_PARTS = {"day": "DAY", "week": "WEEK", "month": "MONTH", "quarter": "QUARTER", "year": "YEAR"}


def dateadd(part: str, n, x, kind: str = NTZ) -> Column:
    """DATEADD: months clamp to their last day; a DATE stays a DATE for parts of a day or more."""
    return F.timestamp_add(part.upper(), _c(n), _c(x)).cast(kind)


def date_sub(part: str, n, x, kind: str = NTZ) -> Column:
    return dateadd(part, -_c(n), x, kind)


def _index(part: str, x: Column) -> Column:
    """The number of boundaries of a part before x."""
    if part in ("year", "quarter", "month"):
        month = F.year(x).cast("bigint") * 12 + F.month(x) - 1
        return F.floor(month / {"year": 12, "quarter": 3, "month": 1}[part])
    if part in ("day", "week"):
        day = F.datediff(x.cast("date"), F.lit("1970-01-05").cast("date"))  # a Monday
        return F.floor(day / (7 if part == "week" else 1))
    size = {"hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000, "millisecond": 1000, "microsecond": 1}[part]
    m = micros(x)
    return F.call_function("div", m - F.pmod(m, F.lit(size)), F.lit(size))


def datediff(part: str, a, b) -> Column:
    """DATEDIFF counts the boundaries crossed from a to b: one month from Jan 31 to Feb 1."""
    return (_index(part, _c(b)) - _index(part, _c(a))).cast("bigint")


def make_date(y, m, d) -> Column:
    return F.make_date(_c(y), _c(m), _c(d))


def make_timestamp(y, mo, d, h, mi, s) -> Column:
    return F.make_timestamp_ntz(_c(y), _c(mo), _c(d), _c(h), _c(mi), _c(s).cast("decimal(18,6)"))


def make_timestamptz(y, mo, d, h, mi, s, zone: str | None = None) -> Column:
    args = [_c(y), _c(mo), _c(d), _c(h), _c(mi), _c(s).cast("decimal(18,6)")]
    return F.make_timestamp_ltz(*args, F.lit(zone)) if zone else F.make_timestamp_ltz(*args)


def make_time(h, m, s) -> Column:
    """MAKE_TIME as TIME (the session needs spark.sql.timeType.enabled)."""
    return F.make_time(_c(h), _c(m), _c(s).cast("decimal(8,6)"))


def epoch(x) -> Column:
    return micros(x) / F.lit(1e6)


def epoch_ms(x) -> Column:
    m = micros(x)
    return F.call_function("div", m - F.pmod(m, F.lit(1000)), F.lit(1000))


def last_day(d) -> Column:
    return F.last_day(_c(d))


def to_timestamp_epoch(seconds) -> Column:
    """TO_TIMESTAMP(seconds): an instant."""
    return F.timestamp_seconds(_c(seconds))


#: Template patterns and their Java equivalents, for parsing. Fixed values of the Postgres template language.
_PARSE = {
    "YYYY": "yyyy", "YY": "yy", "MM": "MM", "MONTH": "MMMM", "MON": "MMM", "DDD": "DDD", "DD": "dd", "HH24": "HH", "HH12": "hh", "HH": "hh",
    "MI": "mm", "SS": "ss", "MS": "SSS", "US": "SSSSSS", "AM": "a", "PM": "a", "DAY": "EEEE", "DY": "EEE", "TZ": "z", "OF": "XXX",
}
_PARSE_TOKEN = re.compile("|".join(sorted(_PARSE, key=len, reverse=True)), re.I)


def parse_template(template: str) -> str:
    """A Postgres template for parsing, as a Java pattern."""
    out, last = [], 0
    plain = template.replace("FM", "").replace("fm", "")
    for m in _PARSE_TOKEN.finditer(plain):
        out += [re.sub(r"([A-Za-z]+)", r"'\1'", plain[last : m.start()]), _PARSE[m[0].upper()]]
        last = m.end()
    return "".join([*out, re.sub(r"([A-Za-z]+)", r"'\1'", plain[last:])])


def to_timestamp(text, template: str) -> Column:
    """TO_TIMESTAMP(text, template), as a naive TIMESTAMP."""
    return F.to_timestamp_ntz(_c(text), F.lit(parse_template(template)))


def to_date(text, template: str) -> Column:
    return F.to_date(_c(text), parse_template(template))


_CHAR_TOKEN = re.compile(
    r'"(?P<quoted>[^"]*)"|(?P<fm>FM)?(?P<p>Y,YYY|YYYY|YYY|YY|Y|IYYY|IDDD|IW|ID|HH24|HH12|HH|MI|SSSSS|SSSS|SS|MS|US|A\.M\.|P\.M\.|AM|PM|MONTH|Month|month|MON|Mon|mon|MM|DAY|Day|day|DY|Dy|dy|DDD|DD|D|WW|W|CC|J|Q|RM|a\.m\.|p\.m\.|am|pm)(?P<th>TH|th)?'
)


def _number(value: Column, width: int, fill: bool) -> Column:
    text = value.cast("int").cast("string")
    return F.lpad(text, width, "0") if not fill else text


def to_char(x, template: str) -> Column:
    """TO_CHAR of a date or timestamp: one built-in expression for each pattern, joined. FM drops padding, TH adds an ordinal's ending."""
    x = _c(x).cast(NTZ)
    second = F.extract(F.lit("SECOND"), x)
    hour12 = F.pmod(F.hour(x) + 11, F.lit(12)) + 1
    half = F.when(F.hour(x) < 12, F.lit("AM")).otherwise(F.lit("PM"))
    dotted = F.when(F.hour(x) < 12, F.lit("A.M.")).otherwise(F.lit("P.M."))
    isoyear = F.extract(F.lit("YEAROFWEEK"), x)
    names = {"MONTH": ("MMMM", 9), "MON": ("MMM", 0), "DAY": ("EEEE", 9), "DY": ("EEE", 0)}
    roman = F.array(*map(F.lit, "I II III IV V VI VII VIII IX X XI XII".split()))
    numbers = {
        "YYYY": (F.year(x), 4), "YYY": (F.year(x) % 1000, 3), "YY": (F.year(x) % 100, 2), "Y": (F.year(x) % 10, 1), "IYYY": (isoyear, 4), "IW": (F.weekofyear(x), 2), "ID": (F.weekday(x) + 1, 1),
        "IDDD": ((F.weekofyear(x) - 1) * 7 + F.weekday(x) + 1, 3), "HH24": (F.hour(x), 2), "HH12": (hour12, 2), "HH": (hour12, 2), "MI": (F.minute(x), 2), "SS": (F.second(x), 2), "MS": (F.floor((second % 1) * 1000), 3),
        "US": (F.floor((second % 1) * 1_000_000), 6), "SSSS": (F.hour(x) * 3600 + F.minute(x) * 60 + F.second(x), 1), "SSSSS": (F.hour(x) * 3600 + F.minute(x) * 60 + F.second(x), 1), "MM": (F.month(x), 2), "DDD": (F.dayofyear(x), 3), "DD": (F.dayofmonth(x), 2),
        "D": (F.dayofweek(x), 1), "WW": (F.floor((F.dayofyear(x) - 1) / 7) + 1, 2), "W": (F.floor((F.dayofmonth(x) - 1) / 7) + 1, 1), "CC": (F.ceil(F.year(x) / 100), 2), "Q": (F.quarter(x), 1),
        "J": (F.datediff(x.cast("date"), F.lit("1970-01-01").cast("date")) + 2440588, 1),
    }
    parts, last = [], 0
    for m in _CHAR_TOKEN.finditer(template):
        if m.start() > last:
            parts.append(F.lit(template[last : m.start()]))
        last = m.end()
        if m["quoted"] is not None:
            parts.append(F.lit(m["quoted"]))
            continue
        p, fm = m["p"], bool(m["fm"])
        if p.upper() in names:
            java, width = names[p.upper()]
            name = F.date_format(x, java)
            name = F.upper(name) if p.isupper() else F.lower(name) if p.islower() else name
            parts.append(F.rpad(name, width, " ") if width and not fm else name)
        elif p in ("AM", "PM"):
            parts.append(half)
        elif p in ("am", "pm"):
            parts.append(F.lower(half))
        elif p in ("A.M.", "P.M."):
            parts.append(dotted)
        elif p in ("a.m.", "p.m."):
            parts.append(F.lower(dotted))
        elif p == "RM":
            r = F.element_at(roman, F.month(x))
            parts.append(r if fm else F.rpad(r, 4, " "))
        elif p == "Y,YYY":
            parts.append(F.concat(F.floor(F.year(x) / 1000).cast("string"), F.lit(","), F.lpad((F.year(x) % 1000).cast("string"), 3, "0")))
        else:
            value, width = numbers[p]
            text = _number(value, width, fm)
            if m["th"]:
                n = value.cast("int")
                teen = (n % 100).between(11, 13)
                end = F.when(teen, F.lit("th")).when(n % 10 == 1, F.lit("st")).when(n % 10 == 2, F.lit("nd")).when(n % 10 == 3, F.lit("rd")).otherwise(F.lit("th"))
                text = F.concat(text, F.upper(end) if m["th"] == "TH" else end)
            parts.append(text)
    if last < len(template):
        parts.append(F.lit(template[last:]))
    return F.concat(*parts) if parts else F.when(x.isNotNull(), F.lit(""))


#: Abbreviations of fixed offsets, which come before names of zones. Fixed values of the dialect.
_ABBREVIATIONS = {
    "utc": "+00:00", "ut": "+00:00", "uct": "+00:00", "gmt": "+00:00", "z": "+00:00", "zulu": "+00:00", "est": "-05:00", "edt": "-04:00", "cst": "-06:00", "cdt": "-05:00", "mst": "-07:00", "mdt": "-06:00", "pst": "-08:00", "pdt": "-07:00",
    "akst": "-09:00", "akdt": "-08:00", "hst": "-10:00", "ast": "-04:00", "adt": "-03:00", "nst": "-03:30", "ndt": "-02:30", "wet": "+00:00", "west": "+01:00", "bst": "+01:00", "cet": "+01:00", "cest": "+02:00", "eet": "+02:00", "eest": "+03:00",
    "jst": "+09:00", "kst": "+09:00", "hkt": "+08:00", "awst": "+08:00", "acst": "+09:30", "acdt": "+10:30", "aest": "+10:00", "aedt": "+11:00", "nzst": "+12:00", "nzdt": "+13:00",
}
_POSIX = re.compile(r"(?:[A-Za-z]{3,}|<[A-Za-z0-9+-]+>)?([+-]?)([0-9]{1,2})(?::([0-9]{2}))?")


def zone(name: str) -> str:
    """A zone's name for Spark: an abbreviation or a POSIX zone without summer time (whose sign counts to the west) as its offset."""
    if fixed := _ABBREVIATIONS.get(name.strip().lower()):
        return fixed
    if (m := _POSIX.fullmatch(name.strip())) and not name.strip()[0] in "+-":
        return f"{'+' if m[1] == '-' else '-'}{int(m[2]):02d}:{m[3] or '00'}"
    return name.strip()


def _zone(z) -> Column:
    return F.lit(zone(z)) if isinstance(z, str) else z


def utc_of_local(x, z) -> Column:
    """The UTC wall time of a local time there. In a gap the offset before it counts, in an overlap that after it."""
    x, z, utc = _c(x).cast(NTZ), _zone(z), F.lit("UTC")
    first = F.convert_timezone(z, utc, x)
    later = [first + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m)) for m in (60, 30)]
    return F.when(F.convert_timezone(utc, z, later[0]) == x, later[0]).when(F.convert_timezone(utc, z, later[1]) == x, later[1]).otherwise(first)


def at_time_zone(x, z, instant: bool) -> Column:
    """``x AT TIME ZONE z``: an instant's local time there (instant=True), or the instant of a local time (False), as UTC wall time."""
    return F.convert_timezone(F.lit("UTC"), _zone(z), _c(x).cast(NTZ)) if instant else utc_of_local(x, z)


def instant_at(x, z) -> Column:
    """An instant's local time in a zone, whatever the session's zone."""
    return F.convert_timezone(F.lit("UTC"), _zone(z), from_micros(F.unix_micros(x)))


def instant_of(x, z) -> Column:
    """The instant of a local time in a zone, whatever the session's zone."""
    return F.timestamp_micros(micros(utc_of_local(x, z)))


def convert_timezone(target, x, source="UTC") -> Column:
    """CONVERT_TIMEZONE: a wall time of one zone as that of another."""
    return F.convert_timezone(F.lit("UTC"), _zone(target), utc_of_local(x, source))


def rounded_now(p: int = 6) -> Column:
    """CURRENT_TIMESTAMP(p): fixed for a statement, rounded to p digits."""
    now = F.current_timestamp()
    if p >= 6:
        return now
    return F.timestamp_micros(F.round(F.unix_micros(now), p - 6).cast("bigint"))


def current_date() -> Column:
    return F.current_date()


def rounded_local(p: int = 6) -> Column:
    """LOCALTIMESTAMP(p)."""
    return F.localtimestamp() if p >= 6 else from_micros(F.round(micros(F.localtimestamp()), p - 6).cast("bigint"))


def localtimestamp() -> Column:
    return F.localtimestamp()


def current_time(p: int = 6) -> Column:
    return F.current_time(p)
