"""Mathematical functions. Where Spark returns NULL or NaN for an argument outside the domain, these raise an error.

All are built-in Spark expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _guard(bad: Column, message: str, good: Column) -> Column:
    return F.when(bad, F.raise_error(F.lit(message)).cast("double")).otherwise(good)


def round_half_away(x, n: int = 0) -> Column:
    """ROUND: half away from zero; a negative n rounds before the point."""
    return F.round(_c(x), n)


def trunc(x, n: int = 0) -> Column:
    """TRUNC of a number toward zero, at n digits after (or, negative, before) the point; DOUBLE."""
    x, scale = _c(x).cast("double"), 10.0**n
    return F.when(x.isNull(), None).otherwise(F.signum(x) * F.floor(F.abs(x) * F.lit(scale)) / F.lit(scale))


def trunc_decimal(x, n: int = 0) -> Column:
    """TRUNC of a NUMERIC, exact."""
    x = _c(x)
    return F.when(x >= 0, F.floor(x, F.lit(n))).otherwise(F.ceil(x, F.lit(n)))


def floor(x, kind: str = "double") -> Column:
    """FLOOR in the argument's type (Spark gives BIGINT)."""
    return F.floor(_c(x)).cast(kind)


def ceil(x, kind: str = "double") -> Column:
    return F.ceil(_c(x)).cast(kind)


def mod(a, b) -> Column:
    """MOD: the sign of the dividend; an error on 0 (ANSI)."""
    return _c(a) % _c(b)


def power(x, y) -> Column:
    x, y = _c(x).cast("double"), _c(y).cast("double")
    return _guard((x == 0) & (y < 0), "zero raised to a negative power", F.pow(x, y))


def sqrt(x) -> Column:
    x = _c(x).cast("double")
    return _guard(x < 0, "square root of a negative number", F.sqrt(x))


def ln(x) -> Column:
    x = _c(x).cast("double")
    return _guard(x <= 0, "logarithm of a number that is not positive", F.ln(x))


def log(x, base=None) -> Column:
    """LOG(x) is base 10, LOG(b, x) base b."""
    x = _c(x).cast("double")
    if base is None:
        return _guard(x <= 0, "logarithm of a number that is not positive", F.log10(x))
    b = _c(base).cast("double")
    return _guard((x <= 0) | (b <= 0) | (b == 1), "logarithm is not defined", F.ln(x) / F.ln(b))


def exp(x) -> Column:
    x = _c(x).cast("double")
    y = F.exp(x)
    return _guard((y == float("inf")) & (x != float("inf")), "value out of range: overflow", y)


def cbrt(x) -> Column:
    return F.cbrt(_c(x).cast("double"))


def sign(x, kind: str = "double") -> Column:
    return F.signum(_c(x).cast("double")).cast(kind)


def random() -> Column:
    """RANDOM(): volatile, per row."""
    return F.rand()


def asin(x) -> Column:
    x = _c(x).cast("double")
    return _guard(F.abs(x) > 1, "input is out of range", F.asin(x))


def acos(x) -> Column:
    x = _c(x).cast("double")
    return _guard(F.abs(x) > 1, "input is out of range", F.acos(x))


def _reduced(deg) -> Column:
    """Degrees in [0, 360)."""
    return F.pmod(_c(deg).cast("double"), F.lit(360.0))


def _exact(value: Column, points: dict[float, float], otherwise: Column) -> Column:
    out = otherwise
    for at, y in points.items():
        out = F.when(value == at, F.lit(float(y))).otherwise(out)
    return out


#: Sines at multiples of 30 degrees. Fixed values.
_SINES = {0: 0.0, 30: 0.5, 90: 1.0, 150: 0.5, 180: 0.0, 210: -0.5, 270: -1.0, 330: -0.5}


def sind(deg) -> Column:
    r = _reduced(deg)
    return _exact(r, _SINES, F.sin(F.radians(r)))


def cosd(deg) -> Column:
    return sind(_c(deg).cast("double") + 90.0)


def tand(deg) -> Column:
    r = F.pmod(_c(deg).cast("double"), F.lit(180.0))
    return _exact(r, {0: 0.0, 45: 1.0, 90: float("inf"), 135: -1.0}, F.tan(F.radians(r)))


def cotd(deg) -> Column:
    r = F.pmod(_c(deg).cast("double"), F.lit(180.0))
    return _exact(r, {0: float("inf"), 45: 1.0, 90: 0.0, 135: -1.0}, F.cot(F.radians(r)))


def asind(x) -> Column:
    return _exact(_c(x).cast("double"), {-1: -90, -0.5: -30, 0: 0, 0.5: 30, 1: 90}, F.degrees(asin(x)))


def acosd(x) -> Column:
    return _exact(_c(x).cast("double"), {-1: 180, -0.5: 120, 0: 90, 0.5: 60, 1: 0}, F.degrees(acos(x)))


def atand(x) -> Column:
    return _exact(_c(x).cast("double"), {-1: -45, 0: 0, 1: 45}, F.degrees(F.atan(_c(x))))


def atan2d(y, x) -> Column:
    y, x = _c(y).cast("double"), _c(x).cast("double")
    out = F.degrees(F.atan2(y, x))
    for at, a, b in ((45.0, 1, 1), (135.0, 1, -1), (-45.0, -1, 1), (-135.0, -1, -1)):
        out = F.when((F.abs(x) == F.abs(y)) & (y * a > 0) & (x * b > 0), F.lit(at)).otherwise(out)
    return out


def int_divide(a, b) -> Column:
    """Integer ``/``: the quotient cut toward zero, BIGINT; an error on 0."""
    a, b = _c(a).cast("bigint"), _c(b).cast("bigint")
    return F.call_function("div", a, b)
