"""Conditional functions: lazy, and with NULL rules of their own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def coalesce(*xs) -> Column:
    return F.coalesce(*map(_c, xs))


def nullif(a, b) -> Column:
    return F.nullif(_c(a), _c(b))


def greatest(*xs) -> Column:
    """GREATEST: NULLs are ignored; one argument is allowed."""
    return F.greatest(*map(_c, xs)) if len(xs) > 1 else _c(xs[0])


def least(*xs) -> Column:
    return F.least(*map(_c, xs)) if len(xs) > 1 else _c(xs[0])


def iif(condition: Column, a, b) -> Column:
    return F.when(condition, _c(a)).otherwise(_c(b))


def try_cast(x, kind: str) -> Column:
    """TRY_CAST / SAFE_CAST: NULL if the value can't be converted."""
    return _c(x).try_cast(kind)


def cast_default(x, kind: str, default) -> Column:
    """CAST(x AS kind DEFAULT default ON CONVERSION ERROR): NULL stays NULL."""
    x = _c(x)
    return F.when(x.isNotNull(), F.coalesce(x.try_cast(kind), _c(default).cast(kind)))
