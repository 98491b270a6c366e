"""String functions: characters count from 1, lengths are BIGINT, and NULL is skipped only by CONCAT and CONCAT_WS."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def substring(s, start, length=None) -> Column:
    """SUBSTRING(s FROM start [FOR length]): places before the first character count, and are empty."""
    s, start = _c(s), _c(start).cast("int")
    begin = F.greatest(start, F.lit(1))
    if length is None:
        return F.substr(s, begin)
    length = _c(length).cast("int")
    size = F.greatest(start + length - begin, F.lit(0))
    return F.when(length < 0, F.raise_error(F.lit("negative substring length not allowed")).cast("string")).otherwise(F.substr(s, begin, size))


def left(s, n) -> Column:
    """LEFT: a negative n drops characters from the right."""
    s, n = _c(s), _c(n)
    return F.substr(s, F.lit(1), F.when(n < 0, F.greatest(F.length(s) + n, F.lit(0))).otherwise(n))


def right(s, n) -> Column:
    """RIGHT: a negative n drops characters from the left."""
    s, n = _c(s), _c(n)
    size = F.when(n < 0, F.greatest(F.length(s) + n, F.lit(0))).otherwise(F.least(n, F.length(s)))
    return F.substr(s, F.length(s) - size + 1, size)


def length(s, padded: bool = False) -> Column:
    """LENGTH in characters; a CHAR(n) value's padding doesn't count."""
    return F.length(F.rtrim(_c(s)) if padded else _c(s)).cast("bigint")


def initcap(s) -> Column:
    """INITCAP: words end at any character that is neither letter nor digit."""
    words = F.regexp_extract_all(_c(s), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.lower(F.substr(w, F.lit(2))))), "")


def concat(*parts) -> Column:
    """CONCAT: NULLs are skipped."""
    return F.concat_ws("", *(_c(p).cast("string") for p in parts))


def concat_ws(sep: str, *parts) -> Column:
    return F.concat_ws(sep, *(_c(p).cast("string") for p in parts))


def position(sub, s) -> Column:
    """POSITION(sub IN s): 0 if absent."""
    return F.instr(_c(s), _c(sub)).cast("bigint")


def split_part(s, delimiter: str, n: int) -> Column:
    """SPLIT_PART: a negative n counts from the end."""
    if n == 0:
        raise ValueError("field position must not be zero")
    return F.split_part(_c(s), F.lit(delimiter), F.lit(n))


def like(s: Column, pattern: str, escape: str | None = None) -> Column:
    """LIKE without an escape character unless one is given."""
    if escape is None:
        pattern, escape = pattern.replace("\\", "\\\\"), "\\"
    return F.like(s, F.lit(pattern), F.lit(escape))


def ilike(s: Column, pattern: str, escape: str | None = None) -> Column:
    if escape is None:
        pattern, escape = pattern.replace("\\", "\\\\"), "\\"
    return F.ilike(s, F.lit(pattern), F.lit(escape))


def to_hex(b) -> Column:
    return F.lower(F.hex(_c(b)))


def from_hex(s) -> Column:
    return F.unhex(_c(s))


def fit_varchar(s, n: int) -> Column:
    """CAST AS VARCHAR(n): cut to n characters."""
    return F.substr(_c(s).cast("string"), F.lit(1), F.lit(n))


def pad_char(s, n: int) -> Column:
    """CAST AS CHAR(n): cut or padded with blanks."""
    return F.rpad(_c(s).cast("string"), n, " ")


def checked_length(s: Column, n: int, column: str) -> Column:
    """A value on its way into VARCHAR(n): an error if it doesn't fit, but blanks too many are cut."""
    fits = F.length(F.rtrim(s)) <= n
    return F.when(s.isNull() | fits, F.substr(s, F.lit(1), F.lit(n))).otherwise(F.raise_error(F.lit(f"value too long for column {column}: VARCHAR({n})")).cast("string"))
