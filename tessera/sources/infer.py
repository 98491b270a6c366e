"""Types for tables that hold only text: one aggregation finds the narrowest type of every column, try_cast converts.

A whole number with leading zeros (007, a ZIP code) stays text, or it would lose them. Decimals of up to 9 places are NUMERIC with the
largest scale that came; NaN and infinities make a column of numbers DOUBLE; a timestamp with an offset is an instant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts of each class. Fixed patterns and words.
TRUE, FALSE = ("true", "t", "yes"), ("false", "f", "no")
SPECIAL = ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
_INTEGER = r"^[+-]?(0|[1-9][0-9]*)$"
_DECIMAL = r"^[+-]?[0-9]*\.[0-9]+$|^[+-]?[0-9]+\.$"
_FLOAT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?$"
_ZONED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"
#: Decimal places that a NUMERIC takes; more are DOUBLE.
MOST_PLACES = 9
CLASSES = ("boolean", "bigint", "decimal", "double", "special", "date", "timestamp_ntz", "timestamp", "string")


def _classified(v: Column) -> dict[str, Column]:
    """Whether a text is of each class but text."""
    low = F.lower(v)
    matches = lambda p: F.rlike(v, F.lit(p))
    places = F.length(F.substring_index(v, ".", -1))
    whole = matches(_INTEGER)
    fits = v.try_cast("bigint").isNotNull()
    digits = F.length(F.regexp_replace(v, "[^0-9]", ""))
    point = matches(_DECIMAL) & (places <= MOST_PLACES) & (digits <= 38)
    number = matches(_FLOAT) & ~F.rlike(v, F.lit(r"^[+-]?0[0-9]+$")) & v.try_cast("double").isNotNull() & (F.abs(v.try_cast("double")) != float("inf"))
    return {
        "boolean": low.isin(*TRUE, *FALSE), "bigint": whole & fits, "decimal": point | (whole & ~fits & (digits <= 38)), "double": number & ~(whole & (fits | (digits <= 38))) & ~point, "special": low.isin(*SPECIAL),
        "date": matches(_DATE) & v.try_cast("date").isNotNull(), "timestamp_ntz": matches(_TIMESTAMP) & v.try_cast("timestamp_ntz").isNotNull(), "timestamp": matches(_ZONED) & v.try_cast("timestamp").isNotNull(),
    }


def profile(df: DataFrame) -> DataFrame:
    """(column, rows, present, the number of values of each class, the most decimal places and digits before the point): a report over string
    columns, one pass, one row a column."""
    aggs = [F.count("*").alias("rows")]
    for c in df.columns:
        v = F.col(f"`{c}`")
        tests = _classified(v)
        text = F.lit(True)
        for t in tests.values():
            text = text & ~F.coalesce(t, F.lit(False))
        aggs += [F.count(v).alias(f"{c}\0present"), F.count_if(text & v.isNotNull()).alias(f"{c}\0string")] + [F.count_if(t).alias(f"{c}\0{k}") for k, t in tests.items()]
        aggs.append(F.max(F.when(tests["decimal"], F.when(F.contains(v, F.lit(".")), F.length(F.substring_index(v, ".", -1))).otherwise(0))).alias(f"{c}\0places"))
        aggs.append(F.max(F.when(tests["decimal"] | tests["bigint"], F.length(F.regexp_replace(F.substring_index(v, ".", 1), "[^0-9]", "")))).alias(f"{c}\0digits"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col("rows"), *[F.col(f"`{c}\0{k}`").alias(k) for k in ("present", *CLASSES, "places", "digits")]) for c in df.columns]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _kind() -> Column:
    """The narrowest type that takes all values of a column of profile()."""
    numbers = F.col("bigint") + F.col("decimal") + F.col("double") + F.col("special")
    precise = F.concat(F.lit("decimal("), F.least(F.lit(38), F.greatest(F.lit(18), F.col("digits") + F.col("places"))).cast("string"), F.lit(","), F.col("places").cast("string"), F.lit(")"))
    every = F.col("present")
    dates = F.col("date") + F.col("timestamp_ntz")
    return (
        F.when(every == 0, "string")
        .when(F.col("boolean") == every, "boolean")
        .when(F.col("bigint") == every, "bigint")
        .when((F.col("bigint") + F.col("decimal") == every) & (F.coalesce(F.col("digits"), F.lit(0)) + F.col("places") <= 38), precise)
        .when((numbers == every) & (F.col("special") < every), "double")
        .when(F.col("date") == every, "date")
        .when(dates == every, "timestamp_ntz")
        .when(F.col("timestamp") == every, "timestamp")
        .otherwise("string")
    )


def infer(df: DataFrame, sample: int | None = None) -> dict[str, str]:
    """The narrowest type that takes every value of each column (of the first ``sample`` rows, where that is asked for)."""
    report = profile(df.limit(sample) if sample else df).select("column", _kind().alias("kind")).collect()  # a row a column
    return {r["column"]: r["kind"] for r in report}


def _converted(v: Column, kind: str) -> Column:
    if kind == "boolean":
        return F.when(F.lower(v).isin(*TRUE), True).when(F.lower(v).isin(*FALSE), False)
    if kind == "double":
        low = F.lower(v)
        return F.when(low == "nan", F.lit(float("nan"))).when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf"))).when(low.isin("-inf", "-infinity"), F.lit(-float("inf"))).otherwise(v.try_cast("double"))
    return v.try_cast(kind)


def typed(df: DataFrame, kinds: dict[str, str], on_error: str = "null") -> DataFrame:
    """Convert columns; a value that doesn't fit becomes NULL or, on_error="fail", an error."""
    out = []
    for c in df.columns:
        v, kind = F.col(f"`{c}`"), kinds.get(c, "string")
        x = _converted(v, kind)
        if on_error != "null":
            x = F.when(v.isNotNull() & x.isNull(), F.raise_error(F.concat(F.lit(f"{c}: "), v, F.lit(f" is no {kind}"))).cast(kind)).otherwise(x)
        out.append(x.alias(c))
    return df.select(*out)


def check(df: DataFrame) -> DataFrame:
    """A checklist: for each column its share of present values, the type it would get, and how many values of each class stand in the way of a
    narrower one."""
    mixed = [F.when((F.col(k) > 0) & (F.col(k) < F.col("present")), F.concat(F.lit(f"{k} "), F.col(k).cast("string"))) for k in CLASSES]
    return profile(df).select("column", "rows", F.round(F.when(F.col("rows") > 0, F.col("present") / F.col("rows")), 6).alias("present_share"), _kind().alias("type"), F.concat_ws(", ", *mixed).alias("mixed"))
