"""Aggregates whose rules differ from Spark's defaults. All but the exact sums and the jsonb forms are built-in expressions with map-side partial sums."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import json as js


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sum_int(x) -> Column:
    """SUM of integers: BIGINT, an error only if the total overflows."""
    return F.sum(_c(x).cast("decimal(38,0)")).cast("bigint")


def sum_numeric(x, scale: int) -> Column:
    """SUM of NUMERIC(.., s): NUMERIC(38, s)."""
    return F.sum(_c(x)).cast(f"decimal(38,{scale})")


def avg(x) -> Column:
    """AVG: always DOUBLE."""
    return F.avg(_c(x).cast("double"))


def fsum_exact() -> Column:
    """A grouped Arrow UDF: the exact sum of doubles, rounded once, whatever the order of rows."""

    @F.pandas_udf("double")
    def fsum(v: pd.Series) -> float:
        v = v.dropna()
        return math.fsum(v) if len(v) else None

    return fsum


def _blocks(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """(keys, __b, __m, __s, __n): partial exact sums of ``value``. Each value is split by its binary exponent into whole numbers that
    decimals add up exactly, one partial sum for each of some 60 blocks of exponents, combined before the shuffle; what is infinite or
    NaN is added up as it is, under a null block."""
    v = F.col("__v")
    # v = m * 2**(32 b - 54) with a whole m under 2**87, in two parts that a BIGINT holds
    block = F.when(v == 0, 0).otherwise(F.greatest(F.floor(F.log2(F.abs(v)) / 32), F.lit(-29)).cast("int"))
    special = F.isnan(v) | (F.abs(v) == float("inf"))
    scaled = v * F.pow(F.lit(2.0), F.lit(-32.0) * F.col("__b")) * F.lit(2.0**54)
    high = F.floor(scaled / F.lit(2.0**43))
    whole = high.cast("decimal(20,0)") * F.lit(2**43).cast("decimal(14,0)") + (scaled - high.cast("double") * F.lit(2.0**43)).cast("bigint").cast("decimal(20,0)")
    return (
        df.select(*keys, value.cast("double").alias("__v"))
        .where(v.isNotNull())
        .select(*keys, v, F.when(~special, block).alias("__b"))
        .select(*keys, "__b", F.when(F.col("__b").isNotNull(), whole.cast("decimal(38,0)")).alias("__m"), F.when(F.col("__b").isNull(), v).alias("__s"))
        .groupBy(*keys, "__b")
        .agg(F.sum("__m").alias("__m"), F.sum("__s").alias("__s"), F.count("*").alias("__n"))
    )


def _quotient(total: int, shift: int) -> float:
    """total / shift, rounded once; an infinity if it is out of range."""
    try:
        return total / shift
    except OverflowError:
        return math.inf if (total > 0) == (shift > 0) else -math.inf


def _exact(df: DataFrame, keys: Sequence[str], value: Column, name: str, mean: bool) -> DataFrame:
    @F.pandas_udf("double")
    def combine(blocks: pd.Series, sums: pd.Series, specials: pd.Series, counts: pd.Series) -> float:
        at = blocks.isna()
        if at.any():
            return float(specials[at].sum(skipna=False))
        total = sum(int(m) << (32 * (int(b) + 32)) for b, m in zip(blocks, sums, strict=True))
        return _quotient(total, (1 << (54 + 32 * 32)) * (int(counts.sum()) if mean else 1))

    return _blocks(df, keys, value).groupBy(*keys).agg(combine("__b", "__m", "__s", "__n").alias(name))


def exact_sum(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact sums of doubles, rounded once, for groups of any size and rows in any order; Python only adds a group's blocks. A sum out of
    range is an infinity; infinite and NaN values make it what adding them up gives. Magnitudes under 2**-900 are outside the
    blocks and may lose digits."""
    return _exact(df, keys, F.col(value), name, False)


def exact_avg(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The exact sum divided by the number of values, rounded once."""
    return _exact(df, keys, F.col(value), name, True)


def exact_variance(df: DataFrame, keys: Sequence[str], value: str, name: str, population: bool = False, root: bool = False) -> DataFrame:
    """Variance (with root its square root) from exact sums: a second pass adds up the squares of the distances from the exact mean. NULL for
    one value of a sample; a NaN or an infinity makes it NaN."""
    means = exact_avg(df, keys, value, "__mean").select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__mean")
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    distance = F.col(value).cast("double") - F.col("__mean")
    far = df.join(means, same) if keys else df.crossJoin(F.broadcast(means))  # without keys one row
    far = far.where(F.col(value).isNotNull()).withColumn("__d", F.when(F.abs("__mean") == float("inf"), F.lit(float("nan"))).otherwise(distance * distance))
    sums = exact_sum(far, keys, "__d", "__ss")
    counts = df.groupBy(*keys).agg(F.count(value).alias("__n")).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__n")
    joined = sums.join(counts, same) if keys else sums.crossJoin(F.broadcast(counts))
    out = F.when(F.col("__n") > (0 if population else 1), F.col("__ss") / (F.col("__n") if population else F.col("__n") - 1))
    return joined.select(*keys, (F.sqrt(out) if root else out).alias(name))


def string_agg(x, sep: str | Column, order: Sequence[Column] | None = None, distinct: bool = False) -> Column:
    """STRING_AGG(x, sep ORDER BY ..): a separator of its own for each row goes before the row's value; DISTINCT sorts by value."""
    x = _c(x)
    if distinct:
        return F.array_join(F.array_sort(F.collect_set(x)), sep if isinstance(sep, str) else ",")
    if isinstance(sep, str):
        keyed = F.when(x.isNotNull(), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(order or [])], x.alias("x")))
        items = F.array_sort(F.collect_list(keyed))
        return F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda s: s["x"]), sep))
    keyed = F.when(x.isNotNull(), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(order or [])], x.alias("x"), sep.alias("sep")))
    return F.aggregate(F.array_sort(F.collect_list(keyed)), F.lit(None).cast("string"), lambda a, s: F.when(a.isNull(), s["x"]).otherwise(F.concat(a, F.coalesce(s["sep"], F.lit("")), s["x"])))


def percentile_disc(df: DataFrame, keys: Sequence[str], x: str, fraction: float, name: str) -> DataFrame:
    """(keys, name): PERCENTILE_DISC of any sortable type, by numbers of the group's sorted rows; no group is collected."""
    w = W.partitionBy(*keys)
    ranked = df.where(F.col(x).isNotNull()).select(*keys, x).withColumn("__rn", F.row_number().over(w.orderBy(x))).withColumn("__n", F.count("*").over(w))
    found = ranked.where(F.col("__rn") == F.greatest(F.ceil(F.lit(fraction) * F.col("__n")), F.lit(1))).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(x).alias(name))
    groups = df.select(*keys).distinct()
    return groups.join(found, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], "left").select(*keys, name)


def json_agg(x, order: Sequence[Column] | None = None) -> Column:
    """JSON_AGG(x ORDER BY ..): the elements' own JSON texts, NULLs as null; no rows give NULL. Documents come in js.Raw."""
    raw = isinstance(x, js.Raw)
    x = x.c if raw else _c(x)
    items = F.array_sort(F.collect_list(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(order or [])], x.alias("x"))))
    texts = F.transform(items, lambda s: js.quote(js.Raw(s["x"]) if raw else s["x"]))
    return F.when(F.size(items) > 0, F.concat(F.lit("["), F.array_join(texts, ", "), F.lit("]")))


def json_object_agg(k, v) -> Column:
    """JSON_OBJECT_AGG(k, v) in key order; a NULL key is an error, a NULL value stays null. Documents come in js.Raw."""
    pair = F.concat(js.key(_c(k)), F.lit(" : "), js.quote(v if isinstance(v, js.Raw) else _c(v)))
    items = F.array_sort(F.collect_list(F.struct(_c(k).cast("string").alias("k"), pair.alias("p"))))
    return F.when(F.size(items) > 0, F.concat(F.lit("{ "), F.array_join(F.transform(items, lambda s: s["p"]), ", "), F.lit(" }")))


def jsonb_agg(x, order: Sequence[Column] | None = None) -> Column:
    """JSONB_AGG: the normal form of JSON_AGG."""
    return js.jsonb(json_agg(x, order))


def jsonb_object_agg(k, v) -> Column:
    """JSONB_OBJECT_AGG: the normal form, in which of equal keys the last stays."""
    return js.jsonb(json_object_agg(k, v))


def grouping_bits(*names: str) -> Column:
    """GROUPING(a, b, ..): a bit for each argument, the last the lowest."""
    out = F.lit(0)
    for k, n in enumerate(names):
        out = out + F.shiftleft(F.grouping(n).cast("int"), len(names) - 1 - k)
    return out.cast("int")


def with_grand_total(sets: DataFrame, total: DataFrame) -> DataFrame:
    """Grouping sets with the empty set over an input that may be empty: Spark gives no row there, SQL gives one."""
    return sets.unionByName(total, allowMissingColumns=True)


def ungrouped(x, order) -> Column:
    """An ungrouped column: that of the group's first row in an order."""
    return F.min_by(_c(x), _c(order))


def mode(x, descending: bool = False) -> Column:
    """MODE() WITHIN GROUP (ORDER BY x): among ties the first in order."""
    return F.mode(_c(x), True)
