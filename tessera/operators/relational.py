"""Joins, predicates and set operations whose rules differ from Spark's defaults, as plans of built-in operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def nulls_last(*keys: Column | str, desc: Sequence[str] = ()) -> list[Column]:
    """Sort keys with NULLs last in both directions; names in ``desc`` go down."""
    return [F.col(k).desc_nulls_last() if isinstance(k, str) and k in desc else (F.col(k) if isinstance(k, str) else k).asc_nulls_last() for k in keys]


def join_using(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """JOIN .. USING that keeps both columns: the right one as ``<name>_right``."""
    other = right
    for n in names:
        other = other.withColumnRenamed(n, f"{n}_right")
    return left.join(other, reduce(lambda a, b: a & b, [F.col(n) == F.col(f"{n}_right") for n in names]), how)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """NATURAL JOIN: columns of both names are merged and come first; FULL coalesces them."""
    names = [c for c in left.columns if c in right.columns]
    if not names:
        return left.crossJoin(right)
    return left.join(right, names, how)


def anti_null_aware(left: DataFrame, key: str, sub: DataFrame, column: str) -> DataFrame:
    """``key NOT IN (SELECT column ..)``: with a NULL in the subquery no row qualifies, and a NULL key only if it is empty.
    One small aggregate decides the NULL cases, so the join itself is a hash anti join on any size of input."""
    facts = sub.agg(F.count("*").alias("__n"), F.count_if(F.col(column).isNull()).alias("__nulls"))
    kept = left.join(sub.select(F.col(column).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_anti")
    return kept.join(F.broadcast(facts), (F.col("__n") == 0) | ((F.col("__nulls") == 0) & F.col(key).isNotNull())).drop("__n", "__nulls")


def quantified(df: DataFrame, value: Column, op: str, quantifier: str, sub: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``value op ANY|ALL (SELECT column ..)`` with three-valued logic. The subquery is reduced to one row, which alone is
    broadcast: its least and greatest value and its counts decide every case of < <= > >=, and of = <> with two distinct values."""
    every = quantifier.upper() == "ALL"
    c = F.col(column)
    facts = sub.agg(F.min(c).alias("__lo"), F.max(c).alias("__hi"), F.count("*").alias("__n"), F.count(c).alias("__v"))
    if op in ("=", "<>"):
        # x = ALL: one distinct value; x <> ANY: its negation. x = ANY and x <> ALL are IN and NOT IN: a semi join by value
        if (op == "=") == every:
            sure = (value == F.col("__lo")) & (F.col("__lo") == F.col("__hi"))
            decided = sure if op == "=" else ~sure
        else:
            hit = sub.select(c.alias("__k")).where("__k IS NOT NULL").distinct().withColumn("__hit", F.lit(True))
            df = df.withColumn("__x", value).join(hit, F.col("__x") == F.col("__k"), "left").drop("__k")
            value = F.col("__x")
            found = F.coalesce("__hit", F.lit(False))
            decided = ~found if op == "<>" else found
    else:
        end = F.col("__lo") if (op[0] == ">") != every else F.col("__hi")
        decided = {">": value > end, ">=": value >= end, "<": value < end, "<=": value <= end}[op]
    out = (
        F.when(F.col("__n") == 0, F.lit(every))
        .when(value.isNull(), None)
        .when(F.coalesce(decided, F.lit(every)) != F.lit(every), F.lit(not every))
        .when(F.col("__n") > F.col("__v"), None)
        .otherwise(F.lit(every))
    )
    return df.crossJoin(F.broadcast(facts)).withColumn(name, out).drop("__lo", "__hi", "__n", "__v", "__hit", "__x")


def row_compare(left: Sequence[Column], op: str, right: Sequence[Column]) -> Column:
    """Row values item by item with three-valued logic: (1, NULL) = (1, 2) is unknown, (1, NULL) < (2, 0) true."""
    pairs = list(zip(left, right, strict=True))
    if op == "=":
        return reduce(lambda a, b: a & b, [x == y for x, y in pairs])
    if op == "<>":
        return ~row_compare(left, "=", right)
    strict = op[0]
    out = None
    for k, (x, y) in reversed(list(enumerate(pairs))):
        last = k == len(pairs) - 1
        here = (x < y) if strict == "<" else (x > y)
        if last:
            out = here if len(op) == 1 else ((x <= y) if strict == "<" else (x >= y))
        else:
            out = here | ((x == y) & out)
    return out


def row_is_null(items: Sequence[Column]) -> Column:
    """All items are NULL."""
    return reduce(lambda a, b: a & b, [x.isNull() for x in items])


def row_is_not_null(items: Sequence[Column]) -> Column:
    """No item is NULL; not the negation of row_is_null."""
    return reduce(lambda a, b: a & b, [x.isNotNull() for x in items])


def row_in(items: Sequence[Column], rows: Sequence[Sequence]) -> Column:
    """(a, b) IN ((..), ..)."""
    return reduce(lambda a, b: a | b, [row_compare(items, "=", [v if isinstance(v, Column) else F.lit(v) for v in r]) for r in rows])


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """DISTINCT ON: the first row of each key. Spark keeps a row for each key in every map task (WindowGroupLimit)."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def qualify(df: DataFrame, condition: Column, *columns: tuple[str, Column]) -> DataFrame:
    """QUALIFY: a condition over window results, given as named columns that stay in the result."""
    for name, c in columns:
        df = df.withColumn(name, c)
    return df.where(condition)


def set_operation(left: DataFrame, right: DataFrame, kind: str, all_rows: bool = False) -> DataFrame:
    """UNION, INTERSECT, EXCEPT by position, NULLs equal; ALL keeps multiset counts. Types widen as in Spark's union."""
    right = right.toDF(*left.columns)
    if kind == "union":
        out = left.union(right)
        return out if all_rows else out.distinct()
    if kind == "intersect":
        return left.intersectAll(right) if all_rows else left.intersect(right)
    if kind == "except":
        return left.exceptAll(right) if all_rows else left.subtract(right)
    raise ValueError(kind)


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: int = 16, how: str = "inner") -> DataFrame:
    """Equi-join with a hot key: rows of the big side spread over ``salts`` copies of the other side's. For plans that adaptive
    execution can't split, such as one that aggregates by the same key right after."""
    if how not in ("inner", "left"):
        raise ValueError("the copied side can't be preserved")
    spread = big.withColumn("__salt", (F.rand(7) * salts).cast("int"))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [key, "__salt"], how).drop("__salt")
