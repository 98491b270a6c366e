"""Window features that Spark's SQL lacks, as columns over its own window operator."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def filtered(aggregate, condition: Column, x: Column | None = None) -> Column:
    """An aggregate's FILTER (WHERE ..) for use over a window."""
    return aggregate(F.when(condition, F.lit(1) if x is None else x))


def groups_frame(df: DataFrame, partition: Sequence[str], order: Sequence[str], start: int, end: int, **aggs: Column) -> DataFrame:
    """A GROUPS frame: a RANGE frame over the number of the peer group."""
    df = df.withColumn("__g", F.dense_rank().over(W.partitionBy(*partition).orderBy(*[F.col(c).asc_nulls_last() for c in order])))
    w = W.partitionBy(*partition).orderBy("__g").rangeBetween(start, end)
    for name, a in aggs.items():
        df = df.withColumn(name, a.over(w))
    return df.drop("__g")


#: Rows beside the current one that a ROWS frame with EXCLUDE GROUP or TIES may reach by number.
MOST_BESIDE = 200
_LOW, _HIGH = -(1 << 31), 1 << 31


def frames(mode: str, start: int, end: int, exclude: str) -> list[tuple[str, int, int]]:
    """A frame without what it excludes, as frames apart from each other: (kind, start, end). The kinds are "groups" (of peers, by
    number), "rows", "peers" (rows among the current row's peers) and "beside" (a single row so far away, unless it is a peer). Nothing has to
    be subtracted, so infinities and rounding stay out of it. Ends beyond 2**31 are unbounded."""
    start, end = max(start, _LOW), min(end, _HIGH)
    inside = start <= 0 <= end
    kind = "rows" if mode == "rows" else "groups"

    def span(k: str, a: int, b: int) -> list[tuple[str, int, int]]:
        return [(k, a, b)] if a <= b else []

    sides = span(kind, start, min(end, -1)) + span(kind, max(start, 1), end)
    if exclude == "no others" or not inside and (mode != "rows" or exclude == "current row"):
        return span(kind, start, end)
    if exclude == "current row":
        return sides if mode == "rows" else sides + [("peers", _LOW, -1), ("peers", 1, _HIGH)]
    own = [("rows", 0, 0)] if exclude == "ties" and inside else []
    if mode != "rows":
        return sides + own
    out = own
    for a, b, whole in ((start, min(end, -1), ("groups", _LOW, -1)), (max(start, 1), end, ("groups", 1, _HIGH))):
        if a > b:
            continue
        if a == _LOW and b == -1 or a == 1 and b == _HIGH:
            out = [*out, whole]
        elif a == _LOW or b == _HIGH or b - a >= MOST_BESIDE:
            raise NotImplementedError("such a frame can't exclude peers")
        else:
            out = [*out, *(("beside", j, j) for j in range(a, b + 1))]
    return out


def numbered(df: DataFrame, partition: Sequence[str], order: Sequence[str], unique: Sequence[str] = ()) -> DataFrame:
    """Add ``__g``, the number of the peer group, and ``__rn``, that of the row."""
    keys = [F.col(c).asc_nulls_last() for c in order]
    return df.withColumn("__g", F.dense_rank().over(W.partitionBy(*partition).orderBy(*keys))).withColumn("__rn", F.row_number().over(W.partitionBy(*partition).orderBy(*keys, *unique)))


def framed(df: DataFrame, partition: Sequence[str], order: Sequence[str], unique: Sequence[str], value: str, mode: str, start: int, end: int, exclude: str = "no others", **names: str) -> DataFrame:
    """Aggregates of ``value`` (sum, count, min, max, avg as names of columns) over a ROWS or GROUPS frame with any EXCLUDE. No frame is
    collected."""
    df = numbered(df, partition, order, unique)
    v = F.col(value)
    by_rows, by_groups = W.partitionBy(*partition).orderBy("__rn"), W.partitionBy(*partition).orderBy("__g")
    windows = {"rows": by_rows.rowsBetween, "groups": by_groups.rangeBetween, "peers": W.partitionBy(*partition, "__g").orderBy("__rn").rowsBetween}
    wide = lambda a, b: (W.unboundedPreceding if a == _LOW else a, W.unboundedFollowing if b == _HIGH else b)
    sums, counts, least, most = [], [], [], []
    for kind, a, b in frames(mode, start, end, exclude):
        if kind == "beside":
            x = F.when(F.lag("__g", -a).over(by_rows) != F.col("__g"), F.lag(v, -a).over(by_rows))
            parts = x, F.when(x.isNotNull(), 1).otherwise(0), x, x
        else:
            w = windows[kind](*wide(a, b))
            parts = F.sum(v).over(w), F.count(v).over(w), F.min(v).over(w), F.max(v).over(w)
        for out, part in zip((sums, counts, least, most), parts, strict=True):
            out.append(part)
    count = reduce(lambda a, b: a + b, counts, F.lit(0)).cast("bigint")
    total = F.when(count > 0, reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0)) for x in sums])) if sums else F.lit(None).cast(df.schema[value].dataType)
    ends = {"min": (F.least, least), "max": (F.greatest, most)}
    for kind, name in names.items():
        if kind in ends:
            fn, parts = ends[kind]
            out = fn(*parts) if len(parts) > 1 else parts[0] if parts else F.lit(None).cast(df.schema[value].dataType)
        else:
            out = {"sum": total, "count": count, "avg": F.when(count > 0, total.cast("double") / count)}[kind]
        df = df.withColumn(name, out)
    return df.drop("__g", "__rn")


def excluding(df: DataFrame, partition: Sequence[str], order: Sequence[str], unique: Sequence[str], value: str, exclude: str, start: int = W.unboundedPreceding, end: int = W.unboundedFollowing, sum_name: str = "s", count_name: str = "c") -> DataFrame:
    """SUM and COUNT of ``value`` over a ROWS frame with EXCLUDE current row, group, ties or no others."""
    return framed(df, partition, order, unique, value, "rows", start, end, exclude, sum=sum_name, count=count_name)


def ntile(n: Column, partition: Sequence[str], order: Sequence[Column]) -> Column:
    """NTILE(n) with n from the row: the first (count mod n) buckets hold one row more."""
    w = W.partitionBy(*partition)
    k, size = F.row_number().over(w.orderBy(*order)) - 1, F.count("*").over(w)
    small, more = F.floor(size / n), size % n
    edge = more * (small + 1)
    return (F.when(k < edge, F.floor(k / (small + 1))).otherwise(more + F.floor((k - edge) / F.greatest(small, F.lit(1)))) + 1).cast("bigint")


def shifted(df: DataFrame, x: str, offset: str, partition: Sequence[str], order: Sequence[str], unique: Sequence[str], name: str, default: Column | None = None) -> DataFrame:
    """Add LAG (LEAD with a negative offset) by an offset from the row: the row's place less the offset is looked up among the partition's
    numbered rows, an equi-join by partition and place, so no partition is collected."""
    keys = [F.col(c).asc_nulls_last() for c in order]
    rows = df.withColumn("__rn", F.row_number().over(W.partitionBy(*partition).orderBy(*keys, *unique)))
    other = rows.select(*[F.col(c).alias(f"__p{k}") for k, c in enumerate(partition)], F.col("__rn").alias("__at"), F.col(x).alias("__v"), F.lit(True).alias("__there"))
    same = [F.col(c).eqNullSafe(F.col(f"__p{k}")) for k, c in enumerate(partition)]
    joined = rows.join(other, reduce(lambda a, b: a & b, [*same, F.col("__rn") - F.col(offset) == F.col("__at")]), "left")
    value = F.when(F.col("__there"), F.col("__v")).when(F.col(offset).isNotNull(), F.lit(None) if default is None else default)
    return joined.withColumn(name, value).select(*df.columns, name)


def range_on_time(column: Column) -> Column:
    """A TIME key of a RANGE frame as microseconds, with which numeric offsets work."""
    text = column.cast("string")
    parts = F.split(text, ":")
    return ((parts[0].cast("bigint") * 3600 + parts[1].cast("bigint") * 60) * 1_000_000 + (parts[2].cast("decimal(9,6)") * 1_000_000).cast("bigint")).cast("bigint")


class Spec:
    """A named window that others can extend: OVER (w ORDER BY ..)."""

    def __init__(self, partition: Sequence[str] = (), order: Sequence[Column] = ()):
        self.partition, self.order = tuple(partition), tuple(order)

    def extend(self, order: Sequence[Column] = ()) -> Spec:
        if self.order and order:
            raise ValueError("cannot override ORDER BY of the window")
        return Spec(self.partition, order or self.order)

    @property
    def window(self):
        w = W.partitionBy(*self.partition)
        return w.orderBy(*self.order) if self.order else w
