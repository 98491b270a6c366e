"""Recursive queries: UNION with duplicate elimination, SEARCH and CYCLE.

Each round is one distributed join of the new rows with the step's tables. Rounds cut their lineage with a reliable
checkpoint in the shared folder, so a lost executor costs a round's tasks only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import shared_folder

MOST_ROUNDS = 10_000


def _checkpointed(df: DataFrame) -> DataFrame:
    """Rows written by a reliable checkpoint. Spark can't rename the constraints of some plans with constants, so it is told to derive none."""
    context, conf, key = df.sparkSession.sparkContext, df.sparkSession.conf, "spark.sql.constraintPropagation.enabled"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    before = conf.get(key)
    conf.set(key, "false")
    try:
        return df.checkpoint()
    finally:
        conf.set(key, before)


class _Rounds:
    """The rows of all rounds so far, each written once and merged with others of its size: n rows are written about log(n) times."""

    def __init__(self, first: DataFrame):
        self.parts: list[tuple[int, DataFrame]] = [(0, first)]

    def add(self, df: DataFrame) -> None:
        level = 0
        while self.parts and self.parts[-1][0] == level and len(self.parts) > 1:
            df, level = _checkpointed(self.parts.pop()[1].unionAll(df)), level + 1
        self.parts.append((level, df))

    @property
    def rows(self) -> DataFrame:
        return reduce(DataFrame.unionAll, [p for _, p in self.parts])


def recursive_union(base: DataFrame, step: Callable[[DataFrame], DataFrame], most: int = MOST_ROUNDS) -> DataFrame:
    """WITH RECURSIVE .. UNION: rows seen before are dropped, so cycles end. NULLs are equal."""
    fresh = _checkpointed(base.distinct())
    seen = _Rounds(fresh)
    names = base.columns
    for _ in range(most):
        new = step(fresh).toDF(*names).distinct().select(*[F.col(f"`{c}`").alias(f"__n{k}") for k, c in enumerate(names)])
        same = reduce(lambda a, b: a & b, [F.col(f"__n{k}").eqNullSafe(F.col(f"`{c}`")) for k, c in enumerate(names)])
        fresh = _checkpointed(new.join(seen.rows, same, "left_anti").toDF(*names))
        if fresh.isEmpty():
            return seen.rows
        seen.add(fresh)
    raise RuntimeError("a recursive query did not end")


def rounds(base: DataFrame, step: Callable[[DataFrame], DataFrame], most: int = MOST_ROUNDS) -> DataFrame:
    """WITH RECURSIVE .. UNION ALL, round by round, for steps that Spark's own recursion can't take."""
    fresh = _checkpointed(base)
    seen = _Rounds(fresh)
    for _ in range(most):
        fresh = _checkpointed(step(fresh).select(*base.columns))
        if fresh.isEmpty():
            return seen.rows
        seen.add(fresh)
    raise RuntimeError("a recursive query did not end")


def ordered(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number all rows by a key. Rows are dealt by ranges of the key and numbered within each; a range's offset, a row each, comes from the
    numbers of rows before it, so no task sorts all rows."""
    dealt = _checkpointed(df.repartitionByRange(F.col(key)).withColumn("__range", F.spark_partition_id()))
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__rows"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.__range") < F.col("a.__range"), "left").groupBy("a.__range").agg(F.coalesce(F.sum("b.__rows"), F.lit(0)).alias("__before"))
    own = F.row_number().over(W.partitionBy("__range").orderBy(key))
    return dealt.join(F.broadcast(before), "__range").withColumn(name, (own + F.col("__before")).cast("bigint")).drop("__range", "__before")


def walk(spark: SparkSession, base: DataFrame, edges: DataFrame, source: str, target: str, key: str, most: int = MOST_ROUNDS) -> DataFrame:
    """Paths from base rows along edges: columns of base, ``depth``, ``path`` (array of keys) and ``is_cycle``. A path ends
    when it comes to a key that it holds already; that last row is marked, as CYCLE .. SET does."""
    front = _checkpointed(base.withColumn("depth", F.lit(0)).withColumn("path", F.array(key)).withColumn("is_cycle", F.lit(False)))
    out = _Rounds(front)
    columns = front.columns
    others = [c for c in base.columns if c != key]
    for _ in range(most):
        nxt = front.where("NOT is_cycle").join(edges.select(F.col(source).alias("__s"), F.col(target).alias("__t")), F.col(key) == F.col("__s"))
        front = _checkpointed(
            nxt.select(*others, F.col("__t").alias(key), (F.col("depth") + 1).alias("depth"), F.concat("path", F.array("__t")).alias("path"), F.array_contains("path", F.col("__t")).alias("is_cycle")).select(*columns)
        )
        if front.isEmpty():
            return out.rows
        out.add(front)
    raise RuntimeError("a recursive query did not end")


def search_order(path: str = "path", breadth_first: bool = False) -> Column:
    """The sort key of SEARCH: DEPTH FIRST compares paths, BREADTH FIRST lengths and then paths."""
    return F.struct(F.size(path).alias("n"), F.col(path).alias("p")) if breadth_first else F.struct(F.col(path).alias("p"))


def path_text(path: str | Column) -> Column:
    """A path in the text form of CYCLE .. USING: ``{(1),(2)}``."""
    c = F.col(path) if isinstance(path, str) else path
    return F.concat(F.lit("{"), F.array_join(F.transform(c, lambda x: F.concat(F.lit("("), x.cast("string"), F.lit(")"))), ","), F.lit("}"))


def native(spark: SparkSession, sql: str, tables: Sequence[str] = ()) -> DataFrame:
    """WITH RECURSIVE .. UNION ALL runs as it is, up to MOST_ROUNDS levels."""
    spark.conf.set("spark.sql.cteRecursionLevelLimit", str(MOST_ROUNDS))
    return spark.sql(sql)
