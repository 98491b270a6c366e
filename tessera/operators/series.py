"""GENERATE_SERIES of whole numbers, decimals and timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST = 1_000_000


def generate_series(spark: SparkSession, start, stop, step=1, name: str = "value") -> DataFrame:
    """Numbers from start to stop; no row if an argument is None; an error for step 0 or over MOST rows. Spark's range is
    dealt over tasks."""
    if start is None or stop is None or step is None:
        return spark.range(0).select(F.col("id").alias(name))
    if step == 0:
        raise ValueError("step size cannot equal zero")
    n = max(0, int((stop - start) // step) + 1)
    if n > MOST:
        raise ValueError("too many rows in a series")
    return spark.range(n).select((F.lit(start) + F.col("id") * F.lit(step)).alias(name))


def timestamp_series(spark: SparkSession, start: str, stop: str, months: int = 0, days: int = 0, micros: int = 0, name: str = "value") -> DataFrame:
    """Timestamps; a step of months is added to the value before, so a clamped day stays clamped (Jan 31, Feb 29, Mar 29)."""
    if not (months or days or micros):
        raise ValueError("step size cannot equal zero")
    a, b = F.lit(start).cast("timestamp_ntz"), F.lit(stop).cast("timestamp_ntz")
    one = spark.range(1)
    if not months:
        step = F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), F.lit(micros / 1_000_000).cast("decimal(18,6)"))
        return one.select(F.explode(F.sequence(a, b, step)).alias(name))
    # fold: each value comes from the one before; a step has 28 days a month at least, which bounds the number of steps
    least = abs(months) * 28 * 86_400_000_000 + (1 if months > 0 else -1) * (days * 86_400_000_000 + micros)
    if least <= 0:
        raise ValueError("the parts of a step point to different sides")
    up = F.lit(months > 0)
    span = F.when(up, F.timestamp_diff("MICROSECOND", a, b)).otherwise(F.timestamp_diff("MICROSECOND", b, a))
    count = F.least(F.lit(MOST), F.floor(span / F.lit(least)) + 1).cast("int")
    step = lambda x: (F.timestamp_add("MONTH", F.lit(months), x) + F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), F.lit(micros / 1_000_000).cast("decimal(18,6)"))).cast("timestamp_ntz")
    values = F.aggregate(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), F.array(a), lambda acc, _: F.concat(acc, F.array(step(F.element_at(acc, -1)))))
    kept = F.when(span >= 0, F.filter(values, lambda x: F.when(up, x <= b).otherwise(x >= b)))
    return one.select(F.explode(kept).alias(name))


def lateral_series(df: DataFrame, start: str, stop: str, step: str = "1", name: str = "value") -> DataFrame:
    """LATERAL GENERATE_SERIES with arguments from the row."""
    return df.withColumn(name, F.explode(F.expr(f"CASE WHEN sign({step}) * ({stop} - {start}) >= 0 THEN sequence({start}, {stop}, {step}) END")))
