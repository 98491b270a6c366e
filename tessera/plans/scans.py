"""Scans, projection, filters, sorting, limits and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.math import int_divide
from tessera.operators.relational import nulls_last
from tessera.operators.series import generate_series, lateral_series, timestamp_series
from tessera.plans.registry import query
from tessera.sources.tables import load, views

@query("scan_full", "SELECT * FROM lineitem")
def scan_full(spark, sf):
    return load(spark, sf, "lineitem")


@query("scan_filter_project", "SELECT l_orderkey, l_partkey, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem WHERE l_quantity < 3 AND l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'")
def scan_filter_project(spark, sf):
    li = load(spark, sf, "lineitem").where((F.col("l_quantity") < 3) & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")))
    return li.select("l_orderkey", "l_partkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


@query("scan_point", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 7")
def scan_point(spark, sf):
    return load(spark, sf, "orders").where("o_orderkey = 7").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("scan_empty", "SELECT n_nationkey, n_name FROM nation WHERE 1 = 0")
def scan_empty(spark, sf):
    return load(spark, sf, "nation").where("1 = 0").select("n_nationkey", "n_name")


@query("select_without_from", "SELECT 1 AS one, 'a' AS a, CAST(NULL AS INTEGER) AS nothing, 7 // 2 AS quotient")
def select_without_from(spark, sf):
    return spark.range(1).select(F.lit(1).alias("one"), F.lit("a").alias("a"), F.lit(None).cast("int").alias("nothing"), F.expr("CAST(7 div 2 AS int)").alias("quotient"))


@query("select_star_prefix", "SELECT n.*, r_name AS region FROM nation n JOIN region ON n_regionkey = r_regionkey")
def select_star_prefix(spark, sf):
    n, r = load(spark, sf, "nation").alias("n"), load(spark, sf, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n.*", F.col("r_name").alias("region"))


@query("values_rows", "SELECT * FROM (VALUES (1, 'a', 1.5::DOUBLE), (2, NULL, 2.5), (3, 'c', NULL)) t(k, s, x)")
def values_rows(spark, sf):
    return spark.sql("SELECT * FROM VALUES (1, 'a', 1.5D), (2, NULL, 2.5D), (3, 'c', NULL) AS t(k, s, x)")


@query("literals", "SELECT DATE '2024-02-29' AS d, TIMESTAMP '2024-02-29 12:30:45.5' AS ts, 'it''s' AS q, 'a;b' AS dollar, TRUE AS t, 1.5::DECIMAL(3,1) AS n, 'ff' AS hex")
def literals(spark, sf):
    return spark.range(1).select(
        F.lit("2024-02-29").cast("date").alias("d"), F.lit("2024-02-29 12:30:45.5").cast("timestamp_ntz").alias("ts"), F.lit("it's").alias("q"), F.lit("a;b").alias("dollar"), F.lit(True).alias("t"), F.lit("1.5").cast("decimal(3,1)").alias("n"), F.lower(F.hex(F.unhex(F.lit("ff")))).alias("hex")
    )


@query("parameters", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 3 AND c_acctbal > 5000")
def parameters(spark, sf):
    views(spark, sf, "customer")
    return spark.sql("SELECT c_custkey, c_name FROM customer WHERE c_nationkey = ? AND c_acctbal > ?", args=[3, 5000])


@query("sort_nulls_last", "SELECT o_orderkey, nullif(o_orderstatus, 'O') AS x FROM orders ORDER BY x NULLS LAST, o_orderkey")
def sort_nulls_last(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'O')").alias("x"))
    return o.orderBy(*nulls_last("x", "o_orderkey"))


@query("sort_desc_nulls_last", "SELECT o_orderkey, x FROM (SELECT o_orderkey, nullif(o_orderstatus, 'O') AS x FROM orders) ORDER BY x DESC NULLS LAST, o_orderkey LIMIT 25")
def sort_desc_nulls_last(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'O')").alias("x"))
    return o.orderBy(*nulls_last("x", "o_orderkey", desc=["x"])).limit(25)


@query("limit_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5")
def limit_offset(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(5).limit(10)


@query("fetch_first", "SELECT c_custkey FROM customer ORDER BY c_custkey FETCH FIRST 5 ROWS ONLY")
def fetch_first(spark, sf):
    return load(spark, sf, "customer").select("c_custkey").orderBy("c_custkey").limit(5)


@query("topk", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20")
def topk(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(20)


@query("order_by_ordinal_alias", "SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, p LIMIT 3")
def order_by_ordinal_alias(spark, sf):
    views(spark, sf, "orders")
    return spark.sql("SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, p LIMIT 3")


@query("generate_series_int", "SELECT value::BIGINT AS value FROM generate_series(1, 20, 3) t(value)")
def generate_series_int(spark, sf):
    return generate_series(spark, 1, 20, 3)


@query("generate_series_down", "SELECT value::BIGINT AS value FROM generate_series(10, 1, -4) t(value)")
def generate_series_down(spark, sf):
    return generate_series(spark, 10, 1, -4)


@query("generate_series_months", "SELECT value FROM (VALUES (TIMESTAMP '2024-01-31 00:00:00'), (TIMESTAMP '2024-02-29 00:00:00'), (TIMESTAMP '2024-03-29 00:00:00'), (TIMESTAMP '2024-04-29 00:00:00')) t(value)")
def generate_series_months(spark, sf):
    return timestamp_series(spark, "2024-01-31", "2024-04-30", months=1)


@query("generate_series_spine", "SELECT d.value AS day, count(event_id) AS n FROM generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-02-05 00:00:00', INTERVAL 1 DAY) d(value) LEFT JOIN events ON date_trunc('day', ts) = d.value GROUP BY 1")
def generate_series_spine(spark, sf):
    # count before the join: the spine meets a row a day, whatever the number of events
    days = load(spark, sf, "events").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count("event_id").alias("n"))
    return timestamp_series(spark, "2024-01-01", "2024-02-05", days=1, name="day").join(days, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("generate_series_lateral", "SELECT n_nationkey, s.value::INTEGER AS value FROM nation, LATERAL generate_series(n_regionkey, n_regionkey + 2) s(value)")
def generate_series_lateral(spark, sf):
    return lateral_series(load(spark, sf, "nation"), "n_regionkey", "n_regionkey + 2").select("n_nationkey", "value")


@query("arithmetic_types", "SELECT l_orderkey, l_linenumber, (l_linenumber::BIGINT + l_partkey) AS plus, (l_partkey // 7)::BIGINT AS quotient, (l_partkey % 7)::BIGINT AS rest, -l_partkey AS minus, l_returnflag || l_linestatus AS joined FROM lineitem")
def arithmetic_types(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_linenumber").cast("bigint") + F.col("l_partkey")).alias("plus"), int_divide(F.col("l_partkey"), 7).alias("quotient"), (F.col("l_partkey") % 7).alias("rest"), (-F.col("l_partkey")).alias("minus"), F.concat("l_returnflag", "l_linestatus").alias("joined"))
