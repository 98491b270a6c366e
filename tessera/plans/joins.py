"""Joins and lateral queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.relational import join_using, natural_join, salted_join, top_k_per_group
from tessera.plans.registry import query
from tessera.sources.tables import load, views


def _co(spark, sf):
    return load(spark, sf, "customer"), load(spark, sf, "orders")


@query("join_inner", "SELECT c_custkey, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey AND o_totalprice > c_acctbal * 20")
def join_inner(spark, sf):
    c, o = _co(spark, sf)
    return c.join(o, (F.col("c_custkey") == F.col("o_custkey")) & (F.col("o_totalprice") > F.col("c_acctbal") * 20)).select("c_custkey", "o_orderkey")


for _how, _sql in (("left", "LEFT"), ("right", "RIGHT"), ("full", "FULL")):

    def _outer(spark, sf, how=_how):
        n, s = load(spark, sf, "nation"), load(spark, sf, "supplier")
        return n.join(s, (F.col("n_nationkey") == F.col("s_nationkey")) & (F.col("s_acctbal") > 9000), how).select("n_name", "s_suppkey")

    query(f"join_{_how}", f"SELECT n_name, s_suppkey FROM nation {_sql} JOIN supplier ON n_nationkey = s_nationkey AND s_acctbal > 9000")(_outer)


@query("join_cross", "SELECT n_nationkey, r_regionkey FROM nation, region")
def join_cross(spark, sf):
    return load(spark, sf, "nation").crossJoin(load(spark, sf, "region")).select("n_nationkey", "r_regionkey")


@query("join_theta", "SELECT a.n_nationkey AS x, b.n_nationkey AS y FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey >= b.n_regionkey")
def join_theta(spark, sf):
    n = load(spark, sf, "nation")
    a, b = n.alias("a"), n.alias("b")
    return a.join(b, F.expr("a.n_nationkey < b.n_nationkey AND a.n_regionkey >= b.n_regionkey")).select(F.col("a.n_nationkey").alias("x"), F.col("b.n_nationkey").alias("y"))


@query("join_lookup", "SELECT o_orderkey, o_totalprice FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey = 7 AND c_mktsegment = 'BUILDING'")
def join_lookup(spark, sf):
    c, o = _co(spark, sf)
    return o.join(c.where("c_nationkey = 7 AND c_mktsegment = 'BUILDING'").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_totalprice")


@query("join_using", "SELECT n.k AS k, r.k AS k_right, n_name, r_name FROM (SELECT n_regionkey AS k, n_name FROM nation) n LEFT JOIN (SELECT r_regionkey + 2 AS k, r_name FROM region) r ON n.k = r.k")
def join_using_query(spark, sf):
    n = load(spark, sf, "nation").selectExpr("n_regionkey AS k", "n_name")
    r = load(spark, sf, "region").selectExpr("r_regionkey + 2 AS k", "r_name")
    return join_using(n, r, ["k"], "left").select("k", "k_right", "n_name", "r_name")


@query("join_natural", "SELECT k, n_name, r_name FROM (SELECT n_regionkey AS k, n_name FROM nation) n NATURAL FULL JOIN (SELECT r_regionkey + 2 AS k, r_name FROM region) r")
def join_natural(spark, sf):
    n = load(spark, sf, "nation").selectExpr("n_regionkey AS k", "n_name")
    r = load(spark, sf, "region").selectExpr("r_regionkey + 2 AS k", "r_name")
    return natural_join(n, r, "full")


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def join_semi(spark, sf):
    c, o = _co(spark, sf)
    return c.join(o.where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("join_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def join_anti(spark, sf):
    c, o = _co(spark, sf)
    return c.join(o.where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("join_null_keys", "SELECT a.n_nationkey, b.s_suppkey FROM (SELECT n_nationkey, nullif(n_nationkey, 3) AS k FROM nation) a LEFT JOIN (SELECT s_suppkey, nullif(s_nationkey, 3) AS k FROM supplier) b ON a.k = b.k")
def join_null_keys(spark, sf):
    a = load(spark, sf, "nation").selectExpr("n_nationkey", "nullif(n_nationkey, 3) AS k")
    b = load(spark, sf, "supplier").selectExpr("s_suppkey", "nullif(s_nationkey, 3) AS kb")
    return a.join(b, F.col("k") == F.col("kb"), "left").select("n_nationkey", "s_suppkey")


@query("join_multiway", "SELECT r_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def join_multiway(spark, sf):
    c, o = _co(spark, sf)
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("join_selective_groupby", "SELECT c_mktsegment, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_nationkey = 7 GROUP BY 1")
def join_selective_groupby(spark, sf):
    c, o = _co(spark, sf)
    return o.join(c.where("c_nationkey = 7"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("join_salted", "SELECT event_type, count(*) AS n FROM events JOIN (SELECT DISTINCT user_id AS u FROM events WHERE event_type = 'purchase') ON user_id = u GROUP BY 1")
def join_salted(spark, sf):
    e = load(spark, sf, "events")
    buyers = e.where("event_type = 'purchase'").select("user_id").distinct()
    return salted_join(e.select("user_id", "event_type"), buyers, "user_id").groupBy("event_type").agg(F.count("*").alias("n"))


@query("join_lateral", "SELECT c_custkey, n, total FROM customer c, LATERAL (SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_custkey = c.c_custkey)")
def join_lateral(spark, sf):
    views(spark, sf, "customer", "orders")
    return spark.sql("SELECT c_custkey, n, total FROM customer c, LATERAL (SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_custkey = c.c_custkey)")


@query("join_lateral_left", "SELECT n_nationkey, s_suppkey FROM nation LEFT JOIN LATERAL (SELECT s_suppkey FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000) ON TRUE")
def join_lateral_left(spark, sf):
    views(spark, sf, "nation", "supplier")
    return spark.sql("SELECT n_nationkey, s_suppkey FROM nation LEFT JOIN LATERAL (SELECT s_suppkey FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000)")


@query("lateral_topk", "SELECT c_custkey, o_orderkey FROM customer, LATERAL (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2)")
def lateral_topk(spark, sf):
    c, o = _co(spark, sf)
    top = top_k_per_group(o, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 2)
    return c.join(top, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey")


@query("join_char_padding", "SELECT n_nationkey, r_regionkey FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_char_padding(spark, sf):
    # CHAR(n) keys: padding doesn't count, so keys are compared without it
    n = load(spark, sf, "nation").join(load(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.rpad("r_name", 20, " ").alias("padded")), F.col("n_regionkey") == F.col("k")).select("n_nationkey", "padded")
    r = load(spark, sf, "region").select("r_regionkey", F.rpad("r_name", 30, " ").alias("name"))
    return n.join(r, F.rtrim("padded") == F.rtrim("name")).select("n_nationkey", "r_regionkey")


@query("join_date_timestamp", "SELECT event_id, d FROM events JOIN (SELECT DISTINCT ts::DATE AS d FROM events) ON date_trunc('day', ts) = d::TIMESTAMP")
def join_date_timestamp(spark, sf):
    e = load(spark, sf, "events")
    days = e.select(F.col("ts").cast("date").alias("d")).distinct()
    return e.join(days, F.date_trunc("day", "ts").cast("timestamp_ntz") == F.col("d").cast("timestamp_ntz")).select("event_id", "d")


@query("join_nan_keys", "SELECT a.k AS x, b.k AS y FROM (VALUES (1, 'NaN'::DOUBLE), (2, 1.5), (3, NULL)) a(k, v) JOIN (VALUES (7, 'NaN'::DOUBLE), (8, NULL), (9, 1.5)) b(k, v) ON a.v = b.v")
def join_nan_keys(spark, sf):
    a = spark.sql("SELECT * FROM VALUES (1, double('NaN')), (2, 1.5D), (3, NULL) AS a(x, v)")
    b = spark.sql("SELECT * FROM VALUES (7, double('NaN')), (8, NULL), (9, 1.5D) AS b(y, w)")
    return a.join(b, F.col("v") == F.col("w")).select("x", "y")
