"""Window functions and frames."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import windows as win
from tessera.operators.relational import qualify, top_k_per_group
from tessera.plans.registry import query
from tessera.sources.tables import load, views

_CUST = "PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"


def _orders(spark, sf):
    return load(spark, sf, "orders")


def _by_date():
    return W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")


@query("win_rank", "SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER p AS r, dense_rank() OVER p AS d, round(percent_rank() OVER p, 9) AS pr, round(cume_dist() OVER p, 9) AS cd FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), p AS (PARTITION BY o_custkey ORDER BY o_orderpriority)")
def win_rank(spark, sf):
    w, p = _by_date(), W.partitionBy("o_custkey").orderBy("o_orderpriority")
    long = lambda c: c.cast("bigint")
    return _orders(spark, sf).select("o_orderkey", long(F.row_number().over(w)).alias("rn"), long(F.rank().over(p)).alias("r"), long(F.dense_rank().over(p)).alias("d"), F.round(F.percent_rank().over(p), 9).alias("pr"), F.round(F.cume_dist().over(p), 9).alias("cd"))


@query("win_ntile", f"SELECT o_orderkey, ntile(4) OVER ({_CUST}) AS t FROM orders")
def win_ntile(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.ntile(4).over(_by_date()).cast("bigint").alias("t"))


@query("win_ntile_expression", "SELECT n_nationkey, ntile(3) OVER (PARTITION BY n_regionkey ORDER BY n_name) AS t FROM nation")
def win_ntile_expression(spark, sf):
    return load(spark, sf, "nation").select("n_nationkey", win.ntile(F.lit(1) + F.lit(2), ["n_regionkey"], [F.col("n_name")]).alias("t"))


@query("win_offset", f"SELECT o_orderkey, lag(o_totalprice) OVER w AS a, lag(o_totalprice, 2, -1) OVER w AS b, lead(o_orderkey, 1) OVER w AS c FROM orders WINDOW w AS ({_CUST})")
def win_offset(spark, sf):
    w = _by_date()
    return _orders(spark, sf).select("o_orderkey", F.lag("o_totalprice").over(w).alias("a"), F.lag("o_totalprice", 2, -1.0).over(w).alias("b"), F.lead("o_orderkey").over(w).alias("c"))


@query("win_offset_expression", "SELECT n_nationkey, lag(n_name, n_nationkey % 3) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS a FROM nation")
def win_offset_expression(spark, sf):
    return win.shifted(load(spark, sf, "nation").withColumn("k", F.col("n_nationkey") % 3), "n_name", "k", ["n_regionkey"], ["n_nationkey"], [], "a").select("n_nationkey", "a")


@query("win_values", f"SELECT o_orderkey, first_value(o_orderkey) OVER w AS f, last_value(o_orderkey) OVER w AS l, nth_value(o_orderkey, 2) OVER w AS n FROM orders WINDOW w AS ({_CUST} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)")
def win_values(spark, sf):
    w = _by_date().rowsBetween(-2, 1)
    return _orders(spark, sf).select("o_orderkey", F.first_value("o_orderkey").over(w).alias("f"), F.last_value("o_orderkey").over(w).alias("l"), F.nth_value("o_orderkey", 2).over(w).alias("n"))


@query("win_ignore_nulls", f"SELECT o_orderkey, last_value(x IGNORE NULLS) OVER w AS l, first_value(x IGNORE NULLS) OVER w AS f, lag(x IGNORE NULLS) OVER ({_CUST}) AS p FROM (SELECT *, nullif(o_orderstatus, 'O') AS x FROM orders) WINDOW w AS ({_CUST} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def win_ignore_nulls(spark, sf):
    w = _by_date().rowsBetween(W.unboundedPreceding, W.currentRow)
    o = _orders(spark, sf).withColumn("x", F.expr("nullif(o_orderstatus, 'O')"))
    return o.select("o_orderkey", F.last_value("x", True).over(w).alias("l"), F.first_value("x", True).over(w).alias("f"), F.expr("lag(x) IGNORE NULLS OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)").alias("p"))


@query("win_default_frame", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS c, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders")
def win_default_frame(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.count("*").over(W.partitionBy("o_custkey").orderBy("o_orderpriority")).alias("c"), F.count("*").over(W.partitionBy("o_custkey")).alias("n"))


@query("win_rows", f"SELECT o_orderkey, round(sum(o_totalprice) OVER w, 2) AS s, min(o_totalprice) OVER w AS lo, max(o_totalprice) OVER w AS hi, round(avg(o_totalprice) OVER w, 4) AS a FROM orders WINDOW w AS ({_CUST} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")
def win_rows(spark, sf):
    w, p = _by_date().rowsBetween(-3, -1), "o_totalprice"
    return _orders(spark, sf).select("o_orderkey", F.round(F.sum(p).over(w), 2).alias("s"), F.min(p).over(w).alias("lo"), F.max(p).over(w).alias("hi"), F.round(F.avg(p).over(w), 4).alias("a"))


@query("win_range", "SELECT p_partkey, count(*) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 5 PRECEDING AND 2 FOLLOWING) AS n FROM part")
def win_range(spark, sf):
    return load(spark, sf, "part").select("p_partkey", F.count("*").over(W.partitionBy("p_brand").orderBy("p_size").rangeBetween(-5, 2)).alias("n"))


@query("win_range_interval", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS n FROM events")
def win_range_interval(spark, sf):
    views(spark, sf, "events")
    return spark.sql("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '6' HOUR PRECEDING AND CURRENT ROW) AS n FROM events")


@query("win_range_time", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY date_part('epoch', ts::TIME) RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS n FROM events")
def win_range_time(spark, sf):
    e = load(spark, sf, "events").withColumn("t", win.range_on_time(F.date_format("ts", "HH:mm:ss.SSSSSS")))
    return e.select("event_id", F.count("*").over(W.partitionBy("user_id").orderBy("t").rangeBetween(-3_600_000_000, 0)).alias("n"))


@query("win_groups", "SELECT p_partkey, count(*) OVER w AS n, sum(p_size) OVER w::BIGINT AS s FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size GROUPS BETWEEN 1 PRECEDING AND 1 FOLLOWING)")
def win_groups(spark, sf):
    return win.groups_frame(load(spark, sf, "part"), ["p_brand"], ["p_size"], -1, 1, n=F.count("*"), s=F.sum("p_size")).select("p_partkey", "n", "s")


for _exclude in ("current row", "group", "ties", "no others"):

    def _excluded(spark, sf, exclude=_exclude):
        out = win.excluding(load(spark, sf, "part"), ["p_brand"], ["p_size"], ["p_partkey"], "p_size", exclude, -4, 3)
        return out.select("p_partkey", F.col("s").cast("bigint").alias("s"), F.col("c").cast("bigint").alias("c"))

    # peers are equal p_size, while the frame's rows are made unique by p_partkey: the oracle spells the frame out
    _peers = {"current row": "b.p_partkey <> a.p_partkey", "group": "b.p_size <> a.p_size", "ties": "(b.p_size <> a.p_size OR b.p_partkey = a.p_partkey)", "no others": "TRUE"}[_exclude]
    query(
        f"win_exclude_{_exclude.replace(' ', '_')}",
        f"""WITH r AS (SELECT p_partkey, p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS rn FROM part)
        SELECT a.p_partkey, sum(b.p_size)::BIGINT AS s, count(b.p_size) AS c FROM r a LEFT JOIN r b ON b.p_brand = a.p_brand AND b.rn BETWEEN a.rn - 4 AND a.rn + 3 AND {_peers} GROUP BY 1""",
    )(_excluded)


_WIDE = "SELECT p_partkey, p_brand, p_size, CASE p_partkey % 4 WHEN 0 THEN 1e16 WHEN 1 THEN 1.0 WHEN 2 THEN 0.25 END::DOUBLE AS v FROM part"

for _exclude in ("current row", "group", "ties"):
    for _mode, _frame in (("rows", "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"), ("groups", "GROUPS BETWEEN 2 PRECEDING AND 1 FOLLOWING")):

        def _framed(spark, sf, exclude=_exclude, mode=_mode):
            m = F.col("p_partkey") % 4
            t = load(spark, sf, "part").withColumn("v", F.when(m == 0, 1e16).when(m == 1, 1.0).when(m == 2, 0.25))
            ends = (W.unboundedPreceding, W.unboundedFollowing) if mode == "rows" else (-2, 1)
            out = win.framed(t, ["p_brand"], ["p_size"], ["p_partkey"], "v", mode, *ends, exclude, count="c", min="lo", max="hi", sum="s")
            return out.select("p_partkey", "c", "lo", "hi", F.when(F.col("s").isNotNull(), F.isnan("s")).alias("bad"))

        query(
            f"win_exclude_{_mode}_{_exclude.replace(' ', '_')}_doubles",
            f"SELECT p_partkey, count(v) OVER w AS c, min(v) OVER w AS lo, max(v) OVER w AS hi, CASE WHEN count(v) OVER w > 0 THEN FALSE END AS bad FROM ({_WIDE}) WINDOW w AS (PARTITION BY p_brand ORDER BY p_size {_frame} EXCLUDE {_exclude.upper()})",
        )(_framed)


@query("win_exclude_sum_of_doubles", "SELECT * FROM (VALUES (1, 1.0::DOUBLE, 'Infinity'::DOUBLE), (2, 1e16::DOUBLE, 3.0::DOUBLE), (3, NULL, 'Infinity'::DOUBLE)) t(k, s, i)")
def win_exclude_sum_of_doubles(spark, sf):
    t = spark.sql("SELECT * FROM VALUES (1, 1e16D, 2.0D), (2, 1.0D, double('Infinity')), (3, CAST(NULL AS double), 1.0D) AS t(k, v, x)")
    s = win.excluding(t.where("k < 3"), [], ["k"], [], "v", "current row", sum_name="s", count_name="c").select("k", "s")
    s = s.unionAll(win.excluding(t.where("k = 3"), [], ["k"], [], "v", "current row", sum_name="s", count_name="c").select("k", "s"))
    i = win.excluding(t, [], ["k"], [], "x", "current row", sum_name="i", count_name="c").select("k", "i")
    return s.join(i, "k")


@query("win_filter", f"SELECT o_orderkey, count(*) FILTER (WHERE o_orderstatus = 'F') OVER w AS c, sum(o_custkey) FILTER (WHERE o_orderstatus = 'F') OVER w::BIGINT AS s FROM orders WINDOW w AS ({_CUST})")
def win_filter(spark, sf):
    w, f = _by_date(), F.col("o_orderstatus") == "F"
    return _orders(spark, sf).select("o_orderkey", win.filtered(F.count, f).over(w).alias("c"), win.filtered(F.sum, f, F.col("o_custkey")).over(w).alias("s"))


@query("win_over_group", "SELECT o_orderpriority, count(*) AS n, sum(count(*)) OVER (ORDER BY o_orderpriority)::BIGINT AS running FROM orders GROUP BY 1")
def win_over_group(spark, sf):
    views(spark, sf, "orders")
    return spark.sql("SELECT o_orderpriority, count(*) AS n, sum(count(*)) OVER (ORDER BY o_orderpriority) AS running FROM orders GROUP BY 1")


@query("win_string_bool", "SELECT n_nationkey, string_agg(n_name, ',') OVER w AS s, bool_or(n_nationkey > 12) OVER w AS b, count(*) OVER w AS n FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def win_string_bool(spark, sf):
    w = W.partitionBy("n_regionkey").orderBy("n_nationkey").rowsBetween(W.unboundedPreceding, W.currentRow)
    return load(spark, sf, "nation").select("n_nationkey", F.array_join(F.collect_list("n_name").over(w), ",").alias("s"), F.bool_or(F.col("n_nationkey") > 12).over(w).alias("b"), F.count("*").over(w).alias("n"))


@query("win_stat", f"SELECT o_orderkey, round(stddev_pop(o_totalprice) OVER w, 4) AS sp, round(var_pop(o_custkey) OVER w, 4) AS vp FROM orders WINDOW w AS ({_CUST} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")
def win_stat(spark, sf):
    w = _by_date().rowsBetween(-4, 0)
    return _orders(spark, sf).select("o_orderkey", F.round(F.stddev_pop("o_totalprice").over(w), 4).alias("sp"), F.round(F.var_pop("o_custkey").over(w), 4).alias("vp"))


@query("win_named_inherit", "SELECT o_orderkey, count(*) OVER w AS n, row_number() OVER (w ORDER BY o_orderdate, o_orderkey) AS r FROM orders WINDOW w AS (PARTITION BY o_custkey)")
def win_named_inherit(spark, sf):
    w = win.Spec(["o_custkey"])
    return _orders(spark, sf).select("o_orderkey", F.count("*").over(w.window).alias("n"), F.row_number().over(w.extend([F.col("o_orderdate"), F.col("o_orderkey")]).window).cast("bigint").alias("r"))


@query("qualify", f"SELECT o_custkey, o_orderkey, row_number() OVER ({_CUST}) AS rn FROM orders QUALIFY rn = 1")
def qualify_query(spark, sf):
    return qualify(_orders(spark, sf), F.col("rn") == 1, ("rn", F.row_number().over(_by_date()).cast("bigint"))).select("o_custkey", "o_orderkey", "rn")


@query("topk_per_group", "SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 3")
def topk_per_group(spark, sf):
    return top_k_per_group(load(spark, sf, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3).select("c_nationkey", "c_custkey")


@query("dedup_events", "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1")
def dedup_events(spark, sf):
    return top_k_per_group(load(spark, sf, "events"), ["user_id", "event_type"], [F.desc("ts"), F.col("event_id")], 1).select("event_id", "user_id", "event_type")
