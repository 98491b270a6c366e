"""Queries over aggregation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as agg
from tessera.operators.relational import distinct_on
from tessera.plans.registry import query
from tessera.sources.tables import load, views


@query(
    "groupby_agg",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
    round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_quantity), 6) AS avg_qty, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY 1, 2""",
)
def groupby_agg(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.count("*").alias("count_order"),
    )


@query("groupby_expr", "SELECT extract(year FROM o_orderdate)::BIGINT AS y, round(sum(o_totalprice * 2), 1) AS total, count(*) AS n FROM orders GROUP BY 1")
def groupby_expr(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("y")).agg(F.round(F.sum(F.col("o_totalprice") * 2), 1).alias("total"), F.count("*").alias("n"))


@query("groupby_month", "SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS m, count(*) AS n FROM orders GROUP BY 1")
def groupby_month(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("m")).agg(F.count("*").alias("n"))


@query("groupby_alias_ordinal", "SELECT upper(o_orderstatus) AS st, count(*) AS n FROM orders GROUP BY st")
def groupby_alias_ordinal(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy(F.upper("o_orderstatus").alias("st")).agg(F.count("*").alias("n"))


@query("groupby_null_key", "SELECT nullif(o_orderstatus, 'O') AS k, count(*) AS n, count(nullif(o_orderstatus, 'O')) AS c FROM orders GROUP BY 1")
def groupby_null_key(spark, sf_dir):
    return load(spark, sf_dir, "orders").withColumn("k", F.expr("nullif(o_orderstatus, 'O')")).groupBy("k").agg(F.count("*").alias("n"), F.count("k").alias("c"))


@query("groupby_global", "SELECT count(*) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi, count(DISTINCT l_suppkey) AS d FROM lineitem")
def groupby_global(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"), F.count_distinct("l_suppkey").alias("d"))


@query("groupby_global_empty", "SELECT count(*) AS n, sum(l_quantity) AS s, max(l_shipdate) AS d FROM lineitem WHERE l_orderkey < 0")
def groupby_global_empty(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").where("l_orderkey < 0").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("s"), F.max("l_shipdate").alias("d"))


@query("agg_sum_types", "SELECT l_returnflag, sum(l_linenumber)::BIGINT AS si, sum(CAST(l_quantity AS DECIMAL(10,2)))::DECIMAL(38,2) AS sn, round(avg(l_linenumber), 9) AS a FROM lineitem GROUP BY 1")
def agg_sum_types(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(agg.sum_int("l_linenumber").alias("si"), agg.sum_numeric(F.col("l_quantity").cast("decimal(10,2)"), 2).alias("sn"), F.round(agg.avg("l_linenumber"), 9).alias("a"))


@query("agg_distinct", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS d, sum(DISTINCT o_custkey)::BIGINT AS s FROM orders GROUP BY 1")
def agg_distinct(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("d"), F.sum_distinct("o_custkey").alias("s"))


@query("agg_count_distinct_multi", "SELECT count(DISTINCT (o_orderstatus, o_orderpriority)) AS n FROM orders WHERE nullif(o_orderstatus, 'O') IS NOT NULL")
def agg_count_distinct_multi(spark, sf_dir):
    return load(spark, sf_dir, "orders").agg(F.count_distinct(F.expr("nullif(o_orderstatus, 'O')"), F.col("o_orderpriority")).alias("n"))


@query("agg_filter", "SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS big, sum(l_linenumber) FILTER (WHERE l_discount > 0.05)::BIGINT AS s, count(*) AS n FROM lineitem GROUP BY 1")
def agg_filter(spark, sf_dir):
    views(spark, sf_dir, "lineitem")
    return spark.sql("SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS big, sum(l_linenumber) FILTER (WHERE l_discount > 0.05) AS s, count(*) AS n FROM lineitem GROUP BY 1")


@query("having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 15 AND max(o_totalprice) > 100000")
def having(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top")).where("n > 15 AND top > 100000").select("o_custkey", "n")


@query("having_global", "SELECT count(*) AS n FROM orders HAVING count(*) > 1")
def having_global(spark, sf_dir):
    return load(spark, sf_dir, "orders").agg(F.count("*").alias("n")).where("n > 1")


@query("agg_stat", "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS ss, round(stddev_pop(l_quantity), 6) AS sp, round(var_samp(l_quantity), 6) AS vs, round(var_pop(l_quantity), 6) AS vp FROM lineitem GROUP BY 1")
def agg_stat(spark, sf_dir):
    q = "l_quantity"
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(F.stddev_samp(q), 6).alias("ss"), F.round(F.stddev_pop(q), 6).alias("sp"), F.round(F.var_samp(q), 6).alias("vs"), F.round(F.var_pop(q), 6).alias("vp"))


@query("agg_stat_single", "SELECT n_nationkey, stddev_samp(n_regionkey) AS ss, stddev_pop(n_regionkey) AS sp, var_samp(n_regionkey) AS vs FROM nation GROUP BY 1")
def agg_stat_single(spark, sf_dir):
    return load(spark, sf_dir, "nation").groupBy("n_nationkey").agg(F.expr("try_divide(0D, 0D)").alias("x"), F.stddev_samp("n_regionkey").alias("ss"), F.stddev_pop("n_regionkey").alias("sp"), F.var_samp("n_regionkey").alias("vs")).drop("x")


@query("agg_percentile", "SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.25), 4) AS c, quantile_disc(o_totalprice, 0.4) AS d, quantile_disc(o_orderpriority, 0.5) AS s, round(median(o_totalprice), 4) AS m FROM orders GROUP BY 1")
def agg_percentile(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    numbers = o.groupBy("o_orderstatus").agg(
        F.round(F.expr("percentile_cont(0.25) WITHIN GROUP (ORDER BY o_totalprice)"), 4).alias("c"),
        F.expr("percentile_disc(0.4) WITHIN GROUP (ORDER BY o_totalprice)").alias("d"),
        F.round(F.median("o_totalprice"), 4).alias("m"),
    )
    return numbers.join(agg.percentile_disc(o, ["o_orderstatus"], "o_orderpriority", 0.5, "s"), "o_orderstatus")


@query("agg_mode", "SELECT k AS o_orderpriority, v AS m FROM (SELECT o_orderpriority AS k, l AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, l) AS r FROM (SELECT o_orderpriority, extract(month FROM o_orderdate)::INTEGER AS l, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE r = 1")
def agg_mode(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(agg.mode(F.month("o_orderdate")).alias("m"))


@query("agg_string", "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name DESC) AS down, string_agg(n_name, '' ORDER BY n_nationkey) AS plain, string_agg(DISTINCT substr(n_name, 1, 1), '|' ORDER BY substr(n_name, 1, 1)) AS d FROM nation GROUP BY 1")
def agg_string(spark, sf_dir):
    views(spark, sf_dir, "nation")
    return spark.sql("SELECT n_regionkey, listagg(n_name, ', ') WITHIN GROUP (ORDER BY n_name DESC) AS down, listagg(n_name) WITHIN GROUP (ORDER BY n_nationkey) AS plain, listagg(DISTINCT substr(n_name, 1, 1), '|') WITHIN GROUP (ORDER BY substr(n_name, 1, 1)) AS d FROM nation GROUP BY 1")


@query("agg_string_row_separator", "SELECT n_regionkey, substr(string_agg(CASE WHEN n_nationkey % 2 = 0 THEN '-' ELSE '+' END || n_name, '' ORDER BY n_nationkey), 2) AS s FROM nation GROUP BY 1")
def agg_string_row_separator(spark, sf_dir):
    sep = F.when(F.col("n_nationkey") % 2 == 0, "-").otherwise("+")
    return load(spark, sf_dir, "nation").groupBy("n_regionkey").agg(agg.string_agg("n_name", sep, [F.col("n_nationkey")]).alias("s"))


@query("agg_bool", "SELECT o_orderpriority, bool_or(o_totalprice > 300000) AS o, bool_and(o_totalprice > 1000) AS a FROM orders GROUP BY 1")
def agg_bool(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.bool_or(F.col("o_totalprice") > 300000).alias("o"), F.bool_and(F.col("o_totalprice") > 1000).alias("a"))


@query("agg_any_value", "SELECT n_regionkey, any_value(n_regionkey * 2)::INTEGER AS v FROM nation GROUP BY 1")
def agg_any_value(spark, sf_dir):
    return load(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.any_value(F.col("n_regionkey") * 2, ignoreNulls=True).alias("v"))


@query("agg_min_max_nan", "SELECT min(x) AS lo, max(x) AS hi, min(d) AS first_day, max(s) AS last_text FROM (VALUES (1.5::DOUBLE, DATE '2024-01-02', 'b'), ('NaN'::DOUBLE, DATE '2024-01-01', 'a'), (NULL, NULL, NULL), ('-Infinity'::DOUBLE, NULL, 'B')) t(x, d, s)")
def agg_min_max_nan(spark, sf_dir):
    t = spark.sql("SELECT * FROM VALUES (1.5D, DATE '2024-01-02', 'b'), (double('NaN'), DATE '2024-01-01', 'a'), (NULL, NULL, NULL), (double('-Infinity'), NULL, 'B') AS t(x, d, s)")
    return t.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.min("d").alias("first_day"), F.max("s").alias("last_text"))


@query("agg_ungrouped_column", "SELECT n_regionkey, arg_min(n_name, n_nationkey) AS n FROM nation GROUP BY 1")
def agg_ungrouped_column(spark, sf_dir):
    return load(spark, sf_dir, "nation").groupBy("n_regionkey").agg(agg.ungrouped("n_name", "n_nationkey").alias("n"))


@query("agg_json", """SELECT n_regionkey, '[' || string_agg('"' || n_name || '"', ', ' ORDER BY n_nationkey) || ']' AS names, '{ ' || string_agg('"' || n_name || '" : ' || n_nationkey, ', ' ORDER BY n_name) || ' }' AS keys FROM nation GROUP BY 1""")
def agg_json(spark, sf_dir):
    return load(spark, sf_dir, "nation").groupBy("n_regionkey").agg(agg.json_agg("n_name", [F.col("n_nationkey")]).alias("names"), agg.json_object_agg("n_name", "n_nationkey").alias("keys"))


@query("agg_exact_sum", "SELECT l_returnflag, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS s FROM lineitem GROUP BY 1")
def agg_exact_sum(spark, sf_dir):
    out = agg.exact_sum(load(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", "s")
    return out.withColumn("s", F.round("s", 2))


_MIXED = "SELECT n_regionkey AS k, n_nationkey AS i, CASE n_nationkey % 5 WHEN 0 THEN 1e16 WHEN 1 THEN 1.0 WHEN 2 THEN -1e16 WHEN 3 THEN 0.1 ELSE 2.5 END::DOUBLE AS v FROM nation"


@query("agg_exact_order", f"SELECT k, sum(v::DECIMAL(38,4))::DOUBLE AS s, (sum(v::DECIMAL(38,4)) / count(v))::DOUBLE AS a FROM ({_MIXED}) GROUP BY k")
def agg_exact_order(spark, sf_dir):
    m = F.col("n_nationkey") % 5
    v = F.when(m == 0, 1e16).when(m == 1, 1.0).when(m == 2, -1e16).when(m == 3, 0.1).otherwise(2.5)
    t = load(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("k"), v.alias("v"))
    return agg.exact_sum(t, ["k"], "v", "s").join(agg.exact_avg(t, ["k"], "v", "a"), "k")


@query("agg_exact_variance", "SELECT l_returnflag, round(var_samp(l_quantity), 6) AS v, round(stddev_pop(l_quantity), 6) AS s FROM lineitem GROUP BY 1")
def agg_exact_variance(spark, sf_dir):
    t, k = load(spark, sf_dir, "lineitem"), ["l_returnflag"]
    both = agg.exact_variance(t, k, "l_quantity", "v").join(agg.exact_variance(t, k, "l_quantity", "s", population=True, root=True), k)
    return both.select("l_returnflag", F.round("v", 6).alias("v"), F.round("s", 6).alias("s"))


@query("agg_string_empty", "SELECT k, string_agg(v, ',') AS s FROM (VALUES (1, ''), (2, NULL), (3, 'a')) t(k, v) GROUP BY k")
def agg_string_empty(spark, sf_dir):
    return spark.sql("SELECT * FROM VALUES (1, ''), (2, NULL), (3, 'a') AS t(k, v)").groupBy("k").agg(agg.string_agg("v", ",").alias("s"))


@query("agg_json_text", """SELECT n_regionkey, '[' || string_agg('"p\\",' || lower(n_name) || '\\""', ', ' ORDER BY n_nationkey) || ']' AS a, '{' || string_agg('"' || n_name || '": ' || n_nationkey, ', ' ORDER BY length(n_name), n_name) || '}' AS o FROM nation GROUP BY 1""")
def agg_json_text(spark, sf_dir):
    said = F.concat(F.lit('p",'), F.lower("n_name"), F.lit('"'))
    return load(spark, sf_dir, "nation").withColumn("said", said).groupBy("n_regionkey").agg(agg.json_agg("said", [F.col("n_nationkey")]).alias("a"), agg.jsonb_object_agg("n_name", "n_nationkey").alias("o"))


_OS = "FROM orders JOIN customer ON o_custkey = c_custkey"


def _oc(spark, sf_dir):
    return load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))


@query("rollup", f"SELECT o_orderstatus, c_mktsegment, count(*) AS n, grouping(o_orderstatus, c_mktsegment)::INTEGER AS g {_OS} GROUP BY ROLLUP (o_orderstatus, c_mktsegment)")
def rollup(spark, sf_dir):
    return _oc(spark, sf_dir).rollup("o_orderstatus", "c_mktsegment").agg(F.count("*").alias("n"), agg.grouping_bits("o_orderstatus", "c_mktsegment").alias("g"))


@query("cube", f"SELECT o_orderstatus, c_mktsegment, count(*) AS n {_OS} GROUP BY CUBE (o_orderstatus, c_mktsegment)")
def cube(spark, sf_dir):
    return _oc(spark, sf_dir).cube("o_orderstatus", "c_mktsegment").agg(F.count("*").alias("n"))


@query("grouping_sets", f"SELECT o_orderstatus, c_mktsegment, count(*) AS n {_OS} GROUP BY GROUPING SETS ((o_orderstatus, c_mktsegment), (c_mktsegment), (c_mktsegment), ())")
def grouping_sets(spark, sf_dir):
    return _oc(spark, sf_dir).groupingSets([[F.col("o_orderstatus"), F.col("c_mktsegment")], [F.col("c_mktsegment")], [F.col("c_mktsegment")], []], "o_orderstatus", "c_mktsegment").agg(F.count("*").alias("n"))


@query("grouping_bits", "SELECT n_regionkey, k, count(*) AS n, grouping(n_regionkey, k)::INTEGER AS g, grouping(k)::INTEGER AS gk FROM (SELECT n_regionkey, nullif(n_nationkey % 3, 0) AS k FROM nation) GROUP BY CUBE (n_regionkey, k)")
def grouping_bits(spark, sf_dir):
    n = load(spark, sf_dir, "nation").select("n_regionkey", F.expr("nullif(n_nationkey % 3, 0) AS k"))
    return n.cube("n_regionkey", "k").agg(F.count("*").alias("n"), agg.grouping_bits("n_regionkey", "k").alias("g"), agg.grouping_bits("k").alias("gk"))


@query("grouping_sets_empty_input", "SELECT n_regionkey, count(*) AS n FROM nation WHERE n_nationkey < 0 GROUP BY ROLLUP (n_regionkey)")
def grouping_sets_empty_input(spark, sf_dir):
    n = load(spark, sf_dir, "nation").where("n_nationkey < 0")
    return agg.with_grand_total(n.groupBy("n_regionkey").agg(F.count("*").alias("n")), n.agg(F.count("*").alias("n")))


@query("select_distinct", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def select_distinct(spark, sf_dir):
    return load(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey").distinct()


@query("distinct_on", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def distinct_on_query(spark, sf_dir):
    return distinct_on(load(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")
