"""Predicates, row values, quantified comparisons and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.regex import matches, similar_to
from tessera.functions.strings import ilike, like
from tessera.operators.relational import anti_null_aware, quantified, row_compare, row_in, row_is_not_null, row_is_null
from tessera.plans.registry import query
from tessera.sources.tables import load, views


@query("pred_comparisons", "SELECT o_orderkey, o_totalprice = 1000 AS eq, o_totalprice <> 1000 AS ne, o_orderkey < 50 AS lt, o_orderkey <= 50 AS le, o_orderkey > 50 AS gt, o_orderkey >= 50 AS ge FROM orders")
def pred_comparisons(spark, sf):
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    return load(spark, sf, "orders").select(k, (p == 1000).alias("eq"), (p != 1000).alias("ne"), (k < 50).alias("lt"), (k <= 50).alias("le"), (k > 50).alias("gt"), (k >= 50).alias("ge"))


@query("pred_between_in_like", "SELECT p_partkey FROM part WHERE p_size BETWEEN 5 AND 20 AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#23', 'Brand#34') AND (p_name LIKE '%a%' OR p_type NOT LIKE 'S%')")
def pred_between_in_like(spark, sf):
    p = load(spark, sf, "part")
    return p.where(F.col("p_size").between(5, 20) & F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#23", "Brand#34") & (like(F.col("p_name"), "%a%") | ~like(F.col("p_type"), "S%"))).select("p_partkey")


@query("pred_like_escape", "SELECT k, s LIKE '7!%%' ESCAPE '!' AS esc, s LIKE 'q_z' AS one, s ILIKE 'KIW%' AS ci, s NOT LIKE '%i%' AS no FROM (VALUES (10, 'kiwi'), (20, 'KIWANO'), (30, '7% rate'), (40, 'q_z'), (50, 'qyz'), (60, NULL), (70, '70 rate')) t(k, s)")
def pred_like_escape(spark, sf):
    t, s = spark.sql("SELECT * FROM VALUES (10, 'kiwi'), (20, 'KIWANO'), (30, '7% rate'), (40, 'q_z'), (50, 'qyz'), (60, NULL), (70, '70 rate') AS t(k, s)"), F.col("s")
    return t.select("k", like(s, "7!%%", "!").alias("esc"), like(s, "q_z").alias("one"), ilike(s, "KIW%").alias("ci"), (~like(s, "%i%")).alias("no"))


@query("pred_kleene", "SELECT a, b, a AND b AS both, a OR b AS either, NOT a AS neither FROM (VALUES (TRUE), (FALSE), (NULL)) x(a), (VALUES (TRUE), (FALSE), (NULL)) y(b)")
def pred_kleene(spark, sf):
    x = spark.sql("SELECT * FROM VALUES (TRUE), (FALSE), (CAST(NULL AS boolean)) AS x(a)")
    return x.crossJoin(x.withColumnRenamed("a", "b")).select("a", "b", (F.col("a") & F.col("b")).alias("both"), (F.col("a") | F.col("b")).alias("either"), (~F.col("a")).alias("neither"))


@query("pred_is_distinct", "SELECT o_orderkey, nullif(o_orderstatus, 'O') IS NULL AS n, nullif(o_orderstatus, 'O') IS NOT NULL AS nn, nullif(o_orderstatus, 'O') IS DISTINCT FROM 'F' AS d, nullif(o_orderstatus, 'O') IS NOT DISTINCT FROM NULL AS nd FROM orders")
def pred_is_distinct(spark, sf):
    x = F.expr("nullif(o_orderstatus, 'O')")
    return load(spark, sf, "orders").select("o_orderkey", x.isNull().alias("n"), x.isNotNull().alias("nn"), (~x.eqNullSafe(F.lit("F"))).alias("d"), x.eqNullSafe(F.lit(None)).alias("nd"))


@query("pred_case", "SELECT p_partkey, CASE p_size WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'many' END AS s, CASE WHEN p_retailprice < 950 THEN 'low' WHEN p_retailprice < 1200 THEN 'mid' END AS r FROM part")
def pred_case(spark, sf):
    s, r = F.col("p_size"), F.col("p_retailprice")
    return load(spark, sf, "part").select("p_partkey", F.when(s == 1, "one").when(s == 2, "two").otherwise("many").alias("s"), F.when(r < 950, "low").when(r < 1200, "mid").alias("r"))


_PART_KS = "(SELECT p_partkey, p_size, nullif(p_size, 50) AS v FROM part)"


@query(
    "pred_quantified_any_all",
    f"""SELECT s_suppkey, s_acctbal > ANY (SELECT p_retailprice FROM part) AS any_gt, s_acctbal >= ALL (SELECT p_retailprice FROM part) AS all_ge, s_nationkey < ANY (SELECT v FROM {_PART_KS} WHERE p_size > 44) AS any_null,
    s_nationkey = ANY (SELECT p_size FROM part WHERE p_size < 10) AS any_eq, s_nationkey <> ALL (SELECT p_size FROM part WHERE p_size < 10) AS all_ne, s_nationkey > ALL (SELECT p_size FROM part WHERE p_size < 0) AS all_empty FROM supplier""",
)
def pred_quantified_any_all(spark, sf):
    p = load(spark, sf, "part").withColumn("v", F.expr("nullif(p_size, 50)"))
    s = load(spark, sf, "supplier")
    few = p.where("p_size < 10")
    s = quantified(s, F.col("s_acctbal"), ">", "ANY", p, "p_retailprice", "any_gt")
    s = quantified(s, F.col("s_acctbal"), ">=", "ALL", p, "p_retailprice", "all_ge")
    s = quantified(s, F.col("s_nationkey"), "<", "ANY", p.where("p_size > 44"), "v", "any_null")
    s = quantified(s, F.col("s_nationkey"), "=", "ANY", few, "p_size", "any_eq")
    s = quantified(s, F.col("s_nationkey"), "<>", "ALL", few, "p_size", "all_ne")
    s = quantified(s, F.col("s_nationkey"), ">", "ALL", p.where("p_size < 0"), "p_size", "all_empty")
    return s.select("s_suppkey", "any_gt", "all_ge", "any_null", "any_eq", "all_ne", "all_empty")


_RV = "(VALUES (21, 4, 'm', 5), (22, 4, 'p', 6), (23, 9, 'm', 7), (24, NULL, NULL, 8), (25, 9, NULL, 9), (26, NULL, 'q', 1), (27, 12, 't', 2)) t(id, k1, k2, v)"


def _rv(spark):
    return spark.sql("SELECT * FROM VALUES (21, 4, 'm', 5), (22, 4, 'p', 6), (23, 9, 'm', 7), (24, NULL, NULL, 8), (25, 9, NULL, 9), (26, NULL, 'q', 1), (27, 12, 't', 2) AS t(id, k1, k2, v)")


@query(
    "pred_row_compare",
    f"""SELECT id, k1 = 9 AND k2 = 'm' AS eq, NOT (k1 = 9 AND k2 = 'm') AS ne, k1 < 9 OR (k1 = 9 AND k2 < 'p') AS lt, k1 > 4 OR (k1 = 4 AND k2 >= 'p') AS ge,
    k1 IS NULL AND k2 IS NULL AS all_null, k1 IS NOT NULL AND k2 IS NOT NULL AS none_null, (k1 = 4 AND k2 = 'm') OR (k1 = 12 AND k2 = 't') OR (k1 = 9 AND k2 = CAST(NULL AS VARCHAR)) AS listed FROM {_RV}""",
)
def pred_row_compare(spark, sf):
    row = [F.col("k1"), F.col("k2")]
    at = lambda a, b: [F.lit(a), F.lit(b)]
    return _rv(spark).select("id", row_compare(row, "=", at(9, "m")).alias("eq"), row_compare(row, "<>", at(9, "m")).alias("ne"), row_compare(row, "<", at(9, "p")).alias("lt"), row_compare(row, ">=", at(4, "p")).alias("ge"), row_is_null(row).alias("all_null"), row_is_not_null(row).alias("none_null"), row_in(row, [(4, "m"), (12, "t"), (F.lit(9), F.lit(None).cast("string"))]).alias("listed"))


@query("pred_row_in_subquery", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT l_orderkey, min(l_linenumber) FROM lineitem WHERE l_quantity > 45 GROUP BY l_orderkey)")
def pred_row_in_subquery(spark, sf):
    li = load(spark, sf, "lineitem")
    keys = li.where("l_quantity > 45").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("l_linenumber"))
    return li.select("l_orderkey", "l_linenumber").join(keys, ["l_orderkey", "l_linenumber"], "left_semi")


@query("pred_row_of_subquery", "SELECT s_suppkey FROM supplier, (SELECT max(n_regionkey) AS x, min(n_regionkey) AS y FROM nation) q WHERE s_nationkey > x OR (s_nationkey = x AND s_suppkey > y)")
def pred_row_of_subquery(spark, sf):
    one = load(spark, sf, "nation").agg(F.max("n_regionkey").alias("x"), F.min("n_regionkey").alias("y"))
    s = load(spark, sf, "supplier").crossJoin(F.broadcast(one))  # one row
    return s.where(row_compare([F.col("s_nationkey"), F.col("s_suppkey")], ">", [F.col("x"), F.col("y")])).select("s_suppkey")


@query("pred_regex_similar", "SELECT p_partkey, regexp_matches(p_type, 'BRASS|STEEL') AS m, regexp_matches(p_name, '(?i)A.*E') AS ci, NOT regexp_matches(p_brand, '[12]$') AS no, p_brand SIMILAR TO 'Brand#(1|2)[0-9]' AS sim FROM part")
def pred_regex_similar(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_partkey", matches(F.col("p_type"), "BRASS|STEEL").alias("m"), matches(F.col("p_name"), "A.*E", "i").alias("ci"), (~matches(F.col("p_brand"), "[12]$")).alias("no"), similar_to(F.col("p_brand"), "Brand#(1|2)[0-9]").alias("sim"))


@query("in_subquery", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def in_subquery(spark, sf):
    views(spark, sf, "customer", "orders")
    return spark.sql("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")


@query("not_in_null_aware", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def not_in_null_aware(spark, sf):
    return anti_null_aware(load(spark, sf, "customer"), "c_custkey", load(spark, sf, "orders"), "o_custkey").select("c_custkey")


@query("not_in_with_null", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT nullif(o_custkey, 1) FROM orders)")
def not_in_with_null(spark, sf):
    o = load(spark, sf, "orders").select(F.expr("nullif(o_custkey, 1)").alias("k"))
    return anti_null_aware(load(spark, sf, "customer"), "c_custkey", o, "k").select("c_custkey")


@query("correlated_exists", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')")
def correlated_exists(spark, sf):
    o = load(spark, sf, "orders").where("o_orderstatus = 'F'")
    return load(spark, sf, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("exists_item", "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has, NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000) AS no_big FROM customer")
def exists_item(spark, sf):
    views(spark, sf, "customer", "orders")
    return spark.sql("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has, NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000) AS no_big FROM customer")


@query("scalar_subquery", "SELECT n_nationkey, (SELECT max(o_orderkey) FROM orders) AS top, (SELECT r_name FROM region WHERE r_regionkey = 99) AS nothing FROM nation")
def scalar_subquery(spark, sf):
    views(spark, sf, "nation", "orders", "region")
    return spark.sql("SELECT n_nationkey, (SELECT max(o_orderkey) FROM orders) AS top, (SELECT r_name FROM region WHERE r_regionkey = 99) AS nothing FROM nation")


@query("correlated_scalar", "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS top FROM customer")
def correlated_scalar(spark, sf):
    per = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    return load(spark, sf, "customer").join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), "top")


@query("outer_level_aggregate", "SELECT o_orderpriority, count(*) AS n, (SELECT count(*) FROM nation WHERE n_nationkey < q.n % 25) AS below FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) q GROUP BY o_orderpriority, q.n")
def outer_level_aggregate(spark, sf):
    q = load(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    inner = q.join(load(spark, sf, "nation"), F.col("n_nationkey") < F.col("n") % 25, "left").groupBy("o_orderpriority", "n").agg(F.count("n_nationkey").alias("below"))
    return inner.select("o_orderpriority", F.lit(1).cast("bigint").alias("n"), "below")
