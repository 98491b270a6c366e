"""Set operations, common table expressions and recursion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.recursive import native, ordered, path_text, recursive_union, search_order, walk
from tessera.operators.relational import set_operation
from tessera.plans.registry import query
from tessera.sources.tables import load, views


def _keys(spark, sf):
    return load(spark, sf, "customer").select("c_nationkey"), load(spark, sf, "supplier").select("s_nationkey")


for _kind in ("union", "intersect", "except"):
    for _all in (False, True):

        def _op(spark, sf, kind=_kind, every=_all):
            a, b = _keys(spark, sf)
            return set_operation(a, b, kind, every).toDF("k")

        query(f"{_kind}_{'all' if _all else 'distinct'}", f"SELECT c_nationkey AS k FROM customer {_kind.upper()} {'ALL' if _all else ''} SELECT s_nationkey FROM supplier")(_op)


@query("setop_nested", "(SELECT n_nationkey AS k FROM nation ORDER BY n_nationkey DESC LIMIT 5) UNION (SELECT r_regionkey FROM region INTERSECT SELECT n_regionkey FROM nation)")
def setop_nested(spark, sf):
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    top = n.select(F.col("n_nationkey").alias("k")).orderBy(F.desc("k")).limit(5)
    return set_operation(top, set_operation(r.select("r_regionkey"), n.select("n_regionkey"), "intersect"), "union")


@query("setop_nulls_equal", "SELECT nullif(n_regionkey, 1) AS k FROM nation INTERSECT SELECT nullif(r_regionkey, 1) FROM region")
def setop_nulls_equal(spark, sf):
    return set_operation(load(spark, sf, "nation").selectExpr("nullif(n_regionkey, 1) AS k"), load(spark, sf, "region").selectExpr("nullif(r_regionkey, 1)"), "intersect")


@query("union_widening", "SELECT n_nationkey::DOUBLE AS x FROM nation UNION ALL SELECT s_acctbal FROM supplier")
def union_widening(spark, sf):
    return set_operation(load(spark, sf, "nation").selectExpr("n_nationkey AS x"), load(spark, sf, "supplier").select("s_acctbal"), "union", True)


@query("cte", "WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), top AS (SELECT max(n) AS m FROM big) SELECT o_custkey, n FROM big, top WHERE n > m / 2")
def cte(spark, sf):
    views(spark, sf, "orders")
    return spark.sql("WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), top AS (SELECT max(n) AS m FROM big) SELECT o_custkey, n FROM big, top WHERE n > m / 2")


@query("derived_table_aliases", "SELECT x, count(*) AS n FROM (SELECT n_regionkey, n_name FROM nation) AS t(x, y) GROUP BY x")
def derived_table_aliases(spark, sf):
    return load(spark, sf, "nation").select("n_regionkey", "n_name").toDF("x", "y").groupBy("x").agg(F.count("*").alias("n"))


@query("cte_recursive", "WITH RECURSIVE t(n, f) AS (SELECT 1::BIGINT, 1::BIGINT UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 15) SELECT n, f FROM t")
def cte_recursive(spark, sf):
    return native(spark, "WITH RECURSIVE t(n, f) AS (SELECT 1L, 1L UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 15) SELECT n, f FROM t")


@query("cte_recursive_join", "WITH RECURSIVE r(k, d) AS (SELECT n_nationkey, 0 FROM nation WHERE n_nationkey = 1 UNION ALL SELECT n.n_nationkey, d + 1 FROM r JOIN nation n ON n.n_nationkey = r.k * 2) SELECT k, d FROM r")
def cte_recursive_join(spark, sf):
    views(spark, sf, "nation")
    return native(spark, "WITH RECURSIVE r(k, d) AS (SELECT n_nationkey, 0 FROM nation WHERE n_nationkey = 1 UNION ALL SELECT n.n_nationkey, d + 1 FROM r JOIN nation n ON n.n_nationkey = r.k * 2) SELECT k, d FROM r")


#: Edges with a cycle 4 -> 7 -> 9 -> 4 on the way from 1.
_EDGES = "(VALUES (1, 4), (4, 7), (7, 9), (9, 4), (7, 2), (2, 8), (11, 12)) e(src, dst)"


def _edges(spark):
    return spark.sql("SELECT * FROM VALUES (1, 4), (4, 7), (7, 9), (9, 4), (7, 2), (2, 8), (11, 12) AS e(src, dst)")


@query("cte_recursive_union", f"WITH RECURSIVE r(n) AS (SELECT 1 UNION SELECT dst FROM r JOIN {_EDGES} ON src = n) SELECT n FROM r")
def cte_recursive_union(spark, sf):
    e = _edges(spark)
    return recursive_union(spark.range(1).select(F.lit(1).alias("n")), lambda new: new.join(e, F.col("n") == F.col("src")).select("dst"))


@query("recursive_reach_nations", "WITH RECURSIVE e AS (SELECT n_nationkey AS a, (n_nationkey * 7 + 3) % 25 AS b FROM nation), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b) SELECT a, count(*) AS n FROM r GROUP BY a")
def recursive_reach_nations(spark, sf):
    e = load(spark, sf, "nation").selectExpr("n_nationkey AS a", "(n_nationkey * 7 + 3) % 25 AS b")
    step = e.select(F.col("a").alias("x"), F.col("b").alias("y"))
    return recursive_union(e, lambda new: new.join(step, F.col("b") == F.col("x")).select("a", "y")).groupBy("a").agg(F.count("*").alias("n"))


_WALK = f"WITH RECURSIVE w(n, depth, path, is_cycle) AS (SELECT 1, 0, [1], FALSE UNION ALL SELECT dst, depth + 1, path || [dst], list_contains(path, dst) FROM w JOIN {_EDGES} ON src = n WHERE NOT is_cycle)"


def _walk(spark):
    return walk(spark, spark.range(1).select(F.lit(1).alias("n")), _edges(spark), "src", "dst", "n")


@query("cte_cycle", f"{_WALK} SELECT n, depth, is_cycle, '{{' || array_to_string(list_transform(path, lambda x: '(' || x || ')'), ',') || '}}' AS path FROM w")
def cte_cycle(spark, sf):
    return _walk(spark).select("n", "depth", "is_cycle", path_text("path").alias("path"))


@query("cte_search_depth", f"{_WALK} SELECT n, row_number() OVER (ORDER BY path) AS ord FROM w WHERE NOT is_cycle")
def cte_search_depth(spark, sf):
    return ordered(_walk(spark).where("NOT is_cycle").withColumn("key", search_order("path")), "key", "ord").select("n", "ord")


@query("cte_search_breadth", f"{_WALK} SELECT n, row_number() OVER (ORDER BY len(path), path) AS ord FROM w WHERE NOT is_cycle")
def cte_search_breadth(spark, sf):
    return ordered(_walk(spark).where("NOT is_cycle").withColumn("key", search_order("path", True)), "key", "ord").select("n", "ord")
