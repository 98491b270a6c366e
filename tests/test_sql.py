"""The SQL front end: translation and statements, with hand-written results."""

import pytest

from tessera.sql import Engine
from tests.oracle import connect

SF = "/root/testdata/sf0.001"

#: Queries that DuckDB runs as they are: both must give the same rows.
SAME = [
    "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders QUALIFY rn = 1",
    "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey",
    "SELECT n_name FROM nation ORDER BY n_nationkey FETCH FIRST 3 ROWS ONLY",
    "SELECT o_orderkey, nullif(o_orderstatus, 'O') AS x FROM orders ORDER BY 2 DESC, 1 LIMIT 20 OFFSET 2",
    "SELECT p_partkey FROM part WHERE p_brand SIMILAR TO 'Brand#(1|2)[0-9]' AND p_size::VARCHAR <> '3'",
    "SELECT event_id, props ->> 'k' AS k FROM events",
    "SELECT c_custkey FROM customer WHERE c_custkey = ANY (SELECT o_custkey FROM orders) AND c_nationkey <> ALL (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)",
    "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name DESC) AS s FROM nation GROUP BY n_regionkey",
    "SELECT concat(n_name, NULL, '-', n_regionkey) AS c, left(n_name, -2) AS l, right(n_name, 3) AS r, strpos(n_name, 'A')::BIGINT AS p, position('A' IN n_name)::BIGINT AS q FROM nation",
    "SELECT $$it's$$ AS a, 1::BIGINT AS b, CAST('x' AS VARCHAR) AS c, TRY_CAST('x' AS INTEGER) AS d",
    "WITH RECURSIVE t(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM t WHERE n < 5) SELECT n FROM t",
    "SELECT n_regionkey FROM nation INTERSECT SELECT r_regionkey FROM region EXCEPT SELECT 2",
    "SELECT substring(n_name FROM 2 FOR 3) AS s, regexp_replace(n_name, '([A-Z])([A-Z])', '\\2\\1') AS f, regexp_replace(n_name, 'A', '_', 'g') AS g FROM nation",
    "SELECT o_orderpriority AS p, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM orders GROUP BY p HAVING count(*) > 10",
    "SELECT c.c_custkey, q.n FROM customer c, LATERAL (SELECT count(*) AS n FROM orders o WHERE o.o_custkey = c.c_custkey) q WHERE c.c_custkey < 50",
    "SELECT extract(year FROM o_orderdate)::BIGINT AS y, extract(dow FROM o_orderdate)::BIGINT AS d, count(*) AS n FROM orders GROUP BY 1, 2",
    "SELECT a.n_name FROM nation a WHERE EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = a.n_nationkey) AND NOT a.n_name LIKE 'Z%'",
    "(SELECT 1 AS x) UNION ALL (SELECT 2 ORDER BY 1 LIMIT 1)",
]


@pytest.fixture(scope="module")
def engine(spark):
    e = Engine(spark)
    for t in "nation region customer orders part supplier events".split():
        spark.read.parquet(f"{SF}/{t}.parquet").createOrReplaceTempView(t)
    yield e
    spark.conf.unset("spark.sql.timestampType")


@pytest.mark.parametrize("sql", SAME)
def test_same_as_duckdb(engine, sql):
    got = sorted(map(repr, (tuple(r) for r in engine.sql(sql).collect())))
    want = sorted(map(repr, connect(SF).sql(sql).fetchall()))
    assert got == want


def test_operators(engine):
    q = "SELECT 'a\nB' ~ 'a.B' AS a, 'x' !~ 'y' AS b, 'ABC' ~* 'b' AS c, log(100) AS d, 'ab' || NULL AS e, '{\"a\":{\"b\":[1,2]}}' #>> '{a,b,1}' AS f"
    assert tuple(engine.sql(q).first()) == (True, True, True, 2.0, None, "2")
    assert engine.sql("SELECT CAST('x' AS INTEGER DEFAULT -1 ON CONVERSION ERROR) AS v").first()[0] == -1
    assert [r[0] for r in engine.sql("SELECT generate_series FROM generate_series(1, 3)").collect()] == [1, 2, 3]
    assert engine.sql("SELECT n_name FROM nation WHERE n_nationkey = $1", [3]).count() == 1
    assert engine.sql("SELECT n_name FROM nation WHERE n_nationkey = ? OR n_nationkey = ?", [3, 4]).count() == 2
    assert engine.sql("SELECT 1 > ANY (SELECT 2) AS a, 3 > ANY (SELECT 2) AS b").first()[:] == (False, True)


def test_statements(engine):
    run = lambda s: sorted((tuple(r) for r in engine.sql(s).collect()), key=repr)
    engine.sql("""CREATE TABLE t (id INTEGER NOT NULL, name VARCHAR(5) DEFAULT 'new', qty INTEGER CHECK (qty >= 0), PRIMARY KEY (id));
        INSERT INTO t VALUES (1, 'a', 10), (2, 'b', 20), (3, DEFAULT, 30)""")
    assert run("SELECT * FROM t") == [(1, "a", 10), (2, "b", 20), (3, "new", 30)]
    assert run("UPDATE t SET qty = qty + 1, name = upper(name) WHERE id < 3 RETURNING id, qty") == [(1, 11), (2, 21)]
    with pytest.raises(Exception, match="check constraint"):
        engine.sql("UPDATE t SET qty = -1")
    with pytest.raises(Exception, match="null value"):
        engine.sql("INSERT INTO t (name) VALUES ('x')")
    assert run("SELECT count(*) FROM t") == [(3,)]
    engine.sql("CREATE TABLE s AS SELECT * FROM VALUES (2, 200, 'upd'), (3, 0, 'del'), (7, 70, 'ins') AS v(id, q, op)")
    assert run("UPDATE t SET qty = x.q FROM s AS x WHERE t.id = x.id AND x.op = 'upd' RETURNING id, qty") == [(2, 200)]
    merged = run("""MERGE INTO t USING s ON t.id = s.id WHEN MATCHED AND s.op = 'del' THEN DELETE WHEN MATCHED THEN UPDATE SET qty = t.qty + 1
        WHEN NOT MATCHED AND s.op = 'ins' THEN INSERT (id, qty) VALUES (s.id, s.q) RETURNING merge_action(), id""")
    assert merged == [("DELETE", 3), ("INSERT", 7), ("UPDATE", 2)]
    assert run("SELECT * FROM t") == [(1, "A", 11), (2, "B", 201), (7, "new", 70)]
    assert run("DELETE FROM t USING s WHERE t.id = s.id AND s.op = 'ins' RETURNING id") == [(7,)]
    assert run("DELETE FROM t WHERE id IN (SELECT id FROM s) ") == [(1,)]
    engine.sql("ALTER TABLE t ADD COLUMN note TEXT DEFAULT 'n', RENAME COLUMN qty TO amount; COMMENT ON TABLE t IS 'a table'; CREATE VIEW v AS SELECT id, note FROM t")
    assert run("SELECT * FROM v") == [(1, "n")]
    assert engine.tables["t"].comment == "a table"
    engine.sql("TRUNCATE t")
    assert run("SELECT count(*) FROM t") == [(0,)]
    engine.sql("BEGIN; SET search_path = public; COMMIT; DROP TABLE t; DROP TABLE IF EXISTS t; DROP VIEW v")
    assert engine.sql("SHOW search_path").first()[0] == "public"
