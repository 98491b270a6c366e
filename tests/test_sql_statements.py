"""Statements and query forms of the SQL front end, with hand-written results."""

import pytest

from tessera.sql import Engine


@pytest.fixture(scope="module")
def engine(spark):
    e = Engine(spark)
    e.sql("CREATE TABLE edge (a INTEGER, b INTEGER); INSERT INTO edge VALUES (1, 4), (4, 7), (7, 9), (9, 4), (7, 2), (2, 8)")
    e.sql("""CREATE TABLE w (g VARCHAR, k INTEGER, v DOUBLE);
        INSERT INTO w VALUES ('x', 1, 1e16), ('x', 1, 1.0), ('x', 2, 2.0), ('x', 3, NULL), ('x', 3, 5.0), ('y', 1, 7.0)""")
    yield e
    spark.conf.unset("spark.sql.timestampType")


def rows(engine, text):
    return sorted((tuple(r) for r in engine.sql(text).collect()), key=repr)


def test_recursive_union(engine):
    assert rows(engine, "WITH RECURSIVE r(n) AS (SELECT 1 UNION SELECT b FROM r JOIN edge ON a = n) SELECT n FROM r") == [(1,), (2,), (4,), (7,), (8,), (9,)]
    assert rows(engine, "WITH RECURSIVE s AS (SELECT 5 AS x), r AS (SELECT x, 1 AS d FROM s UNION SELECT x, (d + 1) % 3 FROM r) SELECT * FROM r") == [(5, 0), (5, 1), (5, 2)]


def test_search_and_cycle(engine):
    walk = "WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT e.b FROM r x JOIN edge e ON e.a = x.n) {} SELECT {} FROM r"
    cycle = "CYCLE n SET met USING path"
    got = rows(engine, walk.format(cycle, "n, met, path"))
    assert got == sorted([(1, False, "{(1)}"), (4, False, "{(1),(4)}"), (7, False, "{(1),(4),(7)}"), (9, False, "{(1),(4),(7),(9)}"), (2, False, "{(1),(4),(7),(2)}"), (4, True, "{(1),(4),(7),(9),(4)}"), (8, False, "{(1),(4),(7),(2),(8)}")], key=repr)
    assert rows(engine, walk.format("CYCLE n SET met TO 'Y' DEFAULT 'N' USING p", "n, met") + " WHERE met = 'Y'") == [(4, "Y")]
    depth = [r[0] for r in engine.sql(walk.format(f"SEARCH DEPTH FIRST BY n SET ord {cycle}", "n") + " WHERE NOT met ORDER BY ord").collect()]
    breadth = [r[0] for r in engine.sql(walk.format(f"SEARCH BREADTH FIRST BY n SET ord {cycle}", "n") + " WHERE NOT met ORDER BY ord").collect()]
    assert depth == [1, 4, 7, 2, 8, 9]
    assert breadth == [1, 4, 7, 2, 9, 8]


def test_frames(engine):
    over = "OVER (PARTITION BY g ORDER BY k {})"
    one = lambda f, agg="sum(v)": rows(engine, f"SELECT g, k, v, {agg} {over.format(f)} AS s FROM w")
    assert [r[3] for r in one("GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW", "count(*)")] == [2, 2, 3, 3, 3, 1]
    by = {(r[0], r[1], r[2]): r[3] for r in one("ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW")}
    assert by[("x", 1, 1e16)] == 8.0 and by[("y", 1, 7.0)] is None
    by = {(r[0], r[1], r[2]): r[3] for r in one("ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING EXCLUDE GROUP", "count(v)")}
    assert by[("x", 2, 2.0)] in (1, 2) and by[("y", 1, 7.0)] == 0
    by = {(r[0], r[1], r[2]): r[3] for r in one("GROUPS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE TIES", "max(v)")}
    assert by[("x", 1, 1.0)] == 1.0 and by[("x", 1, 1e16)] == 1e16 and by[("x", 3, None)] == 1e16
    assert rows(engine, "SELECT k, avg(v) OVER w AS a FROM w WHERE g = 'x' AND k = 1 WINDOW w AS (ORDER BY k GROUPS BETWEEN CURRENT ROW AND CURRENT ROW EXCLUDE CURRENT ROW)") == [(1, 1.0), (1, 1e16)]
    assert rows(engine, "SELECT g, count(*) FILTER (WHERE v > 1) OVER (PARTITION BY g) AS n FROM w WHERE k = 1") == [("x", 1), ("x", 1), ("y", 1)]
    assert rows(engine, "SELECT * FROM w t WHERE k = 1 QUALIFY sum(v) OVER (PARTITION BY t.g ORDER BY t.v GROUPS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) > 5") == [("x", 1, 1.0)]


def test_tables_of_schemas_and_temporary_ones(engine):
    engine.sql("CREATE SCHEMA s; CREATE TABLE s.t (x INTEGER); INSERT INTO s.t VALUES (1); CREATE TABLE t (x INTEGER); INSERT INTO t VALUES (2)")
    assert rows(engine, "SELECT t.x, s.t.x FROM t, s.t") == [(2, 1)]
    assert rows(engine, "SELECT x FROM public.t") == [(2,)]
    engine.sql("CREATE TEMP TABLE t (x INTEGER, y INTEGER); INSERT INTO t VALUES (3, 4)")
    assert rows(engine, "SELECT * FROM t") == [(3, 4)]
    assert ("pg_temp", "t", "LOCAL TEMPORARY") in rows(engine, "SELECT table_schema, table_name, table_type FROM information_schema.tables")
    engine.sql("DROP TABLE t")
    assert rows(engine, "SELECT * FROM t") == [(2,)]
    with pytest.raises(ValueError, match="not empty"):
        engine.sql("DROP SCHEMA s")
    engine.sql("DROP SCHEMA s CASCADE; DROP TABLE t")
    with pytest.raises(ValueError):
        engine.sql("DROP TABLE t")


def test_information_schema(engine):
    engine.sql("CREATE TABLE info (id INTEGER NOT NULL, name VARCHAR(5) DEFAULT 'n'); CREATE VIEW iv AS SELECT id FROM info")
    got = rows(engine, "SELECT column_name, ordinal_position, is_nullable, data_type, character_maximum_length FROM information_schema.columns WHERE table_name = 'info'")
    assert got == [("id", 1, "NO", "int", None), ("name", 2, "YES", "string", 5)]
    assert rows(engine, "SELECT table_name, table_type FROM information_schema.tables WHERE table_name IN ('info', 'iv')") == [("info", "BASE TABLE"), ("iv", "VIEW")]
    assert ("iv",) in rows(engine, "SELECT table_name FROM information_schema.views")
    assert ("public",) in rows(engine, "SELECT schema_name FROM information_schema.schemata")
    objects = engine.get_objects(table="info").first()
    tables = next(s for s in objects["catalog_db_schemas"] if s["db_schema_name"] == "public")["db_schema_tables"]
    assert [(t["table_name"], [c["column_name"] for c in t["table_columns"]]) for t in tables] == [("info", ["id", "name"])]
    assert engine.get_objects("catalogs").first()["catalog_db_schemas"] is None
    assert engine.table_types().count() == 3 and engine.info(0).first()["info_value"] == "tessera"
    assert [f.nullable for f in engine.table_schema("public.info").fields] == [False, True]
    engine.sql("DROP VIEW iv; DROP TABLE info")


def test_schemas_of_statements_change_nothing(engine):
    engine.sql("CREATE TABLE q (id INTEGER, n INTEGER); INSERT INTO q VALUES (1, 7)")
    assert engine.schema("SELECT n / 2 AS h FROM q").simpleString() == "struct<h:bigint>"
    assert engine.schema("DELETE FROM q RETURNING id").fieldNames() == ["id"]
    assert engine.schema("INSERT INTO q VALUES (2, 2)").fieldNames() == ["count"]
    assert rows(engine, "SELECT count(*) FROM q") == [(1,)]
    assert len(engine.parameter_schema("SELECT ? + ?")) == 2 and len(engine.parameter_schema("SELECT $2, $1")) == 2
    engine.sql("DROP TABLE q")


def test_changes_are_typed_and_made_once(engine):
    engine.sql("CREATE TABLE c (id INTEGER, n INTEGER, r DOUBLE, CHECK (n / 2 < 100)); INSERT INTO c VALUES (1, 7, 0), (2, 9, 0); INSERT INTO c VALUES (3, 11 / 2, 0)")
    assert rows(engine, "UPDATE c SET n = n / 2 WHERE id / 2 = 1 RETURNING id, n") == [(2, 4), (3, 2)]
    changed = rows(engine, "UPDATE c SET r = random() RETURNING id, r")
    assert changed == rows(engine, "SELECT id, r FROM c")
    assert rows(engine, "UPDATE c SET (n, r) = (SELECT max(a), 1.5 FROM edge) WHERE id = 1 RETURNING n, r") == [(9, 1.5)]
    with pytest.raises(Exception, match="check constraint"):
        engine.sql("UPDATE c SET n = 300")
    assert rows(engine, "DELETE FROM c x WHERE x.n / 2 = 2 RETURNING id") == [(2,)]
    for k in range(20):
        engine.sql(f"INSERT INTO c VALUES ({100 + k}, 0, 0)")
    assert engine.sql("SELECT count(*) FROM c").first()[0] == 22
    engine.sql("CREATE TABLE m (id INTEGER, n INTEGER); INSERT INTO m VALUES (1, 8), (1, 8), (50, 5)")
    with pytest.raises(Exception, match="second time"):
        engine.sql("MERGE INTO c USING m ON c.id = m.id WHEN MATCHED THEN UPDATE SET n = m.n / 2")
    got = rows(engine, "MERGE INTO c USING (SELECT DISTINCT * FROM m) AS m ON c.id = m.id WHEN MATCHED THEN UPDATE SET n = m.n / 3 WHEN NOT MATCHED THEN INSERT (id, n) VALUES (m.id, m.n / 2) RETURNING merge_action(), id, n")
    assert got == [("INSERT", 50, 2), ("UPDATE", 1, 2)]
    engine.sql("DROP TABLE c; DROP TABLE m")


def test_local_settings_end_with_the_script(engine):
    assert engine.sql("SET LOCAL TIME ZONE 'Asia/Tokyo'; SHOW TimeZone").first()[0] == "Asia/Tokyo"
    assert engine.sql("SHOW TIME ZONE").first()[0] == "UTC"
    engine.sql("SET application_name = 'a'; BEGIN; SET LOCAL application_name = 'b'; COMMIT")
    assert engine.sql("SHOW application_name").first()[0] == "a"


def test_series(engine):
    months = [str(r[0])[:10] for r in engine.sql("SELECT * FROM generate_series(TIMESTAMP '2024-01-31', TIMESTAMP '2024-04-30', INTERVAL '1 month')").collect()]
    assert months == ["2024-01-31", "2024-02-29", "2024-03-29", "2024-04-29"]
    assert [r[0] for r in engine.sql("SELECT n FROM generate_series(5, 1, -2) AS g(n)").collect()] == [5, 3, 1]
    assert engine.sql("SELECT * FROM generate_series(3, 1)").count() == 0
    with pytest.raises(Exception, match="zero"):
        engine.sql("SELECT * FROM generate_series(1, 2, 0)").collect()
