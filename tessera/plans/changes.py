"""DML, DDL, ingest, inference and metadata."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import catalog as cat
from tessera.operators import dml
from tessera.plans.registry import query
from tessera.session import shared_folder
from tessera.sources import arrow, infer
from tessera.sources.tables import load
from tessera.sql.engine import Engine
from tessera.streaming import windows as streaming


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session."""
    return f"{shared_folder(spark)}/tessera-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def _customers(spark, sf) -> dml.Table:
    columns = [cat.column("id", "BIGINT", nullable=False), cat.column("name", "VARCHAR(25)"), cat.column("nation", "INTEGER", default="-1"), cat.column("bal", "DOUBLE", default="0")]
    rows = load(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_nationkey AS nation", "c_acctbal AS bal")
    return dml.Table(rows, tuple(columns), (("not_negative", "id >= 0"),))


_BASE = "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS bal FROM customer"


@query("dml_insert_select", f"{_BASE} UNION ALL SELECT s_suppkey + 1000000, s_name, s_nationkey, s_acctbal FROM supplier")
def dml_insert_select(spark, sf):
    return dml.insert(_customers(spark, sf), load(spark, sf, "supplier").selectExpr("s_suppkey + 1000000", "s_name", "s_nationkey", "s_acctbal")).table.rows


@query("dml_insert_defaults", f"{_BASE} UNION ALL SELECT s_suppkey + 1000000, NULL, -1, 0 FROM supplier")
def dml_insert_defaults(spark, sf):
    return dml.insert(_customers(spark, sf), load(spark, sf, "supplier").selectExpr("s_suppkey + 1000000"), ["id"]).table.rows


@query("dml_insert_returning", "SELECT s_suppkey + 1000000 AS id, s_name AS name FROM supplier")
def dml_insert_returning(spark, sf):
    return dml.insert(_customers(spark, sf), load(spark, sf, "supplier").selectExpr("s_suppkey + 1000000", "s_name"), ["id", "name"]).returning("id", "name")


@query("dml_update", f"SELECT id, CASE WHEN nation = 3 THEN upper(name) ELSE name END AS name, nation, CASE WHEN nation = 3 THEN bal + 10 ELSE bal END AS bal FROM ({_BASE})")
def dml_update(spark, sf):
    return dml.update(_customers(spark, sf), {"name": "upper(name)", "bal": "bal + 10"}, "nation = 3").table.rows


@query("dml_update_returning", f"SELECT id, nation, id::INTEGER % 7 AS new_nation FROM (SELECT id, (id % 7)::INTEGER AS nation FROM ({_BASE}) WHERE bal < 0)")
def dml_update_returning(spark, sf):
    return dml.update(_customers(spark, sf), {"nation": "id % 7"}, "bal < 0").returning("id", "nation", F.expr("CAST(id % 7 AS int)").alias("new_nation"))


@query("dml_update_from", f"SELECT id, name, nation, CASE WHEN n.n_regionkey IS NOT NULL THEN bal + n.n_regionkey ELSE bal END AS bal FROM ({_BASE}) LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON nation = n_nationkey")
def dml_update_from(spark, sf):
    source = load(spark, sf, "nation").where("n_regionkey <> 2").select("n_nationkey", "n_regionkey")
    return dml.update_from(_customers(spark, sf), source, {"nation": "n_nationkey"}, {"bal": "bal + s.n_regionkey"}).table.rows


@query("dml_delete", f"SELECT * FROM ({_BASE}) WHERE NOT (bal < 0)")
def dml_delete(spark, sf):
    return dml.delete(_customers(spark, sf), "bal < 0").table.rows


@query("dml_delete_using", f"SELECT * FROM ({_BASE}) WHERE id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def dml_delete_using(spark, sf):
    return dml.delete_using(_customers(spark, sf), load(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey"), {"id": "o_custkey"}).table.rows


@query("dml_delete_using_returning", f"SELECT id, name FROM ({_BASE}) WHERE id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def dml_delete_using_returning(spark, sf):
    return dml.delete_using(_customers(spark, sf), load(spark, sf, "orders").where("o_totalprice > 400000").select("o_custkey"), {"id": "o_custkey"}).returning("id", "name")


@query("dml_truncate", "SELECT 0::BIGINT AS n")
def dml_truncate(spark, sf):
    return dml.truncate(_customers(spark, sf))[0].rows.agg(F.count("*").alias("n"))


_SOURCE = "(SELECT s_suppkey * 3 AS k, s_name AS label, s_acctbal AS b, CASE WHEN s_suppkey % 3 = 0 THEN 'del' WHEN s_suppkey % 3 = 1 THEN 'upd' ELSE 'skip' END AS op FROM supplier UNION ALL SELECT s_suppkey + 5000000, s_name, s_acctbal, CASE WHEN s_suppkey % 2 = 0 THEN 'ins' ELSE 'skip' END FROM supplier)"


def _merge(spark, sf) -> dml.Change:
    s = load(spark, sf, "supplier")
    one = s.selectExpr("s_suppkey * 3 AS k", "s_name AS label", "s_acctbal AS b", "CASE WHEN s_suppkey % 3 = 0 THEN 'del' WHEN s_suppkey % 3 = 1 THEN 'upd' ELSE 'skip' END AS op")
    two = s.selectExpr("s_suppkey + 5000000 AS k", "s_name AS label", "s_acctbal AS b", "CASE WHEN s_suppkey % 2 = 0 THEN 'ins' ELSE 'skip' END AS op")
    clauses = [
        dml.When("matched", "delete", "s.op = 'del'"),
        dml.When("matched", "update", "s.op = 'upd'", {"name": "s.label", "bal": "t.bal + s.b"}),
        dml.When("matched", "nothing"),
        dml.When("not_matched", "insert", "s.op = 'ins'", {"id": "s.k", "name": "s.label", "bal": "s.b"}),
        dml.When("not_matched_by_source", "update", "t.bal < -900", {"bal": "0"}),
    ]
    return dml.merge(_customers(spark, sf), one.unionByName(two), {"id": "k"}, clauses)


_MERGED = f"""SELECT t.*, s.*, CASE WHEN t.id IS NOT NULL AND s.op = 'del' THEN 'DELETE' WHEN t.id IS NOT NULL AND s.op = 'upd' THEN 'UPDATE' WHEN t.id IS NULL AND s.op = 'ins' THEN 'INSERT'
    WHEN s.k IS NULL AND t.bal < -900 THEN 'UPDATE' WHEN t.id IS NULL THEN 'NONE' ELSE 'KEEP' END AS act FROM ({_BASE}) t FULL JOIN {_SOURCE} s ON t.id = s.k"""
_NEW = "CASE WHEN act = 'INSERT' THEN k ELSE id END AS id, CASE WHEN act = 'INSERT' OR (act = 'UPDATE' AND k IS NOT NULL) THEN label ELSE name END AS name, CASE WHEN act = 'INSERT' THEN -1 ELSE nation END AS nation, CASE WHEN act = 'INSERT' THEN b WHEN act = 'UPDATE' AND k IS NOT NULL THEN bal + b WHEN act = 'UPDATE' THEN 0 ELSE bal END AS bal"


@query("dml_merge", f"SELECT {_NEW} FROM ({_MERGED}) WHERE act IN ('KEEP', 'UPDATE', 'INSERT')")
def dml_merge(spark, sf):
    return _merge(spark, sf).table.rows


@query("dml_merge_returning", f"SELECT id, act AS merge_action FROM (SELECT act, {_NEW} FROM ({_MERGED})) WHERE act IN ('DELETE', 'UPDATE', 'INSERT')")
def dml_merge_returning(spark, sf):
    return _merge(spark, sf).returning("id", "merge_action")


@query("ddl_alter", "SELECT c_custkey AS key, c_name AS name, c_acctbal AS bal, 'new' AS tag FROM customer")
def ddl_alter(spark, sf):
    t = cat.alter(_customers(spark, sf), cat.rename_column("id", "key"), cat.drop_column("nation"), cat.add_column(cat.column("tag", "VARCHAR(3)", default="'new'")), cat.add_check("tagged", "tag = 'new'"), cat.drop_check("tagged"))
    return t.rows


@query("ddl_create_table_as", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def ddl_create_table_as(spark, sf):
    return cat.create_table_as(load(spark, sf, "nation").groupBy("n_regionkey").agg(F.count("*").alias("n"))).rows


@query("ddl_create_insert", "SELECT n_nationkey::BIGINT AS id, n_name AS name, 'none' AS note FROM nation")
def ddl_create_insert(spark, sf):
    t = cat.create_table(spark, [cat.column("id", "BIGINT", nullable=False), cat.column("name", "VARCHAR(30)"), cat.column("note", "TEXT", default="'none'")])
    return dml.insert(t, load(spark, sf, "nation").select("n_nationkey", "n_name"), ["id", "name"]).table.rows


@query("ddl_view", "SELECT r, n FROM (SELECT n_regionkey AS r, count(*) AS n FROM nation GROUP BY 1) WHERE n > 3")
def ddl_view(spark, sf):
    load(spark, sf, "nation").createOrReplaceTempView("nation")
    cat.create_view(spark, "tessera_view", "SELECT n_regionkey, count(*) FROM nation GROUP BY 1", ["r", "n"])
    return spark.table("tessera_view").where("n > 3")


@query("info_schema_columns", "SELECT 'nation' AS table_name, c AS column_name, p::INTEGER AS ordinal_position, t AS data_type FROM (VALUES ('n_nationkey', 1, 'int'), ('n_name', 2, 'string'), ('n_regionkey', 3, 'int')) v(c, p, t)")
def info_schema_columns(spark, sf):
    load(spark, sf, "nation").createOrReplaceTempView("nation")
    return cat.info_columns(spark, "nation").select("table_name", "column_name", "ordinal_position", "data_type")


@query("info_schema_tables", "SELECT 'nation' AS table_name, 'VIEW' AS table_type")
def info_schema_tables(spark, sf):
    load(spark, sf, "nation").createOrReplaceTempView("nation")
    return cat.info_tables(spark).where("table_name = 'nation'").select("table_name", "table_type")


@query("ingest_modes", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def ingest_modes(spark, sf):
    path, n = _scratch(spark, "ingest"), load(spark, sf, "nation").select("n_nationkey", "n_name")
    arrow.ingest(spark, n.limit(0), path, "create")
    arrow.ingest(spark, n, path, "replace")
    arrow.ingest(spark, n, path, "append")
    return spark.read.parquet(path)


def _texts(spark, sf) -> DataFrame:
    k = F.col("o_orderkey")
    return load(spark, sf, "orders").select(
        k.cast("string").alias("k"), F.format_string("%.2f", "o_totalprice").alias("p"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), "o_orderstatus", F.when(k % 2 == 0, "yes").otherwise("F").alias("b"),
        F.concat(F.lit("0"), k.cast("string")).alias("zip"), F.when(k % 7 == 0, "NaN").otherwise(F.concat((k % 3).cast("string"), F.lit("e1"))).alias("x"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:00:00+02:00")).alias("z"),
        F.when(k % 2 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-02 03:04:05")).alias("t"),
    )


@query(
    "infer_types",
    """SELECT o_orderkey AS k, round(o_totalprice, 2)::DECIMAL(18,2) AS p, o_orderdate::DATE AS d, o_orderstatus, o_orderkey % 2 = 0 AS b, '0' || o_orderkey AS zip, CASE WHEN o_orderkey % 7 = 0 THEN 'NaN'::DOUBLE ELSE (o_orderkey % 3) * 10.0 END::DOUBLE AS x,
    epoch(o_orderdate::DATE)::BIGINT + 8 * 3600 AS z, CASE WHEN o_orderkey % 2 = 0 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-02 03:04:05' END AS t FROM orders""",
)
def infer_types(spark, sf):
    t = _texts(spark, sf)
    return infer.typed(t, infer.infer(t)).withColumn("z", F.unix_seconds("z"))


_CLASSES = "(VALUES ('k', 'bigint'), ('p', 'decimal(18,2)'), ('d', 'date'), ('o_orderstatus', 'string'), ('b', 'boolean'), ('zip', 'string'), ('x', 'double'), ('z', 'timestamp'), ('t', 'timestamp_ntz')) v(c, t)"


@query(
    "infer_check",
    f"""SELECT c AS "column", (SELECT count(*) FROM orders) AS rows, 1.0::DOUBLE AS present_share, t AS type,
    CASE c WHEN 'x' THEN 'double ' || (SELECT count(*) FROM orders WHERE o_orderkey % 7 <> 0) || ', special ' || (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0)
        WHEN 't' THEN 'date ' || (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) || ', timestamp_ntz ' || (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 1)
        WHEN 'o_orderstatus' THEN (SELECT concat_ws(', ', CASE WHEN count_if(o_orderstatus IN ('F')) > 0 THEN 'boolean ' || count_if(o_orderstatus IN ('F')) END, 'string ' || count_if(o_orderstatus NOT IN ('F'))) FROM orders) ELSE '' END AS mixed FROM {_CLASSES}""",
)
def infer_check(spark, sf):
    return infer.check(_texts(spark, sf))


@query("events_tumbling", "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def events_tumbling(spark, sf):
    return streaming.tumbling(load(spark, sf, "events"), "ts", "6 hours", "1 hour", "event_type").select("window_start", "event_type", "n")


@query("events_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS start FROM events), s AS (SELECT *, sum(start) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT min(ts) AS session_start, user_id, count(*) AS n FROM s GROUP BY user_id, k""")
def events_sessions(spark, sf):
    return streaming.sessions(load(spark, sf, "events"), "ts", "12 hours", "1 hour", "user_id").select("session_start", "user_id", "n")


@query("dml_delete_composite", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN (SELECT l_orderkey, max(l_linenumber) FROM lineitem GROUP BY 1)")
def dml_delete_composite(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    last = li.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("m"))
    return dml.delete_using(dml.Table.of(li), last, {"l_orderkey": "l_orderkey", "l_linenumber": "m"}).table.rows


@query("dml_update_row", f"SELECT id, CASE WHEN bal < 0 THEN 'x' || nation ELSE name END AS name, CASE WHEN bal < 0 THEN length(name)::INTEGER ELSE nation END AS nation, bal FROM ({_BASE})")
def dml_update_row(spark, sf):
    # (name, nation) = (.., ..): both values are of the old row
    return dml.update(_customers(spark, sf), {"name": "'x' || nation", "nation": "length(name)"}, "bal < 0").table.rows


@query("ddl_checks_and_lengths", "SELECT TRUE AS check_fails, TRUE AS length_fails, TRUE AS null_fails, TRUE AS null_passes_check")
def ddl_checks_and_lengths(spark, sf):
    t = cat.create_table(spark, [cat.column("a", "INTEGER", nullable=False), cat.column("s", "VARCHAR(3)")], [("positive", "a > 0 OR s IS NULL")])

    def fails(a, s) -> bool:
        try:
            dml.insert(t, spark.createDataFrame([(a, s)], "a int, s string")).table.rows.collect()
        except Exception as e:
            return "USER_RAISED" in str(e)
        return False

    return spark.createDataFrame([(fails(-1, "x"), fails(1, "abcd"), fails(None, "x"), not fails(-1, None))], "check_fails boolean, length_fails boolean, null_fails boolean, null_passes_check boolean")


@query("ddl_comment_default", "SELECT * FROM (VALUES ('id', 'the key', NULL), ('nation', NULL, '-1'), ('bal', NULL, '1')) v(column_name, comment, column_default)")
def ddl_comment_default(spark, sf):
    t = cat.alter(_customers(spark, sf), cat.comment_on("the key", "id"), cat.set_default("bal", "1"), cat.drop_column("name"))
    return spark.createDataFrame([(c.name, c.comment, c.default) for c in t.columns], "column_name string, comment string, column_default string")


@query("session_settings", "SELECT 'America/New_York' AS zone, '5s' AS timeout, NULL::VARCHAR AS reset_value, 'UTC' AS zone_after")
def session_settings(spark, sf):
    s = cat.Settings(spark)
    before = spark.conf.get("spark.sql.session.timeZone")
    s.set("TimeZone", "America/New_York")
    s.set("statement_timeout", "5s")
    zone, timeout = s.show("TimeZone"), s.show("statement_timeout")
    s.reset("statement_timeout")
    s.reset("TimeZone")
    row = (zone, timeout, s.show("statement_timeout"), s.show("time zone"))
    spark.conf.set("spark.sql.session.timeZone", before)
    return spark.createDataFrame([row], "zone string, timeout string, reset_value string, zone_after string")


@query("info_schema_schemata", "SELECT 'spark_catalog' AS catalog_name, 'default' AS schema_name")
def info_schema_schemata(spark, sf):
    return cat.info_schemata(spark).where("schema_name = 'default'")


@query("info_schema_views", "SELECT 'nation' AS table_name")
def info_schema_views(spark, sf):
    load(spark, sf, "nation").createOrReplaceTempView("nation")
    return cat.info_views(spark).where("table_name = 'nation'").select("table_name")


@query("info_schema_routines", "SELECT * FROM (VALUES ('upper'), ('percentile_cont')) v(routine_name)")
def info_schema_routines(spark, sf):
    return cat.info_routines(spark).where("routine_name IN ('upper', 'percentile_cont')")


@query("arrow_ipc_round_trip", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def arrow_ipc_round_trip(spark, sf):
    n = load(spark, sf, "nation").select("n_nationkey", "n_name")
    with tempfile.TemporaryDirectory() as d:
        arrow.export_ipc(n, os.path.join(d, "file"), compression="lz4")
        arrow.export_ipc(n, os.path.join(d, "stream"), stream=True, compression="zstd")
        return arrow.import_ipc(spark, os.path.join(d, "file")).unionAll(arrow.import_ipc(spark, os.path.join(d, "stream")))


@query("arrow_streamed_result", "SELECT n_nationkey, n_name FROM nation")
def arrow_streamed_result(spark, sf):
    batches = list(arrow.record_batches(load(spark, sf, "nation").select("n_nationkey", "n_name"), 7))
    return spark.createDataFrame(pa.Table.from_batches(batches))


@query("sql_script", "SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_nationkey < 5 THEN 1 ELSE 0 END AS flag FROM nation WHERE n_nationkey <> 7")
def sql_script(spark, sf):
    kind = spark.conf.get("spark.sql.timestampType")
    load(spark, sf, "nation").createOrReplaceTempView("nation")
    try:
        return Engine(spark).sql("""CREATE TABLE script_t (id INTEGER NOT NULL, name VARCHAR(30), flag INTEGER DEFAULT 0 CHECK (flag IN (0, 1)));
            INSERT INTO script_t (id, name) SELECT n_nationkey, n_name FROM nation; UPDATE script_t SET flag = 1 WHERE id < 5; DELETE FROM script_t WHERE id = 7; SELECT * FROM script_t""")
    finally:
        spark.conf.set("spark.sql.timestampType", kind)
