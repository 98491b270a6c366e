"""DDL, views, settings and metadata over Spark's session catalog, and ALTER TABLE as a transform of a declared table."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.dml import ColumnDef, Table

#: SQL type names and their Spark types. Fixed values of the dialect.
_TYPES = {
    "boolean": "boolean", "bool": "boolean", "smallint": "smallint", "int2": "smallint", "tinyint": "smallint", "integer": "int", "int": "int", "int4": "int", "mediumint": "int",
    "bigint": "bigint", "int8": "bigint", "long": "bigint", "real": "float", "float4": "float", "double": "double", "double precision": "double", "float8": "double", "float": "double",
    "numeric": "decimal(38,9)", "decimal": "decimal(38,9)", "dec": "decimal(38,9)", "varchar": "string", "character varying": "string", "text": "string", "string": "string", "clob": "string",
    "char": "string", "character": "string", "bpchar": "string", "varbinary": "binary", "blob": "binary", "bytea": "binary", "bytes": "binary", "date": "date", "time": "time(6)",
    "timestamp": "timestamp_ntz", "timestamp without time zone": "timestamp_ntz", "timestamp with time zone": "timestamp", "timestamptz": "timestamp",
    "interval": "struct<months:int,days:int,micros:bigint>", "json": "string", "jsonb": "string",
}


def spark_type(name: str) -> str:
    """The Spark type of a SQL type name; NUMERIC(p,s) up to 38 digits; FLOAT(n) is REAL up to 24 bits; TIMESTAMP(p) microseconds."""
    text = " ".join(name.lower().split())
    args = re.search(r"\(([0-9, ]+)\)", text)
    base = " ".join(re.sub(r"\([0-9, ]+\)", " ", text).split())
    if base in ("numeric", "decimal", "dec") and args:
        p, *s = (int(x) for x in args[1].split(","))
        if p > 38:
            raise ValueError("NUMERIC of over 38 digits is not supported")
        return f"decimal({p},{s[0] if s else 0})"
    if base == "float" and args:
        return "float" if int(args[1]) <= 24 else "double"
    if base not in _TYPES:
        raise ValueError(f"unknown type {name}")
    return _TYPES[base]


def varchar_length(name: str) -> int | None:
    m = re.fullmatch(r"(?i)(?:varchar|char|character|character varying|bpchar)\s*\(\s*([0-9]+)\s*\)", name.strip())
    return int(m[1]) if m else None


def column(name: str, kind: str, nullable: bool = True, default: str | None = None, comment: str | None = None) -> ColumnDef:
    return ColumnDef(name, spark_type(kind), nullable, default, varchar_length(kind), comment)


def create_table(spark: SparkSession, columns: Sequence[ColumnDef], checks: Sequence[tuple[str, str]] = ()) -> Table:
    """An empty table of declared columns. PRIMARY KEY, UNIQUE and FOREIGN KEY are not enforced."""
    schema = ", ".join(f"`{c.name}` {c.kind}" for c in columns)
    return Table(spark.createDataFrame([], schema), tuple(columns), tuple(checks))


def create_table_as(rows: DataFrame) -> Table:
    """CTAS: names and types from the query."""
    return Table.of(rows)


# ALTER TABLE commands: each takes a table and gives a table; a list of them is applied as one


def rename_column(old: str, new: str) -> Callable[[Table], Table]:
    def run(t: Table) -> Table:
        if new in t.names:
            raise ValueError(f"column {new} exists")
        checks = tuple((n, re.sub(rf"\b{re.escape(old)}\b", new, c)) for n, c in t.checks)
        return replace(t, rows=t.rows.withColumnRenamed(old, new), columns=tuple(replace(c, name=new) if c.name == old else c for c in t.columns), checks=checks)

    return run


def add_column(c: ColumnDef) -> Callable[[Table], Table]:
    """ADD COLUMN: old rows get the default when they are read; nothing is rewritten."""

    def run(t: Table) -> Table:
        if c.name in t.names:
            raise ValueError(f"column {c.name} exists")
        value = (F.expr(c.default) if c.default else F.lit(None)).cast(c.kind)
        return replace(t, rows=t.rows.withColumn(c.name, value), columns=(*t.columns, c))

    return run


def drop_column(name: str) -> Callable[[Table], Table]:
    def run(t: Table) -> Table:
        if name not in t.names:
            raise ValueError(f"no column {name}")
        return replace(t, rows=t.rows.drop(name), columns=tuple(c for c in t.columns if c.name != name), checks=tuple(c for c in t.checks if not re.search(rf"\b{re.escape(name)}\b", c[1])))

    return run


def set_default(name: str, default: str | None) -> Callable[[Table], Table]:
    return lambda t: replace(t, columns=tuple(replace(c, default=default) if c.name == name else c for c in t.columns))


def add_check(name: str, condition: str) -> Callable[[Table], Table]:
    """ADD CONSTRAINT .. CHECK: rows that break it are an error (NULL passes). One job looks for a single such row."""

    def run(t: Table) -> Table:
        if not t.rows.where(~F.coalesce(F.expr(condition), F.lit(True))).isEmpty():
            raise ValueError(f"check constraint {name} is violated by some row")
        return replace(t, checks=(*t.checks, (name, condition)))

    return run


def drop_check(name: str) -> Callable[[Table], Table]:
    return lambda t: replace(t, checks=tuple(c for c in t.checks if c[0] != name))


def comment_on(text: str | None, column: str | None = None) -> Callable[[Table], Table]:
    def run(t: Table) -> Table:
        return replace(t, columns=tuple(replace(c, comment=text) if c.name == column else c for c in t.columns)) if column else replace(t, comment=text)

    return run


def alter(table: Table, *commands: Callable[[Table], Table]) -> Table:
    """ALTER TABLE with a list of commands: all or none, as tables don't change in place."""
    for c in commands:
        table = c(table)
    return table


# the session catalog


def create_view(spark: SparkSession, name: str, query: str | DataFrame, columns: Sequence[str] | None = None, replace_it: bool = True) -> None:
    df = spark.sql(query) if isinstance(query, str) else query
    df = df.toDF(*columns) if columns else df
    (df.createOrReplaceTempView if replace_it else df.createTempView)(name)


def rename_view(spark: SparkSession, old: str, new: str) -> None:
    spark.table(old).createTempView(new)
    spark.catalog.dropTempView(old)


def drop_view(spark: SparkSession, name: str, missing_ok: bool = False) -> None:
    if not spark.catalog.dropTempView(name) and not missing_ok:
        raise ValueError(f"view {name} does not exist")


def create_schema(spark: SparkSession, name: str, exists_ok: bool = False) -> None:
    spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' if exists_ok else ''}`{name}`")


def drop_schema(spark: SparkSession, name: str, cascade: bool = False) -> None:
    spark.sql(f"DROP DATABASE `{name}` {'CASCADE' if cascade else 'RESTRICT'}")


def info_tables(spark: SparkSession) -> DataFrame:
    """information_schema.tables: metadata, one row a table."""
    rows = [(t.catalog or "spark_catalog", t.namespace[0] if t.namespace else "pg_temp", t.name, "VIEW" if t.tableType in ("VIEW", "TEMPORARY") else "BASE TABLE") for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "table_catalog string, table_schema string, table_name string, table_type string")


def info_columns(spark: SparkSession, *tables: str) -> DataFrame:
    """information_schema.columns of tables (all, if none are named)."""
    names = tables or [t.name for t in spark.catalog.listTables()]
    rows = [(t, f.name, k, "YES" if f.nullable else "NO", f.dataType.simpleString()) for t in names for k, f in enumerate(spark.table(t).schema.fields, 1)]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal_position int, is_nullable string, data_type string")


def info_schemata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("spark_catalog", d.name) for d in spark.catalog.listDatabases()], "catalog_name string, schema_name string")


def info_views(spark: SparkSession) -> DataFrame:
    return info_tables(spark).where("table_type = 'VIEW'").select("table_catalog", "table_schema", "table_name")


def info_routines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f.name,) for f in spark.catalog.listFunctions()], "routine_name string").distinct()


#: Settings that are kept, and the Spark setting that one of them drives.
_KEPT = frozenset("search_path client_encoding application_name standard_conforming_strings statement_timeout lock_timeout idle_in_transaction_session_timeout extra_float_digits datestyle intervalstyle".split())


class Settings:
    """SET, RESET and SHOW. SET LOCAL lasts for one statement, which is the caller's ``with`` block."""

    def __init__(self, spark: SparkSession):
        self.spark, self.values = spark, {}

    def set(self, name: str, value: str) -> None:
        key = name.lower()
        if key in ("timezone", "time zone"):
            self.spark.conf.set("spark.sql.session.timeZone", value)
        elif key == "search_path" and any(d.name == value for d in self.spark.catalog.listDatabases()):
            self.spark.catalog.setCurrentDatabase(value)
            self.values[key] = value
        elif key in _KEPT:
            self.values[key] = value
        else:
            raise ValueError(f"unrecognized configuration parameter {name}")

    def show(self, name: str) -> str | None:
        key = name.lower()
        return self.spark.conf.get("spark.sql.session.timeZone") if key in ("timezone", "time zone") else self.values.get(key)

    def reset(self, name: str) -> None:
        self.values.pop(name.lower(), None)
        if name.lower() in ("timezone", "time zone"):
            self.spark.conf.set("spark.sql.session.timeZone", "UTC")


def script(text: str) -> list[str]:
    """The statements of ``a; b; c``; semicolons in quotes, dollar quotes and comments don't end one."""
    out, part = [], []
    token = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|\$([A-Za-z_]*)\$.*?\$\1\$|--[^\n]*|/\*.*?\*/|;|.", re.S)
    for m in token.finditer(text):
        if m[0] == ";":
            out.append("".join(part).strip())
            part = []
        else:
            part.append(m[0])
    out.append("".join(part).strip())
    return [s for s in out if s]
