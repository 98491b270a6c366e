"""Statements: queries, DML over stored snapshots, DDL, settings and scripts.

A table is a Parquet snapshot in the shared folder with declarations kept by the engine. DML computes the next snapshot as
one plan, checks included, writes it beside the old one and only then makes it the table, so a failed statement changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace

import pyarrow
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import session
from tessera.operators import catalog as cat
from tessera.operators import dml
from tessera.sql import dialect, functions, recursion, typed
from tessera.sql.lexer import Group, Token, lex, parse, split, words


def _until(items: list, *stops: str) -> int:
    return next((k for k, t in enumerate(items) if t.kind == "name" and t.word in stops), len(items))


def _has_query(items: list) -> bool:
    return any(_has_query(t.items) if isinstance(t, Group) else t.kind == "name" and t.word in ("SELECT", "WITH") for t in items)


#: Parts that INSERT statements add to a table before they are joined to one.
MOST_PARTS = 16


class Engine:
    """A session of the dialect over a SparkSession."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        session.configure(spark)
        spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
        base = folder or session.shared_folder(spark)
        self.spark, self.folder = spark, f"{base.rstrip('/')}/tessera-{spark.sparkContext.applicationId}/tables-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, dml.Table] = {}
        self.parts: dict[str, int] = {}
        self.schemas: set[str] = set()
        #: Temporary tables, with the table of the same name that each hides.
        self.hidden: dict[str, dml.Table | None] = {}
        self.local: list[tuple[str, str | None]] = []
        functions.python_functions(spark)
        self.settings = cat.Settings(spark)

    # queries and scripts

    def sql(self, text: str, params: Sequence | None = None) -> DataFrame | None:
        """Run a statement, or a script of several; the result of the last. Parameters are ``?`` or ``$n``. What SET LOCAL sets lasts to the end
        of the script, or to COMMIT or ROLLBACK."""
        out = None
        try:
            for statement in cat.script(text):
                out = self._run(statement, params)
        finally:
            self._end_local()
        return out

    def schema(self, text: str) -> T.StructType:
        """ExecuteSchema: the result's schema. Queries are analyzed, changes are not made."""
        out = T.StructType()
        for statement in cat.script(text):
            items = self._resolved(parse(statement))
            first = items[0].word
            if isinstance(items[0], Group) or first in ("SELECT", "WITH", "VALUES"):
                params = self.parameter_schema(statement)
                out = self._query(items, [None] * len(params)).schema
            elif first in ("INSERT", "UPDATE", "DELETE", "MERGE"):
                back = _until(items, "RETURNING")
                out = T.StructType([T.StructField("count", T.LongType(), False)])
                if back < len(items):
                    name = next(t.text for t in items[1:] if t.kind in ("name", "ident") and t.word not in ("INTO", "FROM"))
                    listed = dialect.expression_list(items[back + 1 :]).replace("MERGE_ACTION()", "'INSERT'").replace("merge_action()", "'INSERT' AS merge_action")
                    out = self.spark.sql(f"SELECT {listed} FROM {name} LIMIT 0").schema
        return out

    def parameter_schema(self, text: str) -> T.StructType:
        """GetParameterSchema: a field for each parameter, of the type that Spark infers no sooner than a value is bound."""
        found = [t.text for t in lex(text) if t.kind == "param"]
        n = sum(p == "?" for p in found) or max([int(p[1:]) for p in found if p != "?"], default=0)
        return T.StructType([T.StructField(f"p{k}" if "?" not in found else str(k), T.NullType()) for k in range(1, n + 1)])

    def _query(self, items: list, params: Sequence | None = None) -> DataFrame:
        def run(text: str) -> DataFrame:
            if not params:
                return self.spark.sql(text)
            return self.spark.sql(text, args={f"p{k}": v for k, v in enumerate(params, 1)} if ":p1" in text else list(params))

        if (found := recursion.parse(items)) is not None:
            return recursion.run(self.spark, found, lambda part: self._query(part, params))
        return run(typed.text_of(self.spark, lambda: dialect.query(items), run))

    def _resolved(self, items: list) -> list:
        """Names with a schema as the names that the session knows: public.t is t, s.t is a name of its own, and the tables of
        information_schema are made when they are asked for."""
        out: list = []
        k = 0
        while k < len(items):
            t = items[k]
            if isinstance(t, Group):
                out.append(Group(self._resolved(t.items)))
            elif t.kind in ("name", "ident") and words(items, k + 1, ".") and k + 2 < len(items) and (not out or out[-1].word != "."):
                schema, name = t.text.lower().strip("`"), items[k + 2].text
                if schema == "information_schema":
                    out.append(Token("name", self._information(name.lower())))
                    k += 3
                    continue
                if schema == "public" and self._is_relation(name):
                    out.append(items[k + 2])
                    k += 3
                    continue
                if schema in self.schemas:
                    out.append(Token("name", f"{schema}__{name}"))
                    k += 3
                    continue
                out.append(t)
            else:
                out.append(t)
            k += 1
        return out

    def _is_relation(self, name: str) -> bool:
        return name in self.tables or self.spark.catalog.tableExists(name)

    def _information(self, name: str) -> str:
        """A view of information_schema."""
        makers = {"tables": self._info_tables, "columns": self._info_columns, "schemata": self._info_schemata, "views": lambda: self._info_tables().where("table_type = 'VIEW'").select("table_catalog", "table_schema", "table_name"), "routines": lambda: cat.info_routines(self.spark)}
        if name not in makers:
            raise ValueError(f"information_schema.{name} does not exist")
        view = f"__information_{name}"
        makers[name]().createOrReplaceTempView(view)
        return view

    def _relations(self) -> list[tuple[str, str, str, str]]:
        """(schema, name, type, name in the session) of tables and views."""
        out = []
        for t in self.spark.catalog.listTables():
            if t.name.startswith("__"):
                continue
            schema, _, name = t.name.partition("__") if t.name.partition("__")[0] in self.schemas else ("", "", t.name)
            kind = "LOCAL TEMPORARY" if t.name in self.hidden else "BASE TABLE" if t.name in self.tables or t.tableType not in ("TEMPORARY", "VIEW") else "VIEW"
            out.append(("pg_temp" if kind == "LOCAL TEMPORARY" else schema or (t.namespace[0] if t.namespace and t.tableType != "TEMPORARY" else "public"), name, kind, t.name))
        return out

    def _info_tables(self) -> DataFrame:
        rows = [("tessera", s, n, k) for s, n, k, _ in self._relations()]
        return self.spark.createDataFrame(rows, "table_catalog string, table_schema string, table_name string, table_type string")

    def _info_columns(self) -> DataFrame:
        rows = []
        for s, n, _, own in self._relations():
            declared = {c.name: c for c in self.tables[own].columns} if own in self.tables else {}
            for k, f in enumerate(self.spark.table(own).schema.fields, 1):
                c = declared.get(f.name)
                rows.append(("tessera", s, n, f.name, k, c.default if c else None, "YES" if (c.nullable if c else f.nullable) else "NO", f.dataType.simpleString(), c.length if c else None))
        return self.spark.createDataFrame(rows, "table_catalog string, table_schema string, table_name string, column_name string, ordinal_position int, column_default string, is_nullable string, data_type string, character_maximum_length int")

    def _info_schemata(self) -> DataFrame:
        return self.spark.createDataFrame([("tessera", s) for s in sorted({"public", "information_schema", *self.schemas})], "catalog_name string, schema_name string")

    def get_objects(self, depth: str = "all", schema: str | None = None, table: str | None = None, types: Sequence[str] | None = None, column: str | None = None) -> DataFrame:
        """GetObjects: catalogs with their schemas, tables and columns, nested, down to ``depth`` (catalogs, db_schemas, tables, all). Filters
        are LIKE patterns."""
        like = lambda name, pattern: F.lit(True) if pattern is None else F.col(name).like(pattern)
        kind = "array<struct<table_name string, table_type string, table_columns array<struct<column_name string, ordinal_position int, xdbc_type_name string, xdbc_is_nullable string>>>>".replace(" string", ":string").replace(" int", ":int").replace(" array", ":array")
        columns = self._info_columns().where(like("column_name", column)).groupBy("table_schema", "table_name").agg(F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name", "data_type", "is_nullable"))).alias("c"))
        tables = self._info_tables().where(like("table_schema", schema) & like("table_name", table))
        tables = tables.where(F.col("table_type").isin(*types)) if types else tables
        listed = F.transform("c", lambda c: F.struct(c["column_name"].alias("column_name"), c["ordinal_position"].alias("ordinal_position"), c["data_type"].alias("xdbc_type_name"), c["is_nullable"].alias("xdbc_is_nullable")))
        full = tables.join(columns, ["table_schema", "table_name"], "left").select("table_schema", F.struct("table_name", "table_type", (listed if depth == "all" else F.lit(None)).alias("table_columns")).alias("t"))
        by_schema = full.groupBy("table_schema").agg(F.array_sort(F.collect_list("t")).cast(kind).alias("t"))
        schemas = self._info_schemata().where(like("schema_name", schema)).join(by_schema, F.col("schema_name") == F.col("table_schema"), "left")
        entry = F.struct(F.col("schema_name").alias("db_schema_name"), F.when(F.lit(depth in ("tables", "all")), F.coalesce("t", F.array().cast(kind))).alias("db_schema_tables"))
        out = schemas.agg(F.array_sort(F.collect_list(entry)).alias("s"))
        return out.select(F.lit("tessera").alias("catalog_name"), F.when(F.lit(depth != "catalogs"), F.col("s")).alias("catalog_db_schemas"))

    def table_types(self) -> DataFrame:
        """ListTableTypes."""
        return self.spark.createDataFrame([("BASE TABLE",), ("LOCAL TEMPORARY",), ("VIEW",)], "table_type string")

    def info(self, *codes: int) -> DataFrame:
        """GetInfo: (info_name, info_value) by the codes of the Arrow database interface: vendor 0, its version 1, driver 100, its version 101."""
        known = {0: "tessera", 1: "1", 2: self.spark.version, 100: "tessera", 101: "1", 102: pyarrow.__version__}
        return self.spark.createDataFrame([(k, v) for k, v in known.items() if not codes or k in codes], "info_name int, info_value string")

    def table_schema(self, name: str) -> T.StructType:
        """GetTableSchema, with NOT NULL as declared."""
        own = self._resolved(parse(name))[0].text
        declared = {c.name: c.nullable for c in self.tables[own].columns} if own in self.tables else {}
        return T.StructType([T.StructField(f.name, f.dataType, declared.get(f.name, f.nullable)) for f in self.spark.table(own).schema.fields])

    def _run(self, statement: str, params: Sequence | None) -> DataFrame | None:
        items = self._resolved(parse(statement))
        first = items[0].word
        if isinstance(items[0], Group) or first in ("SELECT", "WITH", "VALUES"):
            return self._query(items, params)
        handler = getattr(self, f"_{first.lower()}", None)
        if handler is None:
            raise ValueError(f"unknown statement {first}")
        return handler(items[1:])

    # storage

    def _written(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """Rows as they were written to a folder of their own, in parts by the values of flags."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        writer = df.write
        (writer.partitionBy(*by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _set_table(self, name: str, table: dml.Table, rows: DataFrame) -> None:
        rows = rows.select(*[F.col(f"`{c.name}`").cast(c.kind).alias(c.name) for c in table.columns])
        self.tables[name] = replace(table, rows=rows)
        rows.createOrReplaceTempView(name)

    def _store(self, name: str, table: dml.Table) -> None:
        self.parts[name] = 1
        self._set_table(name, table, self._written(table.rows.select(*table.names), name))

    def _changed(self, name: str, change: dml.Change, returning: list | None) -> DataFrame:
        """Write a statement's rows, once; the changed rows (by RETURNING) or their number. An INSERT adds a part to the table, until MOST_PARTS
        of them are joined to one; other statements write live and dead rows to parts of their own, and only the live are the table's."""
        if change.flagged is None:
            kept = self._written(change.changed, name)
            old = self.tables[name]
            self.parts[name] = self.parts.get(name, 1) + 1
            if self.parts[name] > MOST_PARTS:
                self._store(name, replace(old, rows=old.rows.unionAll(kept)))
            else:
                self._set_table(name, old, old.rows.unionAll(kept))
        else:
            rows = self._written(change.flagged, name, dml.LIVE, dml.CHANGED)
            self.parts[name] = 1
            kept = rows.where(dml.CHANGED).drop(dml.LIVE, dml.CHANGED)
            self._set_table(name, change.table, rows.where(dml.LIVE))
        if returning is None:
            return kept.agg(F.count("*").alias("count"))
        kept.createOrReplaceTempView("__returning")

        def show() -> str:
            return f"SELECT {dialect.expression_list(returning)} FROM __returning AS {name}".replace("MERGE_ACTION()", "merge_action").replace("merge_action()", "merge_action")

        return self.spark.sql(typed.text_of(self.spark, show, self.spark.sql))

    def _table(self, name: str) -> dml.Table:
        if name not in self.tables:
            raise ValueError(f"no table {name}")
        return self.tables[name]

    # DML

    def _insert(self, items: list) -> DataFrame:
        name, k = items[1].text, 2
        columns = None
        if k < len(items) and isinstance(items[k], Group) and not words(items[k].items, 0, "SELECT"):
            columns = [t.text for t in items[k].items if t.text != ","]
            k += 1
        stop = k + _until(items[k:], "RETURNING")
        returning = items[stop + 1 :] if stop < len(items) else None
        t = self._table(name)
        if words(items, k, "DEFAULT", "VALUES"):
            return self._changed(name, dml.insert(t, None), returning)
        if words(items, k, "VALUES"):
            names = columns or t.names
            by = {c.name: c.default or "NULL" for c in t.columns}
            rows = [[by[n] if len(v) == 1 and v[0].word == "DEFAULT" else self._text(v) for n, v in zip(names, split(g.items), strict=False)] for g in items[k + 1 : stop] if isinstance(g, Group)]
            source = self.spark.sql("SELECT * FROM VALUES " + ", ".join(f"({', '.join(r)})" for r in rows))
        else:
            source = self._query(items[k:stop])
        return self._changed(name, dml.insert(t, source, columns), returning)

    def _text(self, items: list, source: str | None = None) -> str:
        """An expression over the rows of a FROM clause (none: constants)."""
        show = lambda: dialect.expression(items)
        return typed.text_of(self.spark, show, lambda text: self.spark.sql(f"SELECT {text}" + (f" FROM {source}" if source else "")))

    def _assignments(self, items: list, source: str) -> dict[str, str]:
        out = {}
        for part in split(items):
            at = next(k for k, t in enumerate(part) if t.word == "=")
            if isinstance(part[0], Group):
                targets, values = [t.text for t in part[0].items if t.text != ","], split(part[at + 1].items)
                if part[at + 1].items[0].word in ("SELECT", "WITH"):
                    row = f"(SELECT first(struct(*)) FROM ({dialect.query(part[at + 1].items)}) AS __r({', '.join(f'c{k}' for k in range(len(targets)))}))"
                    out |= {c: f"{row}.c{k}" for k, c in enumerate(targets)}
                else:
                    out |= {c: self._text(v, source) for c, v in zip(targets, values, strict=True)}
            else:
                out[part[at - 1].text] = self._text(part[at + 1 :], source)
        return out

    def _with_ids(self, name: str) -> DataFrame:
        """The stored rows, each with an id: the file's order doesn't change while the statement runs."""
        return self.tables[name].rows.select("*", F.monotonically_increasing_id().alias(dml.ROWID))

    def _update(self, items: list) -> DataFrame:
        name = items[0].text
        at = _until(items, "SET")
        alias = items[at - 1].text if at > 1 else name
        stop = at + 1 + _until(items[at + 1 :], "FROM", "WHERE", "RETURNING")
        where_at = stop + _until(items[stop:], "WHERE")
        back = _until(items, "RETURNING")
        returning = items[back + 1 :] if back < len(items) else None
        t = self._table(name)
        source = f"{name} AS {alias}" + (f", {dialect._from(items[stop + 1 : min(where_at, back)])}" if stop < len(items) and items[stop].word == "FROM" else "")
        values, where = self._assignments(items[at + 1 : stop], source), self._text(items[where_at + 1 : back], source) if where_at < back else "TRUE"
        if not (stop < len(items) and items[stop].word == "FROM"):
            rows = self.spark.table(name).alias(alias)
            return self._changed(name, dml.update(replace(t, rows=rows), values, where), returning)
        # one job finds the new values of each target row; rows of equal values are one change
        self._with_ids(name).createOrReplaceTempView("__target")
        source = dialect._from(items[stop + 1 : min(where_at, back)])
        new = self.spark.sql(f"SELECT {alias}.{dml.ROWID} AS __id, {', '.join(f'{v} AS `{c}`' for c, v in values.items())} FROM __target AS {alias}, {source} WHERE {where}")
        s = F.struct(*values)
        one = new.groupBy("__id").agg(F.min(s).alias("__lo"), F.max(s).alias("__hi"))
        joined = self.spark.table("__target").join(one, F.col(dml.ROWID) == F.col("__id"), "left")
        hit, clash = F.col("__id").isNotNull(), ~F.col("__lo").eqNullSafe(F.col("__hi"))
        out = [(F.when(hit & clash, F.raise_error(F.lit("more than one row changes a target row")).cast(c.kind)).when(hit, F.col("__lo")[c.name].cast(c.kind)).otherwise(F.col(c.name)) if c.name in values else F.col(c.name)).alias(c.name) for c in t.columns]
        return self._changed(name, dml.updated(t, joined.select(*out, hit.alias(dml.CHANGED))), returning)

    def _delete(self, items: list) -> DataFrame:
        name = items[1].text
        back = _until(items, "RETURNING")
        returning = items[back + 1 :] if back < len(items) else None
        where_at, using = _until(items[:back], "WHERE"), _until(items[:back], "USING")
        end = min(where_at, using, back)
        alias = items[end - 1].text if end > 2 else name
        t = self._table(name)
        source = f", {dialect._from(items[using + 1 : where_at])}" if using < back else ""
        where = self._text(items[where_at + 1 : back], f"{name} AS {alias}{source}") if where_at < back else "TRUE"
        if using >= back and not _has_query(items[where_at + 1 : back]):
            return self._changed(name, dml.delete(replace(t, rows=t.rows.alias(alias)), where), returning)
        # a subquery in WHERE becomes a join only as a condition of its own, so hits are kept by id
        self._with_ids(name).createOrReplaceTempView("__target")
        ids = self.spark.sql(f"SELECT DISTINCT {alias}.{dml.ROWID} AS __id FROM __target AS {alias}{source} WHERE {where}")
        rows = self.spark.table("__target").join(ids, F.col(dml.ROWID) == F.col("__id"), "left").withColumn(dml.CHANGED, F.col("__id").isNotNull())
        return self._changed(name, dml.deleted(t, rows), returning)

    def _merge(self, items: list) -> DataFrame:
        name, k = items[1].text, 2
        using = _until(items, "USING")
        target = items[using - 1].text if using > 2 else name
        on = _until(items, "ON")
        source_items = items[using + 1 : on]
        source_name = source_items[-1].text if len(source_items) > 1 else source_items[0].text
        source = self._query(source_items[0].items) if isinstance(source_items[0], Group) else self.spark.table(source_items[0].text)
        k = on + 1 + _until(items[on + 1 :], "WHEN")
        condition = items[on + 1 : k]
        condition = condition[0].items if len(condition) == 1 and isinstance(condition[0], Group) else condition
        pairs = {}
        for part in split(condition, "AND"):
            at = next(j for j, x in enumerate(part) if x.word == "=")
            sides = {part[0].text: part[at - 1].text, part[at + 1].text: part[-1].text}
            pairs[sides[target]] = sides[source_name]
        back = _until(items, "RETURNING")
        returning = items[back + 1 :] if back < len(items) else None

        source.createOrReplaceTempView("__source")
        both = f"(SELECT struct(*) AS t FROM {name}) CROSS JOIN (SELECT struct(*) AS s FROM __source)"

        def bound(tokens: list) -> str:
            swap = {target: "t", source_name: "s"}
            return self._text([replace(x, text=swap[x.text]) if not isinstance(x, Group) and x.kind == "name" and x.text in swap and j + 1 < len(tokens) and tokens[j + 1].word == "." else Group([replace(y, text=swap[y.text]) if not isinstance(y, Group) and y.kind == "name" and y.text in swap else y for y in x.items]) if isinstance(x, Group) else x for j, x in enumerate(tokens)], both)

        clauses = []
        starts = [j for j in range(k, back) if items[j].word == "WHEN"] + [back]
        for a, b in zip(starts, starts[1:], strict=False):
            part = items[a + 1 : b]
            then = next(j for j, x in enumerate(part) if x.word == "THEN")
            head, act = part[:then], part[then + 1 :]
            kind = "not_matched_by_source" if any(x.word == "SOURCE" for x in head) else "not_matched" if head[0].word == "NOT" else "matched"
            cond_at = next((j for j, x in enumerate(head) if x.word == "AND"), None)
            cond = bound(head[cond_at + 1 :]) if cond_at is not None else "true"
            if act[0].word == "UPDATE":
                sets = {}
                for p in split(act[2:]):
                    eq = next(j for j, x in enumerate(p) if x.word == "=")
                    sets[p[eq - 1].text] = bound(p[eq + 1 :])
                clauses.append(dml.When(kind, "update", cond, sets))
            elif act[0].word == "INSERT":
                columns = [x.text for x in act[1].items if x.text != ","] if isinstance(act[1], Group) else self._table(name).names
                values = [bound(v) for v in split(act[-1].items)]
                clauses.append(dml.When(kind, "insert", cond, dict(zip(columns, values, strict=True))))
            else:
                clauses.append(dml.When(kind, "delete" if act[0].word == "DELETE" else "nothing", cond))
        return self._changed(name, dml.merge(self._table(name), source, pairs, clauses), returning)

    def _truncate(self, items: list) -> None:
        names = [t.text for t in items if t.kind == "name" and t.word != "TABLE"]
        for n, t in zip(names, dml.truncate(*map(self._table, names)), strict=True):
            self._store(n, t)

    # DDL and settings

    def _columns(self, group: Group) -> tuple[list[dml.ColumnDef], list[tuple[str, str]]]:
        columns, checks = [], []
        named = [(p[0].text, dialect._type(p, 1)[0]) for p in split(group.items) if p[0].word not in ("PRIMARY", "UNIQUE", "FOREIGN", "CHECK", "CONSTRAINT")]
        source = "(SELECT " + ", ".join(f"CAST(NULL AS {k}) AS {n}" for n, k in named) + ")"
        for part in split(group.items):
            if part[0].word in ("PRIMARY", "UNIQUE", "FOREIGN"):
                continue  # parsed, not enforced
            if part[0].word in ("CHECK", "CONSTRAINT"):
                named = part[0].word == "CONSTRAINT"
                if any(t.word == "CHECK" for t in part):
                    checks.append((part[1].text if named else f"check_{len(checks)}", self._text(part[-1].items, source)))
                continue
            columns.append(self._column(part, checks, source))
        return columns, checks

    def _column(self, part: list, checks: list, source: str | None = None) -> dml.ColumnDef:
        kind, end = dialect._type(part, 1)
        length = int(part[2].items[0].text) if kind == "string" and len(part) > 2 and isinstance(part[2], Group) else None
        nullable, default, k = True, None, end
        while k < len(part):
            if words(part, k, "NOT", "NULL"):
                nullable = False
            elif part[k].word == "DEFAULT":
                stop = k + 1 + _until(part[k + 1 :], "NOT", "NULL", "CHECK", "PRIMARY", "UNIQUE", "REFERENCES")
                default = self._text(part[k + 1 : stop])
                k = stop - 1
            elif part[k].word == "CHECK":
                checks.append((f"{part[0].text}_check", self._text(part[k + 1].items, source)))
            k += 1
        return dml.ColumnDef(part[0].text, kind, nullable, default, length)

    def _create(self, items: list) -> None:
        temporary = items[0].word in ("TEMP", "TEMPORARY")
        items = [t for k, t in enumerate(items) if not (t.word in ("TEMP", "TEMPORARY") or words(items, k, "OR", "REPLACE") or t.word == "REPLACE" or words(items, k, "OR"))]
        kind, items = items[0].word, items[1:]
        missing = words(items, 0, "IF", "NOT", "EXISTS")
        items = items[3:] if missing else items
        name = items[0].text
        if kind == "SCHEMA":
            if name.lower() in self.schemas and not missing:
                raise ValueError(f"schema {name} exists")
            self.schemas.add(name.lower())
            return None
        at = _until(items, "AS")
        if kind == "VIEW":
            columns = [t.text for t in items[1].items if t.text != ","] if isinstance(items[1], Group) else None
            return cat.create_view(self.spark, name, self._query(items[at + 1 :]), columns)
        if name in self.tables and (not temporary or name in self.hidden):
            if missing:
                return None
            raise ValueError(f"table {name} exists")
        if temporary:
            self.hidden[name] = self.tables.get(name)
        if at < len(items):
            return self._store(name, cat.create_table_as(self._query(items[at + 1 :])))
        columns, checks = self._columns(items[1])
        return self._store(name, cat.create_table(self.spark, columns, checks))

    def _drop(self, items: list) -> None:
        kind, items = items[0].word, items[1:]
        missing = words(items, 0, "IF", "EXISTS")
        items = items[2:] if missing else items
        for part in split(items):
            name, cascade = part[0].text, words(part, 1, "CASCADE")
            if kind == "SCHEMA":
                self._drop_schema(name.lower(), cascade, missing)
            elif kind == "TABLE":
                if name not in self.tables and not missing:
                    raise ValueError(f"no table {name}")
                self._drop_table(name)
            else:
                cat.drop_view(self.spark, name, missing)

    def _drop_table(self, name: str) -> None:
        """A temporary table gives way to the table that it hid."""
        if self.tables.pop(name, None) is None:
            return
        self.spark.catalog.dropTempView(name)
        if (before := self.hidden.pop(name, None)) is not None:
            self._set_table(name, before, before.rows)

    def _drop_schema(self, name: str, cascade: bool, missing: bool) -> None:
        if name not in self.schemas:
            if missing:
                return
            raise ValueError(f"no schema {name}")
        own = [t.name for t in self.spark.catalog.listTables() if t.name.startswith(f"{name}__")]
        if own and not cascade:
            raise ValueError(f"schema {name} is not empty")
        for n in own:
            if n in self.tables:
                self._drop_table(n)
            else:
                self.spark.catalog.dropTempView(n)
        self.schemas.discard(name)

    def _alter(self, items: list) -> None:
        kind, name = items[0].word, items[1].text
        if kind == "VIEW":
            return cat.rename_view(self.spark, name, items[-1].text)
        table, new_name = self._table(name), name
        commands = []
        for c in split(items[2:]):
            w = [t.word for t in c]
            if w[:2] == ["RENAME", "TO"]:
                new_name = c[2].text
            elif w[0] == "RENAME":
                old, new = (c[2], c[4]) if w[1] == "COLUMN" else (c[1], c[3])
                commands.append(cat.rename_column(old.text, new.text))
            elif w[0] == "ADD" and w[1] == "CONSTRAINT":
                commands.append(cat.add_check(c[2].text, self._text(c[-1].items, name)))
            elif w[0] == "ADD":
                commands.append(cat.add_column(self._column(c[2:] if w[1] == "COLUMN" else c[1:], [])))
            elif w[0] == "DROP" and w[1] == "CONSTRAINT":
                commands.append(cat.drop_check(c[2].text))
            elif w[0] == "DROP":
                commands.append(cat.drop_column(c[-1].text))
            elif w[0] == "ALTER":
                column = c[2] if w[1] == "COLUMN" else c[1]
                commands.append(cat.set_default(column.text, self._text(c[w.index("DEFAULT") + 1 :]) if "SET" in w else None))
            else:
                raise ValueError("unknown ALTER TABLE command")
        table = cat.alter(table, *commands)
        self._store(new_name, table)
        if new_name != name:
            del self.tables[name]
            self.spark.catalog.dropTempView(name)
        return None

    def _comment(self, items: list) -> None:
        at = _until(items, "IS")
        text = None if items[at + 1].word == "NULL" else dialect._unlit(items[at + 1])
        path = [t.text for t in items[2:at] if t.text != "."]
        if items[1].word == "COLUMN":
            self.tables[path[0]] = cat.comment_on(text, path[1])(self._table(path[0]))
        elif path[0] in self.tables:
            self.tables[path[0]] = cat.comment_on(text)(self._table(path[0]))

    def _set(self, items: list) -> None:
        local = items[0].word == "LOCAL"
        items = items[1:] if items[0].word in ("LOCAL", "SESSION") else items
        name, value = ("TimeZone", items[2].text.strip("'")) if words(items, 0, "TIME", "ZONE") else (items[0].text, "".join(t.text for t in items[2:]).strip("'"))
        if local:
            self.local.append((name, self.settings.show(name)))
        self.settings.set(name, value)

    def _end_local(self) -> None:
        while self.local:
            name, before = self.local.pop()
            if before is None:
                self.settings.reset(name)
            else:
                self.settings.set(name, before)

    def _reset(self, items: list) -> None:
        self.settings.reset(items[0].text)

    def _show(self, items: list) -> DataFrame:
        name = "TimeZone" if words(items, 0, "TIME", "ZONE") else items[0].text
        return self.spark.createDataFrame([(self.settings.show(name),)], f"`{name}` string")

    def _begin(self, items: list) -> None:
        """Accepted and ignored: every statement stands alone."""

    def _commit(self, items: list) -> None:
        """Ends what SET LOCAL has set."""
        self._end_local()

    _start, _end, _rollback = _begin, _commit, _commit
