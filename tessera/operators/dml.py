"""INSERT, UPDATE, DELETE, MERGE and TRUNCATE as snapshot transforms.

A table is a DataFrame with the declarations of its columns. A statement gives a Change: one lazy plan of rows that are flagged as live
(in the new snapshot) and as changed (for RETURNING), so that a writer evaluates the statement once; nothing is written until the
caller writes it. All checks are part of the plan, so they are done before any write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWID = "__rowid"


@dataclass(frozen=True)
class ColumnDef:
    """A column's declaration. ``default`` is a SQL expression, ``length`` that of VARCHAR(n)."""

    name: str
    kind: str
    nullable: bool = True
    default: str | None = None
    length: int | None = None
    comment: str | None = None


@dataclass(frozen=True)
class Table:
    """Rows with their declarations. Checks are SQL conditions that must not be false."""

    rows: DataFrame
    columns: tuple[ColumnDef, ...]
    checks: tuple[tuple[str, str], ...] = ()
    comment: str | None = None

    @staticmethod
    def of(rows: DataFrame, **declared: ColumnDef) -> Table:
        return Table(rows, tuple(declared.get(f.name) or ColumnDef(f.name, f.dataType.simpleString(), f.nullable) for f in rows.schema.fields))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


LIVE, CHANGED = "__live", "__changed"


@dataclass(frozen=True)
class Change:
    """The snapshot after a statement, and its changed rows (with ``merge_action`` for MERGE). ``flagged`` has both, told apart by LIVE and
    CHANGED; INSERT, which leaves the old rows alone, has none."""

    table: Table
    changed: DataFrame
    flagged: DataFrame | None = None

    @staticmethod
    def of(table: Table, flagged: DataFrame, extra: Sequence[str] = ()) -> Change:
        rows = Table(flagged.where(LIVE).select(*table.names), table.columns, table.checks, table.comment)
        return Change(rows, flagged.where(CHANGED).select(*table.names, *extra), flagged)

    def returning(self, *items: Column | str) -> DataFrame:
        return self.changed.select(*items) if items else self.changed

    def count(self) -> int:
        return self.changed.count()


def _fail(message: str, kind: str) -> Column:
    return F.raise_error(F.lit(message)).cast(kind)


def verified(table: Table, rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Rows in the table's types (and further columns as they are), each NOT NULL, length and CHECK rule tested as the row is produced."""
    out = []
    for c in table.columns:
        v = F.col(f"`{c.name}`").cast(c.kind)
        if c.length is not None:
            v = F.when(v.isNull() | (F.length(F.rtrim(v)) <= c.length), F.substr(v, F.lit(1), F.lit(c.length))).otherwise(_fail(f"value too long for {c.name}: VARCHAR({c.length})", c.kind))
        if not c.nullable:
            v = F.coalesce(v, _fail(f"null value in column {c.name}", c.kind))
        out.append(v.alias(c.name))
    rows = rows.select(*out, *extra)
    for name, condition in table.checks:
        first = table.columns[0]
        broken = ~F.coalesce(F.expr(condition), F.lit(True))
        rows = rows.withColumn(first.name, F.when(broken, _fail(f"new row violates check constraint {name}", first.kind)).otherwise(F.col(first.name)))
    return rows


def insert(table: Table, source: DataFrame | None, columns: Sequence[str] | None = None) -> Change:
    """INSERT: columns by position; what is left out gets its default. source None: DEFAULT VALUES."""
    spark = table.rows.sparkSession
    source = spark.range(1).select() if source is None else source
    given = list(columns if columns is not None else table.names[: len(source.columns)])
    if unknown := set(given) - set(table.names):
        raise ValueError(f"no such column: {sorted(unknown)}")
    source = source.toDF(*given) if given else source
    full = source.select(*[F.col(c.name) if c.name in given else (F.expr(c.default) if c.default else F.lit(None)).cast(c.kind).alias(c.name) for c in table.columns])
    new = verified(table, full)
    return Change(Table(table.rows.select(*table.names).unionByName(new), table.columns, table.checks, table.comment), new)


def update(table: Table, assignments: Mapping[str, Column | str], where: Column | str = "true") -> Change:
    """UPDATE .. SET: all values come from the old row. One pass, no shuffle."""
    hit = F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))
    values = {k: F.expr(v) if isinstance(v, str) else v for k, v in assignments.items()}
    new = [(F.when(hit, values[c].cast(k)).otherwise(F.col(c)) if c in values else F.col(c)).alias(c) for c, k in ((d.name, d.kind) for d in table.columns)]
    return updated(table, table.rows.select(*new, hit.alias(CHANGED)))


def updated(table: Table, rows: DataFrame) -> Change:
    """The change that rows with new values, flagged as changed or not, make."""
    return Change.of(table, verified(table, rows.withColumn(LIVE, F.lit(True)), (LIVE, CHANGED)))


def _single(source: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row of a source for each key; several with different values are an error when they are used."""
    s = F.struct(*values) if values else F.struct(F.lit(1).alias("one"))
    # map-side partial: the least and greatest values of a key differ if any two do
    return source.groupBy(*keys).agg(F.min(s).alias("__lo"), F.max(s).alias("__hi"), F.count("*").alias("__n"))


def update_from(table: Table, source: DataFrame, on: Mapping[str, str], assignments: Mapping[str, str]) -> Change:
    """UPDATE .. FROM source WHERE target.k = source.k ..: values are SQL over the target's columns and ``s.<column>``. Equal
    matches are one change, different ones an error."""
    keys = [f"s_{c}" for c in source.columns]
    src = source.toDF(*keys)
    on_keys = [f"s_{v}" for v in on.values()]
    rest = [k for k in keys if k not in on_keys]
    one = _single(src.where(" AND ".join(f"`{k}` IS NOT NULL" for k in on_keys)), on_keys, rest)
    joined = table.rows.join(one, [F.col(t) == F.col(f"s_{s}") for t, s in on.items()], "left")
    hit = F.col("__n").isNotNull()
    clash = hit & ~F.col("__lo").eqNullSafe(F.col("__hi"))
    s = F.struct(*[F.col(k).alias(k[2:]) for k in on_keys], *[F.col("__lo")[k].alias(k[2:]) for k in rest])
    joined = joined.withColumn("s", s)
    out = []
    for d in table.columns:
        v = F.col(d.name)
        if d.name in assignments:
            v = F.when(clash, _fail("more than one row changes a target row", d.kind)).when(hit, F.expr(assignments[d.name]).cast(d.kind)).otherwise(v)
        out.append(v.alias(d.name))
    return updated(table, joined.select(*out, hit.alias(CHANGED)))


def delete(table: Table, where: Column | str = "true") -> Change:
    """DELETE .. WHERE: a filter, no shuffle."""
    return deleted(table, table.rows.withColumn(CHANGED, F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))))


def deleted(table: Table, rows: DataFrame) -> Change:
    """The change that rows make of which the flagged ones go."""
    return Change.of(table, rows.select(*table.names, CHANGED, (~F.col(CHANGED)).alias(LIVE)))


def delete_using(table: Table, source: DataFrame, on: Mapping[str, str]) -> Change:
    """DELETE .. USING: one hash join by key with the source's distinct keys, composite keys included."""
    keys = source.select(*[F.col(s).alias(f"s_{s}") for s in on.values()]).distinct().withColumn("__hit", F.lit(True))
    joined = table.rows.join(keys, [F.col(t) == F.col(f"s_{s}") for t, s in on.items()], "left")
    return deleted(table, joined.withColumn(CHANGED, F.coalesce("__hit", F.lit(False))))


def truncate(*tables: Table) -> list[Table]:
    return [Table(t.rows.limit(0), t.columns, t.checks, t.comment) for t in tables]


@dataclass(frozen=True)
class When:
    """A MERGE clause: kind matched, not_matched or not_matched_by_source; action update, delete, insert or nothing; ``condition`` and the
    values of ``set`` are SQL over ``t.<column>`` and ``s.<column>``."""

    kind: str
    action: str
    condition: str = "true"
    set: Mapping[str, str] = field(default_factory=dict)


def merge(table: Table, source: DataFrame, on: Mapping[str, str], clauses: Sequence[When]) -> Change:
    """MERGE INTO: the target left-joined with the source by key, and for each row the first clause whose condition holds; source rows
    without a target, which an anti join finds, only where something is inserted. A target row comes once for each source row
    that matches it: a window over the join's own partitioning counts its changes, of which there may be one, and keeps one copy of an
    unchanged row. NULL keys match nothing."""
    rows = table.rows.select(F.struct(*table.names).alias("t"), *[F.col(k).alias(f"__t{i}") for i, k in enumerate(on)], F.monotonically_increasing_id().alias(ROWID))
    given = source.select(F.struct(*source.columns).alias("s"), *[F.col(v).alias(f"__s{i}") for i, v in enumerate(on.values())])
    cond = [F.col(f"__t{i}") == F.col(f"__s{i}") for i in range(len(on))]
    joined = rows.join(given, cond, "left").withColumn("__state", F.when(F.col("s").isNotNull(), "matched").otherwise("not_matched_by_source"))
    one = W.partitionBy(*[f"__t{i}" for i in range(len(on))], ROWID)
    acted = _acted(joined, clauses).withColumn("__changes", F.count_if(F.col("__action").isin("update", "delete")).over(one)).withColumn("__copy", F.row_number().over(one.orderBy("__action")))
    acted = acted.where("__action <> 'keep' OR (__changes = 0 AND __copy = 1)")
    if any(c.kind == "not_matched" and c.action == "insert" for c in clauses):
        fresh = given.join(rows.select(*[f"__t{i}" for i in range(len(on))]), cond, "left_anti").withColumn("t", F.lit(None).cast(rows.schema["t"].dataType)).withColumn("__state", F.lit("not_matched"))
        fresh = _acted(fresh, clauses).where("__action = 'insert'").withColumn("__changes", F.lit(1).cast("long"))
        acted = acted.select("t", "s", "__clause", "__action", "__changes").unionByName(fresh.select("t", "s", "__clause", "__action", "__changes"))
    columns = []
    for d in table.columns:
        v = F.col(f"t.{d.name}")
        for k, c in enumerate(clauses):
            if c.action in ("update", "insert"):
                new = F.expr(c.set[d.name]) if d.name in c.set else F.expr(d.default) if c.action == "insert" and d.default else F.lit(None) if c.action == "insert" else F.col(f"t.{d.name}")
                v = F.when(F.col("__clause") == k, new.cast(d.kind)).otherwise(v)
        columns.append(F.when(F.col("__changes") > 1, _fail("MERGE changes a row a second time", d.kind)).otherwise(v).alias(d.name))
    action = F.col("__action")
    flagged = acted.select(*columns, (action != "delete").alias(LIVE), (action != "keep").alias(CHANGED), F.upper(action).alias("merge_action"))
    return Change.of(table, verified(table, flagged, (LIVE, CHANGED, "merge_action")), ("merge_action",))


def _acted(rows: DataFrame, clauses: Sequence[When]) -> DataFrame:
    """Add the number of the clause that applies to each row (t, s, __state), and its action."""
    clause, action = F.lit(None).cast("int"), F.lit("keep")
    for k in reversed(range(len(clauses))):
        c = clauses[k]
        clause = F.when((F.col("__state") == c.kind) & F.coalesce(F.expr(c.condition), F.lit(False)), F.lit(k)).otherwise(clause)
    for k, c in enumerate(clauses):
        if c.action != "nothing":
            action = F.when(F.col("__clause") == k, c.action).otherwise(action)
    return rows.withColumn("__clause", clause).withColumn("__action", action)
