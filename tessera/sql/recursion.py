"""Recursive queries that Spark's own recursion can't take: UNION, SEARCH and CYCLE, run round by round."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import recursive
from tessera.sql.lexer import Group, Token, split, words

_PATH = "__path"


@dataclass
class Cte:
    """A query of WITH: its name, columns, tokens, and the words of SEARCH and CYCLE."""

    name: str
    columns: list[str]
    body: list
    search: list = field(default_factory=list)
    cycle: list = field(default_factory=list)

    def parts(self) -> tuple[list, list, bool] | None:
        """(first part, recursive part, whether rows may repeat) of a query that names itself."""
        at = next((k for k, t in enumerate(self.body) if t.kind == "name" and t.word == "UNION"), None)
        if at is None or not mentions(self.body[at:], self.name):
            return None
        every = words(self.body, at + 1, "ALL")
        return self.body[:at], self.body[at + 1 + every :], every


def mentions(items: list, name: str) -> bool:
    return any(mentions(t.items, name) if isinstance(t, Group) else t.kind in ("name", "ident") and t.text.lower() == name.lower() for t in items)


def parse(items: list) -> tuple[list[Cte], list] | None:
    """The queries of WITH RECURSIVE and what follows them; None if Spark can run it as it is."""
    if not words(items, 0, "WITH", "RECURSIVE"):
        return None
    k, out = 2, []
    while True:
        name, columns = items[k].text, []
        k += 1
        if isinstance(items[k], Group):
            columns = [p[0].text for p in split(items[k].items)]
            k += 1
        cte = Cte(name, columns, items[k + 1].items)
        k += 2
        for word, place in (("SEARCH", "search"), ("CYCLE", "cycle")):
            if words(items, k, word):
                end = next(j for j in range(k + 1, len(items) + 1) if j == len(items) or items[j].word in ("SELECT", "CYCLE", "WITH") or items[j].word == "," and j + 2 < len(items) and (words(items, j + 2, "AS") or isinstance(items[j + 2], Group)))
                setattr(cte, place, items[k + 1 : end])
                k = end
        out.append(cte)
        if k < len(items) and items[k].word == ",":
            k += 1
            continue
        break
    if not any(c.search or c.cycle or (p := c.parts()) and not p[2] for c in out):
        return None
    return out, items[k:]


def run(spark: SparkSession, found: tuple[list[Cte], list], query: Callable[[list], DataFrame]) -> DataFrame:
    """Every query becomes a view for those after it; the views are gone when the result's plan is made."""
    ctes, rest = found
    before = {c.name: spark.table(c.name) for c in ctes if spark.catalog.tableExists(c.name)}
    try:
        for c in ctes:
            _result(spark, c, query).createOrReplaceTempView(c.name)
        return query(rest)
    finally:
        for c in ctes:
            if c.name in before:
                before[c.name].createOrReplaceTempView(c.name)
            else:
                spark.catalog.dropTempView(c.name)


def _result(spark: SparkSession, c: Cte, query: Callable[[list], DataFrame]) -> DataFrame:
    parts = c.parts()
    if parts is None:
        out = query(c.body)
        return out.toDF(*c.columns) if c.columns else out
    first, step, every = parts
    base = query(first)
    base = base.toDF(*c.columns) if c.columns else base
    names = base.columns
    base = base.select(*[F.col(f"`{f.name}`").cast("bigint") if f.dataType.simpleString() in ("tinyint", "smallint", "int") else F.col(f"`{f.name}`") for f in base.schema.fields])

    def typed(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in base.schema.fields])

    if not (c.search or c.cycle):
        def next_rows(front: DataFrame) -> DataFrame:
            front.createOrReplaceTempView(c.name)
            return typed(query(step).toDF(*names))

        return recursive.recursive_union(base, next_rows)
    if not every:
        raise NotImplementedError("SEARCH and CYCLE need UNION ALL")
    return _walked(spark, c, base, step, names, typed, query)


def _listed(items: list) -> tuple[list[str], int]:
    """Names up to SET, and the place of SET."""
    at = next(k for k, t in enumerate(items) if t.word == "SET")
    return [p[0].text for p in split(items[:at])], at


def _carrying(step: list, name: str, columns: list[str]) -> list:
    """The recursive part with further columns of the recursive table in its result."""
    start = next(k for k, t in enumerate(step) if t.word == "FROM" and t.kind == "name")
    at = next(k for k in range(start, len(step)) if not isinstance(step[k], Group) and step[k].kind in ("name", "ident") and step[k].text.lower() == name.lower())
    alias = step[at].text
    if words(step, at + 1, "AS"):
        alias = step[at + 2].text
    elif at + 1 < len(step) and step[at + 1].kind == "name" and step[at + 1].word not in ("JOIN", "WHERE", "INNER", "LEFT", "RIGHT", "FULL", "CROSS", "NATURAL", "ON", "GROUP", "ORDER", "LIMIT"):
        alias = step[at + 1].text
    more = [t for c in columns for t in (Token("op", ","), Token("name", alias), Token("op", "."), Token("name", c))]
    return [*step[:start], *more, *step[start:]]


def _walked(spark, c: Cte, base: DataFrame, step: list, names: list[str], typed, query) -> DataFrame:
    """SEARCH keeps the keys on the way to each row and its depth, CYCLE the keys by which a row is met again: such a row is marked and goes no
    further. The order of SEARCH is that way (depth first) or the depth and the keys (breadth first)."""
    search = cycle = None
    if c.search:
        by, at = _listed(c.search[3:] if words(c.search, 1, "FIRST", "BY") else c.search)
        search = (c.search[0].word == "DEPTH", by, c.search[3:][at + 1].text)
    if c.cycle:
        by, at = _listed(c.cycle)
        rest = c.cycle[at + 1 :]
        mark, yes, no = rest[0].text, F.lit(True), F.lit(False)
        if words(rest, 1, "TO"):
            yes, no = (F.expr(rest[k].text) for k in (2, 4))
        cycle = (by, mark, yes, no, rest[next(k for k, t in enumerate(rest) if t.word == "USING") + 1].text)
    struct = lambda by: F.struct(*[F.col(f"`{x}`") for x in by])
    extra = [(x, by) for x, by in ((_PATH + "_s", search and search[1]), (_PATH + "_c", cycle and cycle[0])) if by]
    front = base
    for x, by in extra:
        front = front.withColumn(x, F.array(struct(by)))
    front = front.withColumn("__met", F.lit(False))
    carried = [x for x, _ in extra]
    tokens = _carrying(step, c.name, carried)
    schema = front.schema

    def next_rows(rows: DataFrame) -> DataFrame:
        rows.where("NOT __met").drop("__met").createOrReplaceTempView(c.name)
        made = query(tokens).toDF(*names, *carried)
        made = made.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields if f.name in names], *carried)
        met = F.array_contains(_PATH + "_c", struct(cycle[0])) if cycle else F.lit(False)
        made = made.withColumn("__met", met)
        for x, by in extra:
            made = made.withColumn(x, F.concat(x, F.array(struct(by))))
        return made

    out = recursive.rounds(front, next_rows)
    columns = [F.col(f"`{n}`") for n in names]
    if search:
        keys = F.col(_PATH + "_s")
        columns.append((keys if search[0] else F.struct(F.size(keys).alias("depth"), F.element_at(keys, -1).alias("keys"))).alias(search[2]))
    if cycle:
        text = F.concat(F.lit("{"), F.array_join(F.transform(_PATH + "_c", lambda s: F.concat(F.lit("("), F.concat_ws(",", *[F.coalesce(s[x].cast("string"), F.lit("")) for x in cycle[0]]), F.lit(")"))), ","), F.lit("}"))
        columns += [F.when(F.col("__met"), cycle[2]).otherwise(cycle[3]).alias(cycle[1]), text.alias(cycle[4])]
    return out.select(*columns)
