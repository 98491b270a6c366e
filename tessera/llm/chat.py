"""Chat formatting: layouts are told apart by a fingerprint of their nested field paths.

A fingerprint is the SHA-256 of the sorted nested field paths of a layout, types left out. MAPPINGS declares, for each known
layout, how its fields become canonical turns (role, text). JSON records are told apart one by one, so one column may mix
prompt, instruction and message layouts: a record's own paths, down to the members of its messages, are read from the
variant, and the known ones among them give its fingerprint. Further fields (ids, sources, names) don't hide a layout: where the
known paths are no layout's as a whole, the largest layout that the record holds counts. Tables are told apart in the same
way by their schema. What has no layout is reported by unknown_layouts().

The template marks turns and escapes its control strings inside texts; parse() reads a formatted conversation back
exactly. All of it is built-in Spark functions.

A conversation of any number of turns is gathered in two steps: blocks of BLOCK turns are joined to one string each before
the blocks of a conversation meet, so one task never holds the rows of a hot conversation, only its formatted text, which
is one value of the result.

Defined results: null roles and texts are empty; turns are ordered by turn, then role, then text, null turns first; repeated
rows are repeated turns; a null conv_id is a conversation of its own; an empty table has no conversations; unknown
columns are ignored; long texts stay whole; a record of an unknown layout, or that is no JSON object, has null turns; a list of
messages without elements is an unknown layout; messages whose content is a list of parts say the parts' texts, joined by newlines; of
equally large layouts in a record the first by name counts.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Turns that are joined to one string before the blocks of a conversation meet.
BLOCK = 64

#: The template's control strings. The text between two of them never holds any: escape() sees to it.
OPEN, CLOSE, HEAD = "<turn>", "</turn>", "### "
#: (control string, its escaped form). The escape character comes first; every escape is the character and a digit.
ESCAPES = (("\\", "\\0"), (OPEN, "\\1"), (CLOSE, "\\2"), (HEAD, "\\3"))
#: A role is one line.
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\4"))


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: the field paths that make its fingerprint and, for records, a SQL expression over ``r``
    (the record as a variant) that gives array<struct<role, text>>."""

    name: str
    paths: tuple[str, ...]
    turns: str = ""


def _get(path: str) -> str:
    return f"try_variant_get(r, '$.{path}', 'string')"


def _said(m: str, member: str) -> str:
    """The text of a message's member: a string, or the texts of a list of parts."""
    whole = f"try_variant_get({m}, '$.{member}', 'array<variant>')"
    return f"if({whole} IS NULL, try_variant_get({m}, '$.{member}', 'string'), array_join(transform({whole}, p -> coalesce(try_variant_get(p, '$.text', 'string'), '')), '\\n'))"


def _messages(array: str, role: str, text: str) -> str:
    return f"transform(try_variant_get(r, '$.{array}', 'array<variant>'), m -> named_struct('role', lower(try_variant_get(m, '$.{role}', 'string')), 'text', {_said('m', text)}))"


def _pair(user: str, assistant: str, system: str | None = None) -> str:
    pair = f"array(named_struct('role', 'user', 'text', {user}), named_struct('role', 'assistant', 'text', {assistant}))"
    if system is None:
        return pair
    return f"concat(if({system} IS NULL, CAST(array() AS array<struct<role:string,text:string>>), array(named_struct('role', 'system', 'text', {system}))), {pair})"


#: Declarative mappings. A table of turn rows has its turns gathered by key, one of JSON rows has a record for each key; the others hold
#: a conversation in a record.
MAPPINGS: tuple[Mapping, ...] = (
    Mapping("turn_rows", ("conv_id", "role", "text", "turn")),
    Mapping("message_rows", ("conv_id", "messages", "messages[].content", "messages[].role")),
    Mapping("json_rows", ("conv_id", "record")),
    Mapping("messages", ("messages", "messages[].content", "messages[].role"), _messages("messages", "role", "content")),
    Mapping("conversations", ("conversations", "conversations[].from", "conversations[].value"), f"transform({_messages('conversations', 'from', 'value')}, t -> named_struct('role', CASE t.role WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE t.role END, 'text', t.text))"),
    Mapping("instruction", ("input", "instruction", "output"), _pair(f"if(coalesce({_get('input')}, '') = '', {_get('instruction')}, concat({_get('instruction')}, '\\n\\n', {_get('input')}))", _get("output"))),
    Mapping("instruction_only", ("instruction", "output"), _pair(_get("instruction"), _get("output"))),
    Mapping("prompt_completion", ("completion", "prompt"), _pair(_get("prompt"), _get("completion"))),
    Mapping("prompt_response", ("prompt", "response"), _pair(_get("prompt"), _get("response"))),
    Mapping("system_prompt_response", ("prompt", "response", "system"), _pair(_get("prompt"), _get("response"), _get("system"))),
    Mapping("question_answer", ("answer", "question"), _pair(_get("question"), _get("answer"))),
)


def _digest(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


FINGERPRINTS = {_digest(m.paths): m for m in MAPPINGS}
_KNOWN = frozenset(p for m in MAPPINGS for p in m.paths)


def field_paths(kind: T.DataType, at: str = "") -> set[str]:
    """Nested field paths of a schema: a.b for a member, a[] for the elements of an array."""
    out: set[str] = set()
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            p = f"{at}.{f.name}" if at else f.name
            out |= {p} | field_paths(f.dataType, p)
    elif isinstance(kind, T.ArrayType):
        out |= field_paths(kind.elementType, f"{at}[]")
    return out


def layout(schema: T.StructType) -> Mapping | None:
    """The mapping of a table: by the fingerprint of its known paths; if further known fields came in, by the largest
    layout that the table holds whole."""
    paths = field_paths(schema) & _KNOWN
    if found := FINGERPRINTS.get(_digest(paths)):
        return found
    held = [m for m in MAPPINGS if set(m.paths) <= paths]
    return max(held, key=lambda m: len(m.paths), default=None)


def record_paths(r: Column) -> Column:
    """The nested field paths of a record (a variant object): its members, and a[].b for the members of the elements of those arrays
    that a mapping knows. Null if it is no object."""
    top, none = F.map_keys(F.try_variant_get(r, "$", "map<string,variant>")), F.array().cast("array<string>")

    def below(name: str) -> Column:
        members = F.transform(F.try_variant_get(r, f"$.{name}", "array<variant>"), lambda m: F.coalesce(F.map_keys(F.try_variant_get(m, "$", "map<string,variant>")), none))
        return F.transform(F.coalesce(F.array_distinct(F.flatten(members)), none), lambda k: F.concat(F.lit(f"{name}[]."), k))

    out = [top, *map(below, sorted({p.split("[]")[0] for p in _KNOWN if "[]" in p}))]
    return F.when(top.isNotNull(), F.array_sort(F.array_distinct(F.concat(*out))))


def record_turns(records: DataFrame, column: str) -> DataFrame:
    """Add ``fingerprint`` and ``turns`` (array<struct<role, text>>) for a column of JSON records of mixed layouts. The fingerprint is the
    mapping's for a known layout, and that of all the record's paths for an unknown one."""
    out = [c for c in records.columns if c not in ("fingerprint", "turns")]
    paths = records.withColumn("__r", F.expr(f"try_parse_json(`{column}`)")).withColumn("__paths", record_paths(F.col("__r")))
    known = F.array_intersect("__paths", F.array(*map(F.lit, sorted(_KNOWN))))
    of_records = sorted((m for m in MAPPINGS if m.turns), key=lambda m: (len(m.paths), m.name), reverse=True)
    lookup = F.create_map(*(F.lit(x) for m in of_records for x in (_digest(m.paths), m.name)))
    # the largest layout that the record holds, where its known paths are no layout's
    held = F.lit(None).cast("string")
    for m in sorted(of_records, key=lambda m: (-len(m.paths), m.name), reverse=True):
        held = F.when(F.size(F.array_except(F.array(*map(F.lit, m.paths)), known)) == 0, F.lit(m.name)).otherwise(held)
    named = paths.withColumn("__layout", F.when(F.col("__paths").isNotNull(), F.coalesce(F.try_element_at(lookup, F.sha2(F.array_join(known, "\n"), 256)), held)))
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    fingerprint = F.sha2(F.array_join("__paths", "\n"), 256)
    for m in of_records:
        turns = F.when(F.col("__layout") == m.name, F.expr(m.turns.replace("(r,", "(__r,"))).otherwise(turns)
        fingerprint = F.when(F.col("__layout") == m.name, F.lit(_digest(m.paths))).otherwise(fingerprint)
    return named.withColumn("fingerprint", fingerprint).withColumn("turns", turns).select(*out, "fingerprint", "turns")


def unknown_layouts(records: DataFrame, column: str) -> DataFrame:
    """(fingerprint, paths, n): the records of each layout that no mapping knows, those that are no JSON object under a null fingerprint.
    Counts are added up before they are shuffled."""
    told = record_turns(records.select(F.col(column).alias("record")), "record").where("turns IS NULL")
    return told.groupBy("fingerprint", record_paths(F.expr("try_parse_json(record)")).alias("paths")).agg(F.count("*").alias("n"))


def escape(c: Column, escapes=ESCAPES) -> Column:
    for control, code in escapes:
        c = F.replace(c, F.lit(control), F.lit(code))
    return c


def unescape(c: Column, escapes=ESCAPES) -> Column:
    for control, code in reversed(escapes):
        c = F.replace(c, F.lit(code), F.lit(control))
    return c


def turn_string(role: Column, text: Column) -> Column:
    """One turn in the template: marker, role line, text, marker."""
    return F.concat(F.lit(f"{OPEN}{HEAD}"), escape(F.coalesce(role, F.lit("")), ROLE_ESCAPES), F.lit("\n"), escape(F.coalesce(text, F.lit(""))), F.lit(f"{CLOSE}\n"))


def _spread(df: DataFrame, text: str) -> DataFrame:
    """Turn rows of conversations that hold their turns."""
    return df.select("conv_id", F.posexplode("turns").alias("turn", "m")).select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("m.role").alias("role"), F.col(f"m.{text}").alias("text"))


def _rows(df: DataFrame) -> DataFrame:
    """Turn rows (conv_id, turn, role, text) of a table of a known layout."""
    m = layout(df.schema)
    if m is None:
        raise ValueError("no mapping for the fields of this table")
    if m.name == "turn_rows":
        return df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    if m.name == "message_rows":
        return _spread(df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("messages").alias("turns")), "content")
    if m.name == "json_rows":
        return _spread(record_turns(df.select(F.col("conv_id").cast("long").alias("conv_id"), "record"), "record").where("turns IS NOT NULL"), "text")
    raise ValueError(f"layout {m.name} has no conversation key")


def _ordered(items: Column, field: str) -> Column:
    return F.array_join(F.transform(F.array_sort(items), lambda x: x[field]), "")


def format_chats(*tables: DataFrame) -> DataFrame:
    """(conv_id, formatted) of all conversations in tables of known layouts, each mapped by its fingerprint."""
    rows = _rows(tables[0])
    for t in tables[1:]:
        rows = rows.unionAll(_rows(t))
    # nulls come first in array_sort only through a flag
    turns = rows.select("conv_id", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).alias("block"), F.struct(F.col("turn").isNotNull().alias("k"), F.coalesce("turn", F.lit(0)).alias("turn"), turn_string(F.col("role"), F.col("text")).alias("s")).alias("t"))
    blocks = turns.groupBy("conv_id", "block").agg(_ordered(F.collect_list("t"), "s").alias("s"))
    return blocks.groupBy("conv_id").agg(_ordered(F.collect_list(F.struct("block", "s")), "s").alias("formatted"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation, unescaped."""
    raw = F.filter(F.split(formatted, f"{CLOSE}\n", -1), lambda x: x != "")
    start = len(OPEN) + len(HEAD)
    return F.transform(
        raw,
        lambda x: F.struct(
            unescape(F.substring_index(F.substring(x, start + 1, 2**31 - 1), "\n", 1), ROLE_ESCAPES).alias("role"),
            unescape(F.substring(x, F.instr(x, F.lit("\n")) + 1, F.lit(2**31 - 1))).alias("text"),
        ),
    )


def loss_text(turns: Column) -> Column:
    """All text under the loss mask: the assistant's, in order."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
