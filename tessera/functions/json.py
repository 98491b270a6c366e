"""JSON functions over documents that are text.

Access and construction are built-in expressions. Exact-text access and the jsonb normal form (keys by length then bytes, the last of equal
keys, numbers as written) have no built-in equivalent: they are Arrow UDFs, which work on whole batches.
"""

from __future__ import annotations

import json as _json
import re

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tessera.session import ship_package


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


class _Number(str):
    """A number as it is written."""


class Raw:
    """A column that holds JSON documents, which construction takes over as they are."""

    def __init__(self, c: Column):
        self.c = c


class On:
    """What ON EMPTY or ON ERROR gives: NULL, ERROR, an empty container, or a default value."""

    def __init__(self, what: str, value: Column):
        self.what, self.value = what, value


def _malformed(text: str) -> ValueError:
    return ValueError(f"invalid input syntax for type json: {text[:40]!r}")


def _parse(text: str):
    return _json.loads(text, parse_float=_Number, parse_int=_Number, object_pairs_hook=lambda p: dict(p))


def _write(v, sep: str, colon: str, key=None) -> str:
    if isinstance(v, dict):
        items = sorted(v.items(), key=key) if key else v.items()
        return "{" + sep.join(f"{_json.dumps(k, ensure_ascii=False)}{colon}{_write(x, sep, colon, key)}" for k, x in items) + "}"
    if isinstance(v, list):
        return "[" + sep.join(_write(x, sep, colon, key) for x in v) + "]"
    return str(v) if isinstance(v, _Number) else _json.dumps(v, ensure_ascii=False)


def jsonb_text(text: str | None) -> str | None:
    """The normal form of a document; an error if it is none."""
    if text is None:
        return None
    return _write(_parse(text), ", ", ": ", key=lambda kv: (len(kv[0].encode()), kv[0].encode()))


_ITEM = re.compile(r'\s*(?:"((?:[^"\\]|\\.)*)"|([^,{}"]+?))\s*(?:,|$)')


def text_array(text: str) -> list[str]:
    """The items of a text array ``{a,0,"b c"}``."""
    return [m[1].replace('\\"', '"').replace("\\\\", "\\") if m[1] is not None else m[2] for m in _ITEM.finditer(text.strip()[1:-1])]


_BLANK = re.compile(r"\s*")


#: Reads the value that begins at a place, and tells its end.
_value = _json.JSONDecoder(strict=False).raw_decode


def _member(text: str, step: str | int) -> str | None:
    """The exact text of a member or element; of equal keys the last. The whole document is read, so a malformed one is an error."""
    try:
        at = _BLANK.match(text).end()
        if text[at] not in "{[":
            _, end = _value(text, at)
            if text[end:].strip():
                raise _malformed(text)
            return None
        is_object = text[at] == "{"
        k, spans, found = _BLANK.match(text, at + 1).end(), [], None
        while text[k] not in "}]":
            key = None
            if is_object:
                key, end = _value(text, k)
                k = _BLANK.match(text, end).end()
                if not isinstance(key, str) or text[k] != ":":
                    raise _malformed(text)
                k = _BLANK.match(text, k + 1).end()
            _, end = _value(text, k)
            if is_object and key == step:
                found = (k, end)
            elif not is_object:
                spans.append((k, end))
            k = _BLANK.match(text, end).end()
            if text[k] == ",":
                k = _BLANK.match(text, k + 1).end()
                if text[k] in "}]":
                    raise _malformed(text)
            elif text[k] not in "}]":
                raise _malformed(text)
        if text[k] != ("}" if is_object else "]") or text[k + 1 :].strip():
            raise _malformed(text)
    except (IndexError, _json.JSONDecodeError):
        raise _malformed(text) from None
    if not is_object:
        try:
            found = spans[int(step)]
        except (ValueError, IndexError):
            return None
    return found and text[found[0] : found[1]]


def _path(text: str | None, steps: list) -> str | None:
    """The exact text at a path; a document that is none is an error that names it."""
    if text is not None and not steps:
        _member(text, 0)
        return text.strip()
    for s in steps:
        if text is None:
            return None
        text = _member(text, s)
    return text


def path_udf():
    """(document, kinds, steps): the exact text at a path of keys (s) and places (i)."""
    ship_package(SparkSession.active())

    @F.pandas_udf("string")
    def run(docs: pd.Series, kinds: pd.Series, steps: pd.Series) -> pd.Series:
        return pd.Series([_path(d, [int(s) if k == "i" else s for k, s in zip(ks, ss, strict=True)]) for d, ks, ss in zip(docs, kinds, steps, strict=True)], dtype=object)

    return run


def jsonb_udf():
    ship_package(SparkSession.active())

    @F.pandas_udf("string")
    def run(docs: pd.Series) -> pd.Series:
        return docs.map(jsonb_text)

    return run


def unique_udf():
    ship_package(SparkSession.active())

    @F.pandas_udf("boolean")
    def run(docs: pd.Series) -> pd.Series:
        return docs.map(_unique_keys)

    return run


def _series(fn):
    ship_package(SparkSession.active())

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else fn(x))

    return run


def get(doc, step: str | int) -> Column:
    """``doc -> step``: the exact text of a member (str) or element (int)."""
    return _series(lambda x: _path(x, [step]))(_c(doc))


def get_path(doc, *steps: str) -> Column:
    """``doc #> '{..}'`` and JSON_EXTRACT_PATH: exact text."""
    return _series(lambda x: _path(x, list(steps)))(_c(doc))


def _jsonpath(steps) -> str:
    return "$" + "".join(f"[{s}]" if isinstance(s, int) or str(s).isdigit() else f"['{s}']" for s in steps)


def get_text(doc, *steps: str | int) -> Column:
    """``->>``, ``#>>`` and JSON_EXTRACT_PATH_TEXT: the text of a scalar. Built in."""
    return F.get_json_object(_c(doc), _jsonpath(steps))


def jsonb(doc) -> Column:
    """``x::jsonb``: the normal form."""
    return _series(jsonb_text)(_c(doc))


def json(doc) -> Column:
    """``x::json``: checked, the text kept."""
    doc = _c(doc)
    return F.when(F.parse_json(doc).isNotNull() | doc.isNull(), doc)


def jsonb_get_path(doc, *steps: str) -> Column:
    return _series(lambda x: jsonb_text(_path(x, list(steps))))(_c(doc))


def typeof(doc) -> Column:
    """JSON_TYPEOF, from the schema of the variant."""
    s = F.schema_of_variant(F.parse_json(_c(doc)))
    return (
        F.when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array").when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s == "VOID", "null").when(s.isNotNull(), "number")
    )


def array_length(doc) -> Column:
    """JSON_ARRAY_LENGTH: an error unless the document is an array."""
    doc = _c(doc)
    n = F.json_array_length(doc)
    return F.when(doc.isNotNull() & n.isNull(), F.raise_error(F.lit("cannot get array length of a non-array")).cast("bigint")).otherwise(n.cast("bigint"))


def quote(x) -> Column:
    """A value as JSON text: strings quoted, numbers and booleans bare, NULL null; documents come in Raw."""
    if isinstance(x, Raw):
        return F.coalesce(x.c, F.lit("null"))
    x = _c(x)
    body = F.to_json(F.array(x))
    return F.coalesce(F.when(x.isNotNull(), F.substr(body, F.lit(2), F.length(body) - 2)), F.lit("null"))


def key(x) -> Column:
    """A key as JSON text; a NULL one is an error."""
    x = _c(x)
    return quote(F.coalesce(x.cast("string"), F.raise_error(F.lit("field name must not be null")).cast("string")))


to_json = quote


def build_object(*pairs, sep: str = ", ", colon: str = " : ") -> Column:
    """JSON_BUILD_OBJECT(k, v, ..) with its spacing ``{"k" : v, ..}``."""
    items = [F.concat(quote(_c(pairs[k]).cast("string")), F.lit(colon), quote(pairs[k + 1])) for k in range(0, len(pairs), 2)]
    return F.concat(F.lit("{"), F.concat_ws(sep, *items), F.lit("}")) if items else F.lit("{}")


def build_array(*xs) -> Column:
    """JSON_BUILD_ARRAY: ``[1, "a"]``."""
    return F.concat(F.lit("["), F.concat_ws(", ", *map(quote, xs)), F.lit("]")) if xs else F.lit("[]")


def jsonb_build_object(*pairs) -> Column:
    return jsonb(build_object(*pairs))


def jsonb_build_array(*xs) -> Column:
    return jsonb(build_array(*xs))


def object_from_text(keys: str, values: str | None = None) -> str:
    """JSON_OBJECT('{k,v,..}') or (keys, values) of constant text arrays."""
    k = text_array(keys)
    pairs = zip(k, text_array(values), strict=True) if values is not None else zip(k[::2], k[1::2], strict=True)
    return "{" + ", ".join(f"{_json.dumps(a, ensure_ascii=False)} : {_json.dumps(b, ensure_ascii=False)}" for a, b in pairs) + "}"


def _items(array: Column) -> Column:
    """The items of text arrays ``{a,"b c",NULL}``; an unquoted NULL is a null."""
    found = F.regexp_extract_all(array, F.lit(r'"((?:[^"\\]|\\.)*)"|([^,{}"]+)'), F.lit(0))
    bare = lambda x: F.regexp_replace(F.substr(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1")
    return F.transform(found, lambda x: F.when(F.startswith(x, F.lit('"')), bare(x)).when(F.upper(F.trim(x)) == "NULL", None).otherwise(F.trim(x)))


def object_of_texts(keys, values=None) -> Column:
    """JSON_OBJECT over columns of text arrays: pairs in one, or keys and values in two. Built in."""
    keys = _c(keys)
    k = _items(keys)
    if values is None:
        n = F.size(k)
        v = F.filter(k, lambda x, i: i % 2 == 1)
        odd = n % 2 == 1
        k = F.filter(k, lambda x, i: i % 2 == 0)
    else:
        v = _items(_c(values))
        odd = F.size(k) != F.size(v)
    text = lambda x: F.coalesce(F.concat(F.lit('"'), F.regexp_replace(x, r'(["\\])', r"\\$1"), F.lit('"')), F.lit("null"))
    whole = F.concat(F.lit("{"), F.array_join(F.zip_with(k, v, lambda a, b: F.concat(text(a), F.lit(" : "), text(b))), ", "), F.lit("}"))
    return F.when(odd, F.raise_error(F.lit("array must have even number of elements")).cast("string")).otherwise(whole)


def json_object(pairs: list[tuple], absent_on_null: bool = False, unique: bool = False) -> Column:
    """JSON_OBJECT(k VALUE v .. [NULL | ABSENT ON NULL] [WITH UNIQUE KEYS])."""
    items = []
    for k, v in pairs:
        item = F.concat(key(k), F.lit(" : "), quote(v))
        there = (v.c if isinstance(v, Raw) else _c(v)).isNotNull()
        items.append(F.when(there, item) if absent_on_null else item)
    text = F.concat(F.lit("{"), F.concat_ws(", ", *items), F.lit("}"))
    if not unique:
        return text
    keys = F.array(*(_c(k).cast("string") for k, _ in pairs))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.raise_error(F.lit("duplicate JSON object key value")).cast("string")).otherwise(text)


def json_array(xs: list, absent_on_null: bool = True) -> Column:
    """JSON_ARRAY(v .. [ABSENT | NULL ON NULL])."""
    items = [F.when((x.c if isinstance(x, Raw) else _c(x)).isNotNull(), quote(x)) if absent_on_null else quote(x) for x in xs]
    return F.concat(F.lit("["), F.concat_ws(", ", *items), F.lit("]"))


def _mode(path: str) -> tuple[str, bool, str | None, str]:
    """(path to the first wildcard, strict, the wildcard's kind, the path behind it) of a SQL/JSON path, in the notation of variants."""
    m = re.match(r"\s*(strict|lax)?\s*(\$.*)", path, re.S)
    if not m:
        raise ValueError(f"invalid JSON path {path!r}")
    strict, body = m[1] == "strict", m[2].strip()
    w = re.search(r"\[\*\]|\.\*", body)
    if w is None:
        return body, strict, None, ""
    return body[: w.start()], strict, "array" if w[0] == "[*]" else "members", "$" + body[w.end() :]


def _given(on, kind: str, message: str) -> Column:
    if isinstance(on, On):
        if on.what == "ERROR":
            return F.raise_error(F.lit(message)).cast(kind)
        if on.what in ("TRUE", "FALSE"):
            return F.lit(on.what == "TRUE")
        if on.what in ("NULL", "UNKNOWN"):
            return F.lit(None).cast(kind)
        if on.what.startswith("EMPTY"):
            return F.lit("{}" if on.what.endswith("OBJECT") else "[]")
        return on.value.cast(kind)
    return _c(on).cast(kind)


def _matches(v: Column, path: str) -> tuple[Column, bool]:
    """The variants that a path finds, as an array, and whether the path is strict. One wildcard is allowed, and one more behind it."""
    head, strict, wild, rest = _mode(path)
    one = F.try_variant_get(v, head, "variant")
    if wild is None:
        found = F.filter(F.array(one), lambda x: x.isNotNull())
        if not strict:
            # lax: a member of an array is that of its elements
            parent, _, last = head.rpartition(".")
            if parent and last and "[" not in last:
                inner = F.filter(F.transform(F.try_variant_get(v, parent, "array<variant>"), lambda x: F.try_variant_get(x, f"$.{last}", "variant")), lambda x: x.isNotNull())
                found = F.when(F.size(found) > 0, found).otherwise(F.coalesce(inner, found))
        return found, strict
    none = F.array().cast("array<variant>")
    items = F.try_variant_get(one, "$", "array<variant>") if wild == "array" else F.map_values(F.try_variant_get(one, "$", "map<string,variant>"))
    if wild == "array" and not strict:
        items = F.coalesce(items, F.filter(F.array(one), lambda x: x.isNotNull()))
    items = F.coalesce(items, none)
    if rest != "$":
        items = F.flatten(F.transform(items, lambda x: _matches(x, rest)[0]))
    return items, strict


def value(doc, path: str, kind: str = "string", on_empty=None, on_error=None) -> Column:
    """JSON_VALUE(doc, path RETURNING kind .. ON EMPTY .. ON ERROR): a scalar. More than one match, a container, a malformed document and, on
    a strict path, no match are errors, which give NULL unless something else is said."""
    doc = _c(doc)
    v = F.try_parse_json(doc)
    found, strict = _matches(v, path)
    first = F.try_element_at(found, F.lit(1))
    shape = F.schema_of_variant(first)
    broken = (F.size(found) > 1) | F.startswith(shape, F.lit("OBJECT")) | F.startswith(shape, F.lit("ARRAY"))
    error = _given(on_error, kind, "JSON path item is no scalar")
    empty = error if strict else _given(on_empty, kind, "no SQL/JSON item found")
    scalar = F.try_variant_get(first, "$", kind)
    out = F.when(F.size(found) == 0, empty).when(F.coalesce(broken, F.lit(False)), error).when(shape == "VOID", F.lit(None).cast(kind)).otherwise(F.coalesce(scalar, error))
    return F.when(doc.isNotNull(), F.when(v.isNull(), error).otherwise(out))


def exists(doc, path: str, on_error=None) -> Column:
    """JSON_EXISTS: a JSON null counts; a malformed document is an error, which gives false unless something else is said."""
    doc = _c(doc)
    v = F.try_parse_json(doc)
    found, strict = _matches(v, path)
    error = _given(on_error, "boolean", "invalid JSON") if on_error is not None else F.lit(False)
    there = F.size(found) > 0
    return F.when(doc.isNotNull(), F.when(v.isNull(), error).when(F.lit(strict) & ~there, error).otherwise(there))


def query(doc, path: str, wrapper: bool | str | None = None, keep_quotes: bool = True, on_empty=None, on_error=None) -> Column:
    """JSON_QUERY: a fragment as JSON text; WITH WRAPPER ("always", True) puts what is found in an array, WITH CONDITIONAL WRAPPER unless it is
    one container; OMIT QUOTES gives a string bare."""
    doc = _c(doc)
    v = F.try_parse_json(doc)
    found, strict = _matches(v, path)
    n, first = F.size(found), F.try_element_at(found, F.lit(1))
    one, several = F.to_json(first), F.concat(F.lit("["), F.array_join(F.transform(found, lambda x: F.to_json(x)), ","), F.lit("]"))
    shape = F.schema_of_variant(first)
    container = F.startswith(shape, F.lit("OBJECT")) | F.startswith(shape, F.lit("ARRAY"))
    error = _given(on_error, "string", "JSON path in JSON_QUERY should return a single item")
    empty = error if strict else _given(on_empty, "string", "no SQL/JSON item found")
    if not keep_quotes:
        one = F.when(shape == "STRING", F.try_variant_get(first, "$", "string")).otherwise(one)
    if wrapper == "conditional":
        one = F.when((n == 1) & container, one).otherwise(several)
    elif wrapper:
        one = several
    else:
        one = F.when(n > 1, error).otherwise(one)
    return F.when(doc.isNotNull(), F.when(v.isNull(), error).when(n == 0, empty).otherwise(one))


def is_json(doc, kind: str = "value") -> Column:
    """IS JSON [VALUE | SCALAR | ARRAY | OBJECT]."""
    doc = _c(doc)
    s = F.schema_of_variant(F.try_parse_json(doc))
    tests = {"value": s.isNotNull(), "object": s.startswith("OBJECT"), "array": s.startswith("ARRAY"), "scalar": ~(s.startswith("OBJECT") | s.startswith("ARRAY"))}
    return F.when(doc.isNotNull(), F.coalesce(tests[kind], F.lit(False)))


def _unique_keys(x: str | None) -> bool | None:
    if x is None:
        return None

    def hook(pairs):
        if len({k for k, _ in pairs}) != len(pairs):
            raise ValueError("repeated key")
        return dict(pairs)

    try:
        _json.loads(x, object_pairs_hook=hook)
    except ValueError:
        return False
    return True


def is_json_unique(doc) -> Column:
    """IS JSON WITH UNIQUE KEYS."""
    ship_package(SparkSession.active())

    @F.pandas_udf("boolean")
    def unique(s: pd.Series) -> pd.Series:
        return s.map(_unique_keys)

    return unique(_c(doc))
