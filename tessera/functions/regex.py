"""Regular expressions: ``.`` matches a newline, matches are counted from 1, and only the given occurrence is changed.

Occurrences come from two built-in calls, all matches and what lies between them, so nothing leaves the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def flagged(pattern: str, flags: str = "") -> str:
    """The pattern with its flags: i and c for case, n or m for lines, s (the default) for ``.`` matching newlines, x for blanks."""
    on = {"s"}
    for f in flags:
        if f == "i":
            on.add("i")
        elif f == "c":
            on.discard("i")
        elif f in "nm":
            on.discard("s")
            on.add("m")
        elif f == "s":
            on.add("s")
        elif f == "x":
            on.add("x")
        elif f != "g":
            raise ValueError(f"invalid regular expression option: {f}")
    return f"(?{''.join(sorted(on))}){pattern}"


def matches(s, pattern: str, flags: str = "") -> Column:
    """``s ~ pattern`` (flags "i": ``~*``); ``!~`` is its negation."""
    return F.rlike(_c(s), F.lit(flagged(pattern, flags)))


def similar_pattern(pattern: str, escape: str = "\\") -> str:
    """The regular expression of a SIMILAR TO pattern: % and _ as in LIKE, the rest of SQL's metacharacters, anchored."""
    out, k, in_class = [], 0, False
    while k < len(pattern):
        c = pattern[k]
        if escape and c == escape and k + 1 < len(pattern):
            k += 1
            out.append(re.escape(pattern[k]))
        elif in_class:
            in_class = c != "]"
            out.append("\\\\" if c == "\\" else c)
        elif c == "[":
            in_class = True
            out.append(c)
        elif c == "%":
            out.append(".*")
        elif c == "_":
            out.append(".")
        elif c in "|*+?{}()":
            out.append("(?:" if c == "(" else c)
        else:
            out.append(re.escape(c))
        k += 1
    return f"(?s)^(?:{''.join(out)})$"


def similar_to(s, pattern: str, escape: str = "\\") -> Column:
    return F.rlike(_c(s), F.lit(similar_pattern(pattern, escape)))


def regexp_count(s, pattern: str, start: int = 1, flags: str = "") -> Column:
    return F.regexp_count(F.substr(_c(s), F.lit(start)), F.lit(flagged(pattern, flags))).cast("bigint")


def _all(s: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(s, F.lit(pattern), F.lit(group))


def _between(s: Column, pattern: str) -> Column:
    return F.split(s, pattern, -1)


def _sum_of_lengths(parts: Column, n) -> Column:
    return F.aggregate(F.slice(parts, F.lit(1), F.lit(n)), F.lit(0), lambda a, x: a + F.length(x))


def regexp_instr(s, pattern: str, start: int = 1, n: int = 1, endopt: int = 0, flags: str = "", group: int = 0) -> Column:
    """The place of the n-th match that starts at ``start`` or later (endopt 1: the place after it), or of a group of it; 0 if there is
    none. A group's place is found by matching the pattern with what stands before the group as a group of its own."""
    tail, p = F.substr(_c(s), F.lit(start)), flagged(pattern, flags)
    found = _all(tail, p)
    at = _sum_of_lengths(_between(tail, p), n) + _sum_of_lengths(found, n - 1) + start
    if group:
        if group > re.compile(pattern).groups:
            return F.when(_c(s).isNotNull(), F.lit(0)).cast("bigint")
        match = F.try_element_at(found, F.lit(n))
        head = F.regexp_extract(match, _headed(p, group), 1)
        at = at + F.length(head)
        part = F.regexp_extract(match, p, group)
        at = at + F.length(part) if endopt else at
    elif endopt:
        at = at + F.length(F.try_element_at(found, F.lit(n)))
    return F.when(F.size(found) < n, F.lit(0)).otherwise(at).cast("bigint")


def _headed(pattern: str, group: int) -> str:
    """A pattern whose first group is what stands before the given group, which stands outside of other groups."""
    flags = re.match(r"\(\?[a-z]+\)", pattern)[0]
    body, depth, seen, k = pattern[len(flags) :], 0, 0, 0
    while k < len(body):
        c = body[k]
        if c == "\\":
            k += 2
            continue
        if c == "[":
            k = body.index("]", k + 2)
        elif c == "(":
            capturing = not body.startswith("(?", k)
            seen += capturing
            if capturing and seen == group:
                if depth:
                    raise NotImplementedError("the place of a group within a group")
                return f"{flags}({body[:k]}){body[k:]}"
            depth += 1
        elif c == ")":
            depth -= 1
        k += 1
    raise ValueError(f"no group {group}")


def regexp_substr(s, pattern: str, start: int = 1, n: int = 1, flags: str = "", group: int = 0) -> Column:
    """The n-th match, or a group of it; NULL if there is none."""
    return F.try_element_at(_all(F.substr(_c(s), F.lit(start)), flagged(pattern, flags), group), F.lit(n))


def regexp_match(s, pattern: str, flags: str = "") -> Column:
    """The groups of the first match (the match itself if there are none) as a text array ``{a,b}``."""
    s, p = _c(s), flagged(pattern, flags)
    groups = re.compile(pattern).groups
    parts = [F.regexp_extract(s, p, k) for k in (range(1, groups + 1) if groups else [0])]
    quoted = [F.when(F.rlike(x, F.lit(r'^$|[\s{},"\\]')) | (F.upper(x) == "NULL"), F.concat(F.lit('"'), F.regexp_replace(x, r'(["\\])', r"\\$1"), F.lit('"'))).otherwise(x) for x in parts]
    return F.when(F.rlike(s, F.lit(p)), F.concat(F.lit("{"), F.concat_ws(",", *quoted), F.lit("}")))


def java_replacement(text: str) -> str:
    r"""A replacement with \1..\9 and \& in Java's notation."""
    out, k = [], 0
    while k < len(text):
        c = text[k]
        if c == "\\" and k + 1 < len(text):
            k += 1
            d = text[k]
            out.append(f"${d}" if d.isdigit() else "$0" if d == "&" else "\\\\" if d == "\\" else "\\" + d if d in "$" else d)
        elif c == "$":
            out.append("\\$")
        else:
            out.append(c)
        k += 1
    return "".join(out)


def regexp_replace(s, pattern: str, replacement: str, start: int = 1, n: int = 1, flags: str = "") -> Column:
    """The first match replaced; flag g or n = 0: all; n > 0: the n-th only; from ``start`` on."""
    s, p, r = _c(s), flagged(pattern, flags), java_replacement(replacement)
    head, tail = F.substr(s, F.lit(1), F.lit(start - 1)), F.substr(s, F.lit(start))
    if "g" in flags or n == 0:
        return F.concat(head, F.regexp_replace(tail, p, r))
    found, parts = _all(tail, p), _between(tail, p)
    changed = F.concat(
        F.array_join(F.transform(F.slice(parts, F.lit(1), F.lit(n)), lambda x, i: F.concat(x, F.when(i == n - 1, F.lit("")).otherwise(F.try_element_at(found, i.cast("int") + 1)))), ""),
        F.regexp_replace(F.try_element_at(found, F.lit(n)), p, r),
        F.array_join(F.transform(F.slice(parts, F.lit(n + 1), F.greatest(F.size(parts) - n, F.lit(0))), lambda x, i: F.concat(x, F.coalesce(F.try_element_at(found, i.cast("int") + F.lit(n + 1)), F.lit("")))), ""),
    )
    return F.concat(head, F.when(F.size(found) < n, tail).otherwise(changed))
