"""Personal data with offset-preserving deobfuscation.

Base spans come from four fixed patterns over the text as it is. A transducer then rewrites disguises (homoglyphs, wide
and invisible characters, spelled digits, "at"/"dot" words) into plain characters and keeps, for each character that
it writes, the source span it stands for. The same detectors read its output, and what they find there maps back to
source offsets. Such a span is added unless it lies inside a base span; base spans always stay, so that an identifier of which
only a part is disguised has both the base span of its plain part and the span of the whole. Redaction takes their union.

Offsets are code points, the end exclusive. Defined results: a null or empty text has no spans; spans of a kind are in order
of their starts, then ends; repeated rows are scanned one by one; long texts are scanned whole; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import arrow_map

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns of the contract. Possessive forms match the same text and don't backtrack.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Look-alikes of ASCII characters: Cyrillic and Greek letters, wide forms, signs and dashes. Fixed values.
_GLYPHS = {
    **dict(zip("аеорсухіјѕһԁԛԝв", "aeopcyxijshdqwb", strict=True)),
    **dict(zip("АВЕКМНОРСТУХІЈЅ", "ABEKMHOPCTYXIJS", strict=True)),
    **dict(zip("αορνικυτ", "aopvikut", strict=True)),
    **{chr(0xFF01 + k): chr(0x21 + k) for k in range(94)},
    "﹫": "@", "。": ".", "․": ".", "﹒": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", " ": " ", " ": " ", " ": " ", "﹢": "+",
    **{chr(z + d): str(d) for z in (0x0660, 0x06F0, 0x0966) for d in range(10)},
    **{"⁰¹²³⁴⁵⁶⁷⁸⁹"[d]: str(d) for d in range(10)},
}
#: Characters that are not seen: dropped.
_UNSEEN = frozenset("­​‌‍⁠﻿")
#: Number words of four languages. Fixed values.
_DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_ODD = re.compile("[" + "".join(map(re.escape, [*_GLYPHS, *_UNSEEN])) + "]")
_NUMBER = "|".join(sorted(_DIGITS, key=len, reverse=True))
_GAP = r"[\x20]{0,3}"
_AT_CORE = rf"[\[({{<]{_GAP}(?:at|@|arroba|ät){_GAP}[\])}}>]"
_DOT_CORE = rf"[\[({{<]{_GAP}(?:dot|\.|punkt|point|punto){_GAP}[\])}}>]"
_AT, _DOT = _GAP + _AT_CORE + _GAP, _GAP + _DOT_CORE + _GAP
#: A dot in words or brackets, or one set apart by spaces.
_WORD_DOT = rf"(?:{_DOT}|[\x20]dot[\x20]|[\x20]\.[\x20])"
#: Number words and digits in a row; blanks, dashes or dots between them, or a dot in words or brackets.
_SPELLED_STEP = rf"(?:(?P<dot>{_DOT}|[\x20]dot[\x20])|[\x20.,-]{{1,3}})"
_SPELLED_ITEM = rf"(?:{_NUMBER}|[0-9]++|plus)"
_SPELLED = re.compile(rf"(?<!\w){_SPELLED_ITEM}(?:{_SPELLED_STEP.replace('?P<dot>', '?:')}{_SPELLED_ITEM})+(?!\w)", re.I)
_SPELLED_PART = re.compile(rf"(?P<step>{_SPELLED_STEP})?(?P<item>{_SPELLED_ITEM})", re.I)
#: A disguised address, read from its sign to both sides: a bracketed at, a bare one or a spaced sign; labels with dots of any kind
#: after it; the local part before it, which is read from the end of the text to its start. Each part is read once, as no part holds a sign.
_SIGN = re.compile(rf"(?P<at>{_GAP}{_AT_CORE})|(?P<bare>[\x20]at(?=[\x20]))|(?P<plain>[\x20]{{0,2}}@)", re.I)
_REST = {kind: re.compile(rf"{gap}(?P<rest>[A-Za-z0-9-]++(?:(?:{_WORD_DOT}|\.)[A-Za-z0-9-]++)++)", re.I) for kind, gap in (("at", _GAP), ("bare", r"[\x20]"), ("plain", r"[\x20]{0,2}"))}
_RUN = r"[A-Za-z0-9._%+-]"
_BACK_DOT = rf"(?:{_GAP}[\])}}>]{_GAP}(?:tod|\.|tknup|tniop|otnup){_GAP}[\[({{<]{_GAP}|[\x20]tod[\x20])"
_LOCAL_BACK = re.compile(rf"{_RUN}++(?:{_BACK_DOT}{_RUN}++)*+", re.I)
#: Four groups of four digits apart by dots, underscores or slashes.
_GROUPED = re.compile(r"(?<![0-9._/])[0-9]{4}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")
_ANY_DOT = re.compile(_WORD_DOT, re.I)
_FIRST_RUN = re.compile(rf"{_RUN}+")
_DOTTED = re.compile(rf"(?:{_DOT}|[\x20]dot[\x20])", re.I)
_DIGIT_DOT = re.compile(rf"(?<=[0-9]){_WORD_DOT}(?=[0-9])", re.I)
#: What any match of a transducer's pattern holds, from the same alternatives: a text without it is left as it is.
_HAS_AT = re.compile(rf"@|[\x20]at[\x20]|{_AT_CORE}", re.I)
_HAS_DOT = re.compile(rf"{_DOT_CORE}|[\x20]dot[\x20]|[\x20]\.[\x20]", re.I)
#: A spaced dot before a capital, which ends a sentence if the address before it is whole.
_STOP = re.compile(r"[\x20]\.[\x20](?=[A-Z])")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """What the pattern finds from the left: for each @, the longest run of local characters before it that no match has taken."""
    out: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def detect(text: str) -> dict[str, list[Span]]:
    """Spans of each kind in a text as it is, in order."""
    card, phone = [], []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            card.append(m.span())
    if "+" in text:
        phone = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    ip = [m.span() for m in _IP.finditer(text) if all(int(p) <= 255 for p in m[0].split(".") if len(p) < 4000) and all(len(p.lstrip("0")) <= 3 for p in m[0].split("."))] if "." in text else []
    return {"email": _emails(text) if "@" in text else [], "ip": ip, "card": card, "phone": phone}


class _Tape:
    """Output of a transducer: its text, and the source span of each character of it."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the spans of this text, which are in order and apart. Each new character stands for its whole span."""
        parts, starts, ends, last = [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[last:a], new]
            starts += [*self.starts[last:a], *[self.starts[a]] * len(new)]
            ends += [*self.ends[last:a], *[self.ends[b - 1]] * len(new)]
            last = b
        self.text = "".join([*parts, self.text[last:]])
        self.starts, self.ends = [*starts, *self.starts[last:]], [*ends, *self.ends[last:]]


def _rows(row: list[re.Match]) -> list[list[re.Match]]:
    """A row, parted at its commas if they stand between a few of its items only: those part phrases, not digits."""
    commas = [k for k, r in enumerate(row) if k and "," in r["step"]]
    if not commas or 2 * len(commas) >= len(row) - 1:
        return [row]
    return [row[a:b] for a, b in zip([0, *commas], [*commas, len(row)], strict=True)]


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Digits for number words: in rows of four words at least, or in rows with the three dots of an address."""
    edits = []
    for row in (part for m in _SPELLED.finditer(text) for part in _rows(list(_SPELLED_PART.finditer(text, m.start(), m.end())))):
        words = sum(r["item"].lower() in _DIGITS for r in row)
        if not (words >= 4 or words and sum(r["dot"] is not None for r in row) >= 3):
            continue
        # digits of each part between dots: a part of an address is short
        part, sizes = [], [0]
        for r in row:
            if r["dot"] is not None:
                sizes.append(0)
            part.append(len(sizes) - 1)
            sizes[-1] += len(r["item"]) if r["item"][0] in "0123456789" else 1
        for k, r in enumerate(row):
            a, b = r.span("item")
            spelled = r["item"][0] not in "0123456789"
            if k and r["dot"] is not None:
                edits.append((*r.span("step"), "."))
            elif k and (spelled or row[k - 1]["item"][0] not in "0123456789"):
                before = row[k - 1]["item"]
                close = spelled and before[0] not in "0123456789" or before.lower() == "plus" or len(sizes) > 1 and sizes[part[k]] <= 3
                edits.append((*r.span("step"), "" if close else " "))
            if spelled:
                edits.append((a, b, _DIGITS.get(r["item"].lower(), "+")))
    return edits


def _disguised(text: str) -> list[tuple[int, int, str]]:
    edits: list[tuple[int, int, str]] = []
    back, last, size = None, 0, len(text)
    for m in _SIGN.finditer(text):
        if m.start() <= last or (after := _REST[m.lastgroup].match(text, m.end())) is None:
            continue
        back = text[::-1] if back is None else back
        before = _LOCAL_BACK.match(back, size - m.start(), size - last)
        if before is None:
            continue
        # the part begins with a run that has no dots at its ends
        begin = size - before.end()
        runs = [begin, *(begin + d.end() for d in _DOTTED.finditer(text[begin : m.start()]))]
        begin = next((k for k in runs if not (k and text[k - 1] in _LOCAL) and _is_whole(text, k, m.start())), None)
        if begin is None:
            continue
        last = after.end()
        local, rest, a = text[begin : m.start()], after["rest"], after.start("rest")
        plain = m["plain"] == "@" and a == m.end()
        if plain and (stop := _STOP.search(rest)) and "." in rest[: stop.start()] and not _ANY_DOT.search(rest[: stop.start()]):
            rest = rest[: stop.start()]
        # "at home.page" is prose, and a plain sign makes an address as it is
        if (m["bare"] or plain) and not (_ANY_DOT.search(rest) or _ANY_DOT.search(local)):
            continue
        edits += [(begin + d.start(), begin + d.end(), ".") for d in _ANY_DOT.finditer(local)]
        edits.append((m.start(), a, "@"))
        edits += [(a + d.start(), a + d.end(), ".") for d in _ANY_DOT.finditer(rest)]
    return edits


def _is_whole(text: str, at: int, end: int) -> bool:
    """Whether the run at a place neither begins nor ends with a dot."""
    m = _FIRST_RUN.match(text, at, end)
    return m is not None and m[0][0] != "." and m[0][-1] != "."


def _parted(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), ".") for m in _DIGIT_DOT.finditer(text)]


def _grouped(text: str) -> list[tuple[int, int, str]]:
    return [(at, at + 1, "-") for m in _GROUPED.finditer(text) for at in (m.start() + 4, m.start() + 9, m.start() + 14)]


#: Transducers in their order, each with what its matches hold.
_RULES = ((_spelled, None), (_disguised, _HAS_AT), (_parted, _HAS_DOT), (_grouped, None))


def normalise(text: str, guarded: bool = True) -> _Tape | None:
    """The text without disguises, or None if it holds none. The guards only spare time."""
    tape = _Tape(text)
    changed = False
    if edits := [(m.start(), m.end(), _GLYPHS.get(m[0], "")) for m in _ODD.finditer(text)]:
        tape.rewrite(edits)
        changed = True
    for rule, guard in _RULES:
        if guarded and guard and not guard.search(tape.text):
            continue
        if edits := rule(tape.text):
            tape.rewrite(edits)
            changed = True
    return tape if changed else None


def find(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base spans, all spans) of each kind, in order of their starts."""
    base = detect(text)
    every = {k: list(v) for k, v in base.items()}
    if (tape := normalise(text)) is not None:
        taken = sorted(s for v in base.values() for s in v)
        starts = [s for s, _ in taken]
        reach = list(accumulate((e for _, e in taken), max))  # the last end of a base span that begins at each or before
        for kind, spans in detect(tape.text).items():
            for a, b in spans:
                start, end = tape.starts[a], tape.ends[b - 1]
                k = bisect_right(starts, start)
                if not k or reach[k - 1] < end:
                    every[kind].append((start, end))
            every[kind].sort()
    return base, every


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


_SCHEMA = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])


def _batch(b: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for t in b.column("text").to_pylist():
        base, every = find(t or "")
        rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
    return pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *(pa.array([r[k] for r in rows], _SCHEMA.types[k + 1]) for k in range(6))], schema=_SCHEMA)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of base spans, digest of base spans, all spans) of each document, in one pass and without a shuffle."""
    return arrow_map(docs.select("doc_id", "text"), _batch, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str) -> str:
    """The text with a tag in place of each span; overlapping spans become one, with the kind of the first, then longer, one."""
    spans = sorted(((a, -b, k) for k, v in find(text)[1].items() for a, b in v))
    parts, last, end = [], 0, -1
    for a, b, kind in spans:
        if a >= end:
            parts += [text[last:a], f"[{kind.upper()}]"]
            end = -b
        last = end = max(end, -b)
    return "".join([*parts, text[last:]])


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with its texts redacted, and n_chars, if there, to match. Null texts stay null."""
    fields = docs.schema
    names = fields.fieldNames()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        new = [t and redact(t) for t in b.column(names.index("text")).to_pylist()]
        cols = list(b.columns)
        cols[names.index("text")] = pa.array(new, pa.string())
        if "n_chars" in names:
            k = names.index("n_chars")
            cols[k] = pa.array([old if t is None else len(t) for t, old in zip(new, cols[k].to_pylist(), strict=True)], cols[k].type)
        return pa.RecordBatch.from_arrays(cols, schema=pa.schema([pa.field(f.name, c.type) for f, c in zip(b.schema, cols, strict=True)]))

    return arrow_map(docs, batch, fields)
