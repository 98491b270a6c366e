"""Personal data: the scan against a plain version that rewrites a list of characters, and texts that would cost much."""

import hashlib
import re
import time
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import pii

GAP = r"[\x20]{0,3}"
AT = rf"{GAP}[\[({{<]{GAP}(?:at|@|arroba|ät){GAP}[\])}}>]{GAP}"
DOT = rf"{GAP}[\[({{<]{GAP}(?:dot|\.|punkt|point|punto){GAP}[\])}}>]{GAP}"
WORD_DOT = rf"(?:{DOT}|[\x20]dot[\x20]|[\x20]\.[\x20])"
LOCAL = r"[A-Za-z0-9._%+-]"
#: One expression for a whole disguised address: plain to read, and quadratic.
ADDRESS = re.compile(
    rf"(?<!{LOCAL})(?P<local>[A-Za-z0-9_%+-](?:{LOCAL}*[A-Za-z0-9_%+-])?+(?:(?:{DOT}|[\x20]dot[\x20]){LOCAL}+)*)(?:(?P<at>{AT})|(?P<bare>[\x20]at[\x20])|(?P<plain>[\x20]{{0,2}}@[\x20]{{0,2}}))(?P<rest>[A-Za-z0-9-]+(?:(?:{WORD_DOT}|\.)[A-Za-z0-9-]+)+)", re.I
)
DIGITS = {w: str(d) for d, ws in enumerate(["zero oh null zéro cero", "one eins uno", "two zwei deux dos", "three drei trois tres", "four vier quatre cuatro", "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve"]) for w in ws.split()}
ITEM = "|".join(sorted(DIGITS, key=len, reverse=True)) + "|[0-9]+|plus"
STEP = rf"(?:{DOT}|[\x20]dot[\x20]|[\x20.,-]{{1,3}})"


def _edit(tape, edits):
    """A tape of (character, start, end) with spans of its text replaced, last first."""
    for a, b, new in sorted(edits, reverse=True):
        tape = tape[:a] + [(c, tape[a][1], tape[b - 1][2]) for c in new] + tape[b:]
    return tape


def _text(tape):
    return "".join(c for c, _, _ in tape)


def _numbers(text):
    out = []
    for m in re.finditer(rf"(?<!\w)(?:{ITEM})(?:{STEP}(?:{ITEM}))+(?!\w)", text, re.I):
        items = [(i.start() + m.start(), i.end() + m.start()) for i in re.finditer(rf"(?:{ITEM})", m[0], re.I)]
        steps = [text[a:b] for (_, a), (b, _) in zip(items, items[1:])]
        is_dot = [re.fullmatch(rf"{DOT}|[\x20]dot[\x20]", s, re.I) is not None for s in steps]
        commas = ["," in s and not d for s, d in zip(steps, is_dot)]
        cuts = [k + 1 for k, c in enumerate(commas) if c] if 0 < 2 * sum(commas) < len(steps) else []
        for a, b in zip([0, *cuts], [*cuts, len(items)]):
            words = [text[x:y].lower() for x, y in items[a:b]]
            dots = is_dot[a : b - 1]
            if not (sum(w in DIGITS for w in words) >= 4 or any(w in DIGITS for w in words) and sum(dots) >= 3):
                continue
            groups = [0]
            for d in dots:
                groups.append(groups[-1] + d)
            size = {g: sum(len(w) if w[0].isdigit() else 1 for w, h in zip(words, groups) if h == g) for g in groups}
            for k, w in enumerate(words):
                x, y = items[a + k]
                if k:
                    before = words[k - 1]
                    spelled = [not u[0].isdigit() for u in (before, w)]
                    joined = all(spelled) or before == "plus" or any(dots) and size[groups[k]] <= 3
                    if dots[k - 1]:
                        out.append((items[a + k - 1][1], x, "."))
                    elif any(spelled):
                        out.append((items[a + k - 1][1], x, "" if joined else " "))
                if not w[0].isdigit():
                    out.append((x, y, DIGITS.get(w, "+")))
    return out


def _addresses(text):
    out = []
    for m in ADDRESS.finditer(text):
        rest, dots = m["rest"], re.compile(WORD_DOT, re.I)
        if m["plain"] == "@" and (stop := re.search(r" \. (?=[A-Z])", rest)) and "." in rest[: stop.start()] and not dots.search(rest[: stop.start()]):
            rest = rest[: stop.start()]
        if (m["at"] is not None) or (m["plain"] or "@") != "@" or dots.search(rest) or dots.search(m["local"]):
            out += [(m.start() + d.start(), m.start() + d.end(), ".") for d in dots.finditer(m["local"])] + [(m.end("local"), m.start("rest"), "@")]
            out += [(m.start("rest") + d.start(), m.start("rest") + d.end(), ".") for d in dots.finditer(rest)]
    return out


def _base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15],
    }


def plain(text):
    """(counts of base spans, their digest, all spans) of a text."""
    base = _base(text)
    tape = [(c, k, k + 1) for k, c in enumerate(text)]
    tape = [(pii._GLYPHS.get(c, c), a, b) for c, a, b in tape if c not in pii._UNSEEN]
    for rule in (_numbers, _addresses, lambda t: [(*m.span(), ".") for m in re.finditer(rf"(?<=[0-9]){WORD_DOT}(?=[0-9])", t, re.I)], lambda t: [(p, p + 1, "-") for m in re.finditer(r"(?<![0-9._/])[0-9]{4}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", t) for p in (m.start() + 4, m.start() + 9, m.start() + 14)]):
        tape = _edit(tape, rule(_text(tape)))
    every = {k: list(v) for k, v in base.items()}
    if _text(tape) != text:
        for kind, spans in _base(_text(tape)).items():
            new = [(tape[a][1], tape[b - 1][2]) for a, b in spans]
            every[kind] = sorted(every[kind] + [s for s in new if not any(x <= s[0] and s[1] <= y for v in base.values() for x, y in v)])
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for k in ("email", "ip", "card", "phone") for a, b in spans[k])
    return *(len(base[k]) for k in ("email", "ip", "card", "phone")), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)


PARTS = ["a", "x@", "@", " at ", "[at]", "( ät )", " dot ", "(punkt)", "{ . }", " . ", ".", " ", "-", "one", "FIVE", "plus ", "7", "192", "4111", "1111", "_", "de", "com", "а", "–", ", ", "nine ", "four-", "＠", "​", "+49", "٣", "bob@mail.example", "10.0.0.1", "six, seven apples", "/"]


def test_scan_matches_the_plain_version(spark):
    rng = np.random.default_rng(12)
    texts = ["".join(rng.choice(PARTS, int(rng.integers(1, 18)))) for _ in range(4000)]
    texts += ["plus four nine one seven two three four five six, seven apples", "call plus four nine one seven two three four five six, seven, eight", "four, one, one, one, " + "one, " * 11 + "one"]
    texts += [r[0] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("n_ip", F.lit(1))
    for r in pii.scan(table).collect():
        assert tuple(r)[1:] == plain(texts[r["doc_id"]]), repr(texts[r["doc_id"]])


def test_a_phrase_after_a_comma_is_no_part_of_a_number():
    text = "plus four nine one seven two three four five six, seven apples"
    assert pii.redact(text) == "[PHONE], seven apples"
    assert pii.redact("plus four, nine, one, seven, two, three, four, five, six") == "[PHONE]"


@pytest.mark.parametrize("part", ["a dot ", "a at b dot ", "one dot ", "plus one ", "[at", "( ", "a@", "1 . ", "4111.", "+1 ", "one, ", "a@b.c а ", "a.", "9", "one", " at a.b"])
def test_cost_is_in_proportion(part):
    text = part * (1_000_000 // len(part))
    start = time.process_time()
    pii.find(text)
    assert time.process_time() - start < 4


def test_glyphs_are_characters():
    assert all(len(k) == 1 and len(v) == 1 and v.isascii() for k, v in pii._GLYPHS.items())
    assert all(unicodedata.category(c) in ("Cf", "Mn") for c in pii._UNSEEN)
