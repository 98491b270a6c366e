"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger keeps the measurements and one long of failure bits;
policies are masks over these bits with a version, so a new policy, or an ablation of one, is a bitwise expression
over the ledger and never reads a text again.

Defined results: a null text has no words (and fails ``few_words``); an empty table gives an empty ledger; repeated rows
are judged one by one; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm.common import arrow_map

#: Characters counted as symbols and the words of a repeat window: fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")

#: (rule, failing condition over the measures, in SQL). A rule's bit is its place in this list; append only.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    ("shouting", "10 * n_upper > 7 * n_letters"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}

#: Versions of the policy: the rules that reject. ``base`` is the contract's.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length", "shouting"),
}
CURRENT = "v1"

_SCHEMA = pa.schema([("doc_id", pa.int64()), *((m, pa.int64()) for m in MEASURES)])
_R = np.random.default_rng(8).integers(0, 2**64, (WINDOW,), np.uint64) | np.uint64(1)


def _ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the pairs (a[i], b[i]); equal pairs get equal numbers."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeated_words(ids: np.ndarray) -> int:
    """Words that lie in an 8-word window which the text holds twice or more."""
    n = len(ids)
    m = n - WINDOW + 1
    if m < 2:
        return 0
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    h = np.zeros(m, np.uint64)
    for k in range(WINDOW):
        h += mixed[k : k + m] * _R[k]
    ordered = np.sort(h)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # equal windows have equal hashes
    r = ids
    for half in (1, 2, 4):  # exact numbers of 2-, 4- and 8-word windows
        r = _ranks(r[:-half], r[half:])
    starts = np.flatnonzero(np.bincount(r)[r] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return int((np.cumsum(edge)[:n] > 0).sum())


def _changed(text: str, other: str, kind) -> int:
    """Characters of ``text`` that differ in ``other``; where the case mapping changes the length, those of a kind."""
    if len(other) != len(text):
        return sum(map(kind, text))
    a, b = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") for x in (text, other))
    return int(np.count_nonzero(a != b))


def measure(text: str) -> tuple[int, ...]:
    """The MEASURES of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # exactly at the six ASCII blanks
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    blanks = len(raw) - len(raw.translate(None, b" \t\n\r\x0b\x0c"))
    seen: set[bytes] = set()
    lines = dup = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    n_upper, n_lower = _changed(text, text.lower(), str.isupper), _changed(text, text.upper(), str.islower)
    return len(words), len(text) - blanks, len(raw) - len(raw.translate(None, SYMBOLS)), dup, repeated_words(ids), lines, n_upper, n_upper + n_lower


def _batch(b: pa.RecordBatch) -> pa.RecordBatch:
    rows = [measure(t or "") for t in b.column("text").to_pylist()]
    cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
    return pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *cols], schema=_SCHEMA)


def failed_bits(prefix: str = "") -> Column:
    """The failure bits of the measures in columns of these names: every rule is evaluated here and nowhere else."""
    bits = F.lit(0).cast("long")
    for name, fails in RULES:
        test = re.sub(rf"\b({'|'.join(MEASURES)})\b", rf"`{prefix}\1`", fails)
        bits = bits.bitwiseOR(F.when(F.expr(test), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measures.., failed_bits): every rule, once for each document."""
    measured = arrow_map(docs.select("doc_id", "text"), _batch, ", ".join(f"{f.name} long" for f in _SCHEMA))
    return measured.withColumn("failed_bits", failed_bits())


def mask(version: str) -> int:
    return sum(BIT[r] for r in POLICIES[version])


def apply_policy(led: DataFrame, version: str = CURRENT, column: str = "kept") -> DataFrame:
    """Add the verdict of one version of the policy."""
    return led.withColumn(column, F.col("failed_bits").bitwiseAND(mask(version)) == 0)


def ablations(led: DataFrame, version: str = CURRENT) -> DataFrame:
    """(rule, n_failed, n_only): how many documents each rule of a policy rejects, and how many come back without it.
    One aggregation over the bits; a row for each rule."""
    m = mask(version)
    failed = F.col("failed_bits").bitwiseAND(m)
    aggs = []
    for r in POLICIES[version]:
        aggs += [F.count_if(failed.bitwiseAND(BIT[r]) != 0).alias(f"{r}_f"), F.count_if(failed == BIT[r]).alias(f"{r}_o")]
    one = led.agg(*aggs)
    return one.select(F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"{r}_f").alias("n_failed"), F.col(f"{r}_o").alias("n_only")) for r in POLICIES[version]))).alias("x")).select("x.*")


def filter_documents(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with all their columns: their ledger beside them, judged where they lie, no shuffle."""
    fields, prefix = docs.schema, "__ledger_"
    at = fields.fieldNames().index("text")

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(t or "") for t in b.column(at).to_pylist()]
        measures = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
        return pa.RecordBatch.from_arrays([*b.columns, *measures], [*b.schema.names, *(prefix + m for m in MEASURES)])

    wide = StructType([*fields.fields, *(StructField(prefix + m, LongType()) for m in MEASURES)])
    kept = arrow_map(docs, batch, wide).where(failed_bits(prefix).bitwiseAND(mask(version)) == 0)
    return kept.select(*[F.col(f"`{c}`") for c in fields.fieldNames()])
