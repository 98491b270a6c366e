"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters: the product of the letters' vectors,
each rotated by its place. A text's vector bundles (adds up) its n-grams' vectors, and a language's prototype bundles all its
training texts, each scaled to unit length so that no text outweighs others. A text gets the language whose
prototype has the highest cosine with its vector, prototypes and texts taken relative to the mean prototype, which
holds what all languages share.

Training adds vectors up in each partition and then in Spark; the driver gets DIMENSIONS numbers for each language. Languages are
a set of labels, MAX_LANGUAGES at most (more are an error).

Defined results: a null text, or one without letters (marks alone are none), is ``und`` with score 0; ties go to the language that sorts first;
rows with a null language or text teach nothing; without training rows everything is ``und``; repeated rows count each time; an
empty table gives an empty result; further columns are ignored; long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, cut

DIMENSIONS, MAX_LANGUAGES = 1024, 1000
#: n-gram vectors that a worker keeps, and texts whose vectors are made at once.
KEPT, AT_ONCE = 1 << 15, 256
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


class Space:
    """Random letter vectors and the n-grams bound from them."""

    def __init__(self, seed: int = 9):
        self.seed = seed
        self.letters: dict[int, np.ndarray] = {}
        self.grams: dict[int, int] = {}
        self.rows = np.empty((1024, DIMENSIONS), np.int8)

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            self.letters[c] = np.random.default_rng([self.seed, c]).integers(0, 2, DIMENSIONS, np.int8) * np.int8(2) - np.int8(1)
        return self.letters[c]

    def bind(self, gram: int) -> np.ndarray:
        a, b, c = gram >> 42, (gram >> 21) & 0x1FFFFF, gram & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        """A row for each n-gram."""
        if len(self.grams) + len(grams) > KEPT and len(self.grams):
            self.grams.clear()
            self.letters.clear()
        for g in grams.tolist():
            if g not in self.grams:
                k = self.grams[g] = len(self.grams)
                if k == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
                self.rows[k] = self.bind(g)
        return self.rows[[self.grams[g] for g in grams.tolist()]]

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """The vector of each text; zero if it has no letters."""
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        counted = [ngrams(t) for t in texts]
        every = np.unique(np.concatenate([g for g, _ in counted])) if counted else np.empty(0, np.int64)
        for k in range(0, len(every), 4096):  # slices bound the matrices
            part = every[k : k + 4096]
            counts = np.zeros((len(texts), len(part)), np.float32)
            for row, (g, n) in enumerate(counted):
                at = np.searchsorted(part, g)
                at[at == len(part)] = 0
                inside = part[at] == g
                counts[row, at[inside]] = n[inside]
            out += counts @ self.vectors(part).astype(np.float32)
        return out


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of a text, word ends as blanks, and how often each occurs."""
    words = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not _LETTER.search(words):  # marks alone are no letters
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:], return_counts=True)


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=-1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def train(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes from rows (text, lang)."""
    bound_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(), {}
        for b in batches:
            texts, langs = b.column("text").to_pylist(), np.array(b.column("lang").to_pylist(), object)
            for k in range(0, len(texts), AT_ONCE):
                v = _unit(space.bundle(texts[k : k + AT_ONCE])).astype(np.float64)
                some = langs[k : k + AT_ONCE]
                for lang in set(some.tolist()):
                    sums[lang] = sums.get(lang, 0.0) + v[some == lang].sum(axis=0)
        if sums:
            # whole numbers add up to the same sum in any order
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([np.rint(v * 2**20).astype(np.int64) for v in sums.values()], pa.list_(pa.int64()))], ["lang", "v"])

    parts = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").mapInArrow(run, "lang string, v array<long>")
    # written once: the texts are read once, however often the sums are
    sums = cut(parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x")), "language_sums")
    found = sums.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).toArrow()["lang"].to_pylist()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    place = {lang: k for k, lang in enumerate(found)}
    out = np.zeros((len(found), DIMENSIONS), np.float64)
    table = sums.toArrow()
    out[[place[x] for x in table["lang"].to_pylist()], table["k"].to_numpy()] = table["x"].to_numpy()
    return found, _unit(out)


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of docs (doc_id, text)."""
    bound_batches(docs.sparkSession)
    mean = prototypes.mean(axis=0) if len(languages) > 1 else np.zeros(DIMENSIONS)
    shared = docs.sparkSession.sparkContext.broadcast((languages, _unit(prototypes - mean).astype(np.float32), mean.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space()
        names, protos, centre = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            langs, scores = [], []
            for k in range(0, len(texts), AT_ONCE):
                v = _unit(space.bundle(texts[k : k + AT_ONCE]))
                some = v.any(axis=1)
                if len(names):
                    cos = _unit(v - centre) @ protos.T
                    best = cos.argmax(axis=1)
                    score = np.clip(cos[np.arange(len(v)), best], 0, 1)
                for row in range(len(v)):
                    known = bool(some[row]) and len(names) > 0
                    langs.append(names[best[row]] if known else "und")
                    scores.append(float(score[row]) if known else 0.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Whether a document takes no part in training: by its id alone."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learns from the documents that are not held out, and judges all."""
    languages, prototypes = train(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, languages, prototypes).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
