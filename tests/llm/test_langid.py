"""Language identification against a plain version that binds and bundles one n-gram at a time."""

import zlib

import numpy as np
import regex
from pyspark.sql import functions as F

from tessera.llm import langid

DIM = langid.DIMENSIONS


def _vector(text, letters):
    words = " ".join(regex.findall(r"[\p{L}\p{M}]+", (text or "").lower()))
    total = np.zeros(DIM)
    if not regex.search(r"\p{L}", words):
        return total
    padded = f" {words} "
    for k in range(len(padded) - 2):
        gram = np.ones(DIM)
        for place, c in enumerate(padded[k : k + 3]):
            if c not in letters:
                letters[c] = np.random.default_rng([9, ord(c)]).integers(0, 2, DIM, np.int8).astype(int) * 2 - 1
            gram = gram * np.roll(letters[c], 2 - place)
        total += gram
    return total / max(np.linalg.norm(total), 1e-300)


def test_matches_the_plain_version(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = [(r[0], (r[1] or "")[:1500] if r[1] is not None else None, r[2]) for r in rows]
    rows += [(5000, "́̀", "en"), (5001, "12 34", "de"), (5002, None, "fr"), (5003, "", None), (None, "some words here", "en"), (5004, "é", None)]
    letters: dict = {}
    vectors = [_vector(t, letters) for _, t, _ in rows]
    held = [zlib.crc32(str(k).encode()) % 4 == 2 if k is not None else False for k, _, _ in rows]
    sums: dict = {}
    for (_, _, lang), v, h in zip(rows, vectors, held):
        if lang is not None and not h:
            sums[lang] = sums.get(lang, 0) + v
    names = sorted(sums)
    protos = np.array([sums[x] / np.linalg.norm(sums[x]) for x in names])
    mean = protos.mean(axis=0)
    protos = protos - mean
    protos /= np.linalg.norm(protos, axis=1, keepdims=True)
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).withColumn("v", F.lit(1))
    got = {r["doc_id"]: r for r in langid.identify(table).collect()}
    assert len(got) == len(rows)
    for (k, _, _), v, h in zip(rows, vectors, held):
        r = got[k]
        assert r["held_out"] == h
        if not v.any():
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cos = protos @ ((v - mean) / np.linalg.norm(v - mean))
        best = np.sort(cos)[::-1]
        if best[0] - best[1] > 1e-4:
            assert r["lang_pred"] == names[int(cos.argmax())]
        assert abs(r["score"] - min(max(best[0], 0), 1)) < 1e-4


def test_labels_and_ids_are_no_inputs_of_a_prediction(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    languages, prototypes = langid.train(docs)
    plain = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, languages, prototypes).collect()}
    moved = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 10**9), languages, prototypes).collect()}
    assert moved == {k + 10**9: v for k, v in plain.items()}
