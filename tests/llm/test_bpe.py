"""The codec's query against the tokenizers library: digests, every kind of character, and texts in pieces."""

import errno
import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(PATH)


def _row(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    said = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(b"".join(k.to_bytes(4, "little") for k in ids)).hexdigest(), hashlib.sha256(said.encode()).hexdigest()


def test_digests_are_the_library_s(spark, library):
    rng = random.Random(3)
    blob = "".join(rng.choices("ABCDEFabcdef0123456789+/", k=40_000))
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += [None, "", " ", blob, f"a {blob} b {blob}", "ACGT" * 5000, "<|endoftext|>x<|startoftext|>", "a<|endoftext|>" * 300, "same", "same", "word " * 30_000, "é" * 3000, "\U00016ea0\U0001e5d0 \U00010d50 Ƛ"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("word", F.lit(1))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_documents(table, PATH, 2000).collect()}
    assert got == {k: _row(library, t) for k, t in enumerate(texts)}


def test_all_characters_are_read_as_the_library_reads_them(library, vocabulary):
    codec = bpe.Codec(vocabulary)
    skipped = [(0x3500, 0x9F00), (0xAD00, 0xDFFF), (0x20100, 0x2A600), (0x2A800, 0x2B700), (0x31400, 0x32300), (0x32400, 0x10FF00)]
    points = [c for c in range(0x20, 0x110000) if not any(a <= c <= b for a, b in skipped)]
    for at in range(0, len(points), 10_000):
        texts = [f"a{chr(c)}{chr(c)}b{chr(c)}1" for c in points[at : at + 10_000]]
        for text, want, got in zip(texts, library.encode_batch(texts, add_special_tokens=False), codec.encode_batch(texts)):
            assert np.frombuffer(got, "<u4").tolist() == want.ids, hex(ord(text[1]))


def test_pieces_give_the_same(monkeypatch, library, vocabulary):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["ab", "É", "x ", "  ", " ", "é́", "<|endoftext|>", "\n", " ", "1,", "z" * 50]) for _ in range(400)) for _ in range(20)]
    monkeypatch.setattr(bpe, "AT_ONCE", 60)
    codec = bpe.Codec(vocabulary)
    for text, ids in zip(texts, codec.encode_batch(texts)):
        assert "".join(bpe.pieces(text)) == text
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_what_a_worker_keeps_is_bounded_in_bytes(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "AT_ONCE", 1000)
    monkeypatch.setattr(bpe, "KEPT_BYTES", 2000)
    codec = bpe.Codec(vocabulary)
    for _ in codec.encode_batch([f"{k}" + "Q" * 500 for k in range(200)] + ["short words"]):
        assert max(sum(map(len, codec.kept)), sum(map(len, codec.older))) < 2000 + 1600
    monkeypatch.setattr(bpe, "COUNTED_BYTES", 60)
    table = spark.createDataFrame([("y" * 65 + " " + "y" * 64 + " short",)] * 3, "text string").coalesce(1)
    assert {bytes(r["word"]): r["n"] for r in bpe.count_words(table, vocabulary).collect()} == {b"y" * 64: 3, b"short": 3}


@pytest.fixture
def other_mount(tmp_path, monkeypatch):
    """As in an executor: its files' root is "." and a rename between the full path and the relative one crosses mounts."""

    def replace(source, target, real=os.replace):
        if os.path.dirname(source) != os.path.dirname(target):
            raise OSError(errno.EXDEV, "Invalid cross-device link", source, None, target)
        real(source, target)

    monkeypatch.chdir(tmp_path)
    monkeypatch.setattr(bpe.SparkFiles, "getRootDirectory", lambda: ".")
    monkeypatch.setattr(os, "replace", replace)
    return tmp_path


def test_the_lexicon_is_mapped_where_the_folder_s_full_path_is_another_mount(other_mount):
    data = bpe.compile_lexicon([(b"one", [1, 2]), (b"two", [3])])
    for _ in range(2):  # the worker that writes, and one that finds the file
        assert bpe.mapped(data).find([b"one", b"two", b"x"]) == [np.array([1, 2], "<u4").tobytes(), np.array([3], "<u4").tobytes(), None]
    assert len(os.listdir(other_mount)) == 1


def test_the_pipeline_s_last_stage_encodes_there(spark, library, other_mount, monkeypatch):
    """What a worker runs in the stage encode, run here."""
    docs = spark.createDataFrame([(1, "some words, and some more words"), (2, None)], "doc_id long, text string")
    given = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, fn, *rest, real=type(docs).mapInArrow: given.append(fn) or real(self, fn, *rest))
    monkeypatch.setattr(bpe, "_OWN", {})
    corpus_pipeline.encode(spark, docs, "")
    rows = [r for b in given[-1](iter(docs.toArrow().to_batches())) for r in b.to_pylist()]
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows} == {1: _row(library, "some words, and some more words"), 2: _row(library, None)}
