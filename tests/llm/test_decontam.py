"""Benchmark overlaps against a plain search of all places, on both ways of the join, and with windows that many items share."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam

MASKS = {"11011101": 10**9, "10111011": 10**9, "11101101": 10**9, "111111": 10**9, "111": 32, "11011": 32, "1101011": 8}


def _plain(doc, item):
    """The best (n_matched, start, end) over all places of an item on a document where a mask's window agrees."""
    d, w = re.findall(r"\w+", (doc or "").lower()), re.findall(r"\w+", (item or "").lower())
    best = None
    if len(w) < 4 or len(d) < 4:
        return None
    need = len(w) if len(w) < 6 else min(13, -(-7 * len(w) // 10))
    for shift in range(-len(w) + 1, len(d)):
        same = [0 <= shift + k < len(d) and d[shift + k] == w[k] for k in range(len(w))]
        if sum(same) < need:
            continue
        if not any(len(w) <= most and any(shift + k >= 0 and shift + k + len(m) <= len(d) and all(same[k + j] for j, c in enumerate(m) if c == "1") for k in range(len(w) - len(m) + 1)) for m, most in MASKS.items()):
            continue
        for a in range(len(w)):
            for b in range(a + 1, len(w) + 1):
                n = sum(same[a:b])
                if n >= need and n >= 0.7 * (b - a) - 1e-9 and same[a] and same[b - 1]:
                    key = (n, -(shift + a), shift + b)
                    best = max(best or key, key)
    return best and (best[0], -best[1], best[2])


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(21)
    vocabulary = [f"v{k}" for k in range(30)]
    items = {k: " ".join(rng.choices(vocabulary, k=n)) for k, n in enumerate((4, 5, 6, 7, 9, 12, 16, 20, 33, 40))}
    items |= {20: items[7], 21: items[5].upper(), 22: "one two three", 23: "", 24: None}
    docs = {}
    for k in range(120):
        ws = rng.choices(vocabulary, k=rng.randint(0, 30))
        item = (items[k % 10] or "").split()
        kept = [rng.choice(vocabulary) if rng.random() < (k % 5) / 12 else w for w in item][rng.randint(0, 2) :]
        at = rng.randint(0, len(ws))
        docs[k] = " ".join(ws[:at] + kept + ws[at:])
    docs |= {200: None, 201: "", 202: "v1", 203: docs[1], 204: docs[1] + "!"}
    want = {(d, i): best for d, t in docs.items() for i, w in items.items() if (best := _plain(t, w))}
    hit = min(k for k, _ in want)
    d = spark.createDataFrame([*docs.items(), (None, docs[hit]), (hit, docs[hit])], "doc_id long, text string").withColumn("k", F.lit("clash")).withColumn("item_id", F.lit(1))
    b = spark.createDataFrame([*items.items(), (None, items[0]), (0, items[0])], "item_id long, text string").withColumn("class", F.lit("clash")).withColumn("ids", F.lit(1))
    return d, b, want, docs, hit


@pytest.mark.parametrize("block", [1 << 20, 10])
def test_overlaps_match_a_plain_search(tables, monkeypatch, block):
    d, b, want, docs, hit = tables
    monkeypatch.setattr(decontam, "BLOCK_TOKENS", block)
    monkeypatch.setattr(decontam, "PAIRS_AT_ONCE", 7)
    monkeypatch.setattr(decontam, "TOKENS_AT_ONCE", 50)
    rows = decontam.overlaps(d, b).collect()
    got = {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in rows}
    assert len(got) == len(rows)
    assert {k: v for k, v in got.items() if k[0] is not None} == want
    assert {(None, i): v for (k, i), v in want.items() if k == hit} == {k: v for k, v in got.items() if k[0] is None}
    clean = decontam.decontaminate(d, b)
    assert clean.columns == d.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(set(docs) - {k for k, _ in want})
    assert decontam.decontaminate(d.limit(0), b).count() == decontam.overlaps(d.limit(0), b).count() == 0


def test_a_window_that_many_items_share(spark):
    rng = random.Random(2)
    head = [f"h{k}" for k in range(12)]
    items = [(k, [*head, *(f"t{rng.randint(0, 10**6)}" for _ in range(40))]) for k in range(20_000)]
    index = decontam.Index(items)
    start = time.process_time()
    assert index.search(" ".join(["x", *head, "y"] * 3)) == {}
    assert index.search(" ".join([*items[77][1], "z", *head])).keys() == {77}
    assert time.process_time() - start < 6
    longer = decontam.Index([(k, [*head, "same", *ws[12:]]) for k, ws in items])
    start = time.process_time()
    assert len(longer.search(" ".join(["x", *head, "same", "y"]))) == 20_000
    assert longer.holds(" ".join(["x", *head, "same", "y"]))
    assert time.process_time() - start < 4
