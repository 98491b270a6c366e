"""License scans against a whole, unbanded alignment, on long texts, and on texts that are no licenses."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.llm import licenses


def _whole(ws, own):
    """(matches, first place, end place) of the best alignment of all of a template with a document: most matches, then least skips."""
    best = [(0, 0, -1, -1)] * (len(ws) + 1)
    for w in own:
        row = [(best[0][0], best[0][1] - 1, -1, -1)]
        for j, x in enumerate(ws):
            m, s, a, b = best[j]
            options = [(best[j + 1][0], best[j + 1][1] - 1, *best[j + 1][2:]), (row[j][0], row[j][1] - (row[j][0] > 0), *row[j][2:])]
            options.append((m + 1, s, a if a >= 0 else j, j + 1) if x == w else (m, s - 1, a, b))
            row.append(max(options, key=lambda o: o[:2]))
        best = row
    m, _, a, b = max(best, key=lambda o: o[:2])
    return m, a, b


def test_scan_matches_a_whole_alignment(spark):
    rng = random.Random(11)
    templates = {f"t{k}": " ".join(rng.choices([f"v{k}x{j}" for j in range(60)], k=n)) for k, n in enumerate((9, 14, 22, 40, 70))}
    index = licenses.Index(templates)
    docs, want = [], []
    for k in range(240):
        name = f"t{k % 5}"
        own = templates[name].split()
        changed = []
        for w in own:  # replaced, dropped and added words
            r, level = rng.random(), (k % 7) / 20
            changed += ["zz"] if r < level else [] if r < level * 1.2 else [w, "new"] if r < level * 1.4 else [w]
        noise = [f"n{rng.randint(0, 50)}" for _ in range(rng.randint(0, 60))]
        cut = rng.randint(0, len(noise))
        ws = noise[:cut] + changed + noise[cut:]
        docs.append((k, " ".join(ws)))
        m, a, b = _whole(ws, own)
        hit = any(ws[j : j + 3] == own[i : i + 3] for j in range(len(ws) - 2) for i in range(len(own) - 2))
        least = max(0.7 * len(own), min(len(own) - 1, 6))
        if m >= least and hit:
            text = docs[-1][1]
            start = len(" ".join(ws[:a])) + (a > 0)
            want.append((k, name, m, len(own), round(m / len(own), 6), start, start + len(" ".join(text.split()[a:b]))))
    assert len(want) > 120
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("license", F.lit("clash")).withColumn("coverage", F.lit(1))
    got = sorted(tuple(r) for r in licenses.scan(table, templates).collect())
    assert [r[:5] for r in got] == [r[:5] for r in sorted(want)]
    assert got == sorted(want)
    assert index.scan(None) == index.scan("") == index.scan(" ".join(f"n{k}" for k in range(99))) == []


@pytest.fixture(scope="module")
def index():
    return licenses.Index(licenses.whole_texts())


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "MIT", "BSD-3-Clause"])
def test_long_texts_are_found_whole(index, name):
    text = licenses.whole_texts()[name]
    found = {r[0]: r for r in index.scan(f"Preface of a file.\n{text}\nwhat follows")}
    assert found[name][1] == found[name][2] and found[name][3] == 1.0
    first = text.index(next(w for w in text.split() if any(c.isalnum() for c in w)))
    assert abs(found[name][4] - first - len("Preface of a file.\n")) <= 2
    ws = licenses.words(text)[0]
    rng = random.Random(2)
    noisy = []
    for k, w in enumerate(ws):  # one word in ten replaced, a few dropped, a few added
        r = rng.random()
        noisy += ["zzz"] if r < 0.1 else [] if r < 0.11 else [w, "qq"] if r < 0.12 else [w]
    near = {r[0]: r for r in index.scan(" ".join(noisy))}
    assert 0.85 < near[name][3] < 0.95
    half = {r[0] for r in index.scan(" ".join(ws[: len(ws) // 2]))}
    assert name not in half


def test_other_texts_are_no_licenses(index, spark):
    prose = "The license of the general store was renewed. Public use of the source form in this version is free of charge, and all rights are kept by the author or the owner of the land. Permission was granted to copy the map. "
    assert index.scan(prose * 20) == []
    ws = licenses.words(licenses.whole_texts()["GPL-3.0"])[0]
    rng = random.Random(3)
    rng.shuffle(ws)
    assert index.scan(" ".join(ws)) == []


def test_cost_is_in_proportion(index):
    for text in ("of the GNU General Public License " * 30_000, "licensed under the " * 50_000, "All rights reserved. " * 20_000, licenses.whole_texts()["GPL-2.0"][:6000] * 20):
        start = time.process_time()
        index.scan(text)
        assert time.process_time() - start < 12
