"""Operators that relate rows: chats, URLs, near-duplicates, benchmark overlaps, and the pipeline."""

import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import chat, decontam, neardup, registry, urls
from tests.llm.test_decontam import _plain as plain_overlap
from tests.llm.test_pii import plain as plain_scan
from tests.llm.test_text_operators import _measure
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, name):
    compare(spark, connect(SF), name, registry.queries()[name], registry.oracle_sql()[name], SF)


# chats


def test_chat_round_trip(spark):
    rng = random.Random(3)
    bits = ["\\", "<turn>", "</turn>", "### ", "\n", "\\0", "\\1", "a", "<", "/turn>", "\\### Assistant: </turn> ok", "", "é"]
    rows = [(c, t, rng.choice(["user", "assistant", "sys\ntem", None]), "".join(rng.choices(bits, k=6)) or None) for c in range(40) for t in range(rng.randint(1, 200 if c == 0 else 5))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")).withColumn("block", F.lit(1))
    back = chat.format_chats(table).select("conv_id", chat.parse(F.col("formatted")).alias("t")).collect()
    want = {}
    for c, _, role, text in rows:
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["t"]] for r in back} == want


def test_chat_nulls_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    t = spark.createDataFrame([(None, None, None, None), (1, None, "user", "a"), (1, 0, "assistant", "b"), (1, 0, "assistant", "b")], schema)
    out = {r[0]: [tuple(x) for x in r[1]] for r in chat.format_chats(t).select("conv_id", chat.parse(F.col("formatted"))).collect()}
    assert out == {None: [("", "")], 1: [("user", "a"), ("assistant", "b"), ("assistant", "b")]}
    assert chat.format_chats(t.limit(0)).count() == 0


def test_chat_fingerprints(spark):
    records = [
        {"messages": [{"role": "User", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "do", "input": "it", "output": "done"},
        {"instruction": "do", "input": "", "output": "done"},
        {"prompt": "p", "completion": "c"},
        {"prompt": "p", "response": "r", "system": "s"},
        {"question": "q", "answer": None},
        {"unknown": 1},
    ]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)] + [(99, "not json"), (100, None)], "k int, rec string")
    out = {r["k"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in chat.record_turns(df, "rec").collect()}
    assert out[0] == [("user", "hi"), ("assistant", "yo")]
    assert out[1] == [("user", "q"), ("assistant", "a")]
    assert out[2] == [("user", "do\n\nit"), ("assistant", "done")]
    assert out[3] == [("user", "do"), ("assistant", "done")]
    assert out[4] == [("user", "p"), ("assistant", "c")]
    assert out[5] == [("system", "s"), ("user", "p"), ("assistant", "r")]
    assert out[6] == [("user", "q"), ("assistant", None)]
    assert out[7] is None and out[99] is None and out[100] is None


# URLs


def _judge(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        k = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k])
        rest = rest[k:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(-len(h + p), -len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_url_sweep_matches_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    label = lambda: rng.choice(["a", "b", "a-b", "c1", "org", "com", "é"])
    rules = {(".".join(label() for _ in range(rng.randint(1, 3))), "/" + "".join(rng.choices("ab/", k=rng.randint(0, 3)))): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    made = ["http://" + ".".join(label() for _ in range(rng.randint(1, 4))) + rng.choice(["", "/" + "".join(rng.choices("ab/", k=4))]) + rng.choice(["", "?x=/a", "#f"]) for _ in range(800)]
    made += [None, "", "no scheme", "://", "x://", "HTTP://A.ORG/a", "a://b://c", "http://a?b", "http://a.org/" + "a" * 30000] + ["http://x.a.org/ab"] * 300
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("stack", F.lit(0))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    for k, u in enumerate(made):
        assert got[k] == _judge(u, rules), u
    monkeypatch.setattr(urls, "INLINE", 0)  # all hosts are swept by paths, too
    monkeypatch.setattr(urls, "PATHS", 20)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert all(got[k] == _judge(u, rules) for k, u in enumerate(made))
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert urls.judge(pages, none).where("verdict <> 'allow' OR rule IS NOT NULL").count() == 0
    assert urls.judge(pages.limit(0), none).count() == 0


# near-duplicates


def _components(texts):
    sets = {}
    for k, t in texts.items():
        w = (t or "").encode().lower().decode().split(" ") if t else []
        w = [x for x in "".join(c if c not in "\t\n\r\x0b\x0c" else " " for c in " ".join(w)).split(" ") if x]
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    up = {k: k for k in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                i = len(sets[a] & sets[b])
                if 100 * i >= 75 * (len(sets[a]) + len(sets[b]) - i):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}, sets


@pytest.fixture(scope="module")
def family():
    """Copies, near copies of one text, chains, a shared passage, and short, empty and null texts."""
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    base, passage = words(120), words(40)
    texts = {0: " ".join(base), 1: " ".join(base).upper(), 2: None, 3: "", 4: " \n", 5: "one two", 6: "ONE  two", 7: "one two three"}
    for k in range(70):  # around the threshold: one to eight edits
        w = list(base)
        for _ in range(1 + k % 8):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 10**6)}"
        texts[10 + k] = " ".join(w)
    chain = words(100)
    for k in range(12):  # each near the one before, the ends far apart
        chain = chain[3:] + words(3)
        texts[100 + k] = " ".join(chain)
    for k in range(90):
        texts[200 + k] = " ".join(passage + words(12 + k % 30))
    return texts


def test_near_duplicates_match_brute_force(spark, family, monkeypatch):
    want, sets = _components(family)
    docs = spark.createDataFrame(list(family.items()), "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("path", F.lit(1))
    for small, node, task in ((48, 8192, 1 << 18), (8, 40, 0)):  # the second makes nodes branch and be joined, and components take rounds
        monkeypatch.setattr(neardup, "SMALL", small)
        monkeypatch.setattr(neardup, "NODE", node)
        monkeypatch.setattr(neardup, "ONE_TASK", task)
        got = {r["doc_id"]: r for r in neardup.near_duplicates(docs).collect()}
        assert {k: r["component_id"] for k, r in got.items()} == want
        assert {k: r["n_shingles"] for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
        assert all(r["kept"] == (k == want[k]) for k, r in got.items())


def test_near_duplicates_odd_input(spark):
    schema = "doc_id long, text string"
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None)], schema)
    out = neardup.near_duplicates(twice).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["component_id"]) for r in out] == [(None, 1), (1, 1), (1, 1), (2, 2)]
    assert neardup.near_duplicates(twice.limit(0)).count() == 0
    assert neardup.deduplicate(twice).count() == 4


# decontamination


def test_overlaps_tolerate_substitutions(spark):
    rng = random.Random(6)
    words = lambda n: [f"t{rng.randint(0, 10**6)}" for _ in range(n)]
    items = {k: words(n) for k, n in enumerate((20, 40, 60, 8, 3))}
    docs, want = [], set()
    for k in range(60):
        w = words(100)
        item = k % 5
        planted = list(items[item])
        if item < 3:
            for j in range(4, len(planted), 6):  # every sixth token substituted
                planted[j] = "zz" if k % 2 else planted[j]
        if k < 40:
            at = rng.randint(0, 90)
            w[at:at] = planted
            if item != 4:
                want.add((k, item))
        docs.append((k, " ".join(w)))
    docs += [(100, None), (101, ""), (102, "short"), (103, " ".join(items[0]).upper() + "!")]
    want.add((103, 0))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(5)).withColumn("token_start", F.lit("x"))
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(77, None), (78, "")], "item_id long, text string")
    got = decontam.overlaps(d, b)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    clean = decontam.decontaminate(d, b)
    assert {r["doc_id"] for r in clean.collect()} == {k for k, _ in docs} - {k for k, _ in want}
    assert clean.columns == d.columns
    assert decontam.overlaps(d, b.limit(0)).count() == 0
    assert decontam.overlaps(d.limit(0), b).count() == 0


@pytest.mark.parametrize(
    ("pattern", "found"),
    [
        ("=" * 8 + "x" * 4 + "=" * 8, True),
        (("=" * 12 + "x" * 6) * 3 + "=" * 12, True),
        ("===x===x===x===", True),
        ("==x====x====x==", True),
        ("====x===", True),
        ("==x==x==", True),
        ("==x=x==", True),
        ("=====", True),
        ("====x", False),
        ("x=x=" * 10, False),
        ("=" * 12 + "x" * 28, False),
    ],
)
def test_overlap_takes_any_stretch_within_the_limits(pattern, found):
    item = [f"t{k}" for k in range(len(pattern))]
    text = " ".join(["before", "it", *(w if c == "=" else "zz" for w, c in zip(item, pattern, strict=True)), "after"])
    got = decontam.Index([(7, item), (8, ["other", "words", "only", "here"])]).search(text)
    assert got == ({7: (pattern.count("="), 2, 2 + len(pattern.rstrip("x")))} if found else {})


def test_overlap_matches_brute_force():
    rng = random.Random(9)
    for _ in range(400):
        n = rng.randint(6, 32)
        same = [rng.random() < 0.75 for _ in range(n)]
        item = [f"t{k}" for k in range(n)]
        got = decontam.Index([(1, item)]).search(" ".join(w if s else "zz" for w, s in zip(item, same, strict=True)))
        best = max(sum(same[a:b]) for a in range(n) for b in range(a + 1, n + 1) if sum(same[a:b]) >= decontam.MIN_SHARE * (b - a) - 1e-9)
        need = min(decontam.MIN_TOKENS, -(-7 * n // 10))
        assert (got[1][0] if got else 0) == (best if best >= need else 0), same


def test_overlap_blocks_give_the_same(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontam.overlaps(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BLOCK_TOKENS", 300)
    assert sorted(map(tuple, decontam.overlaps(docs, bench).collect())) == whole
    texts = {r["item_id"]: " ".join(decontam.tokens(r["text"])) for r in bench.collect()}
    for r in docs.collect():
        flat = " ".join(decontam.tokens(r["text"]))
        for k, t in texts.items():
            if f" {t} " in f" {flat} ":
                assert any(w[0] == r["doc_id"] and w[1] == k for w in whole)


# the pipeline


def _good(text):
    """The policy's rules over measures that are counted here."""
    n, chars, symbols, dup, repeats = _measure(text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
    upper, letters = sum(c.lower() != c for c in text), sum(c.lower() != c or c.upper() != c and c != "ß" for c in text)
    return not (n < 20 or 100 * repeats > 30 * n or 10 * symbols > 3 * n or 2 * dup > lines or chars < 2 * n or chars > 15 * n or 10 * upper > 7 * letters)


def _contaminated(text, items):
    """Whether a text holds an item: places are tried on which enough tokens agree."""
    d = re.findall(r"[^\W_]+", text.lower())
    where = {}
    for k, w in enumerate(d):
        where.setdefault(w, []).append(k)
    for item in items:
        w = re.findall(r"[^\W_]+", item.lower())
        need = len(w) if len(w) < 6 else min(13, -(-7 * len(w) // 10))
        shifts = Counter(k - j for j, x in enumerate(w) for k in where.get(x, ()))
        for shift, n in shifts.items():
            if n >= need and plain_overlap(" ".join(d[max(0, shift) : shift + len(w)]), " ".join(w)):
                return True
    return False


def _redacted(text):
    """The text with tags in place of the spans, overlapping ones as one."""
    spans = sorted((int(a), -int(b), k) for k, a, b in (s.split(":") for s in plain_scan(text)[5].split(",") if s))
    out, last, end = "", 0, -1
    for a, b, kind in spans:
        if a >= end:
            out += text[last:a] + f"[{kind.upper()}]"
            end = -b
        last = end = max(end, -b)
    return out + text[last:]


def test_pipeline_matches_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = docs[[_good(t or "") for t in docs.text]]
    first, _ = _components(dict(zip(docs.doc_id, docs.text, strict=True)))
    docs = docs[[first[k] == k for k in docs.doc_id]]
    docs = docs[[not _contaminated(t, items) for t in docs.text]]
    library = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    want = {k: library.encode(_redacted(t), add_special_tokens=False).ids for k, t in zip(docs.doc_id, docs.text, strict=True)}
    got = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_keep_columns_and_survive_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", None, "s", 0), (2, "word " * 5, "en", "s", 25), (3, " ".join(f"w{k}" for k in range(30)), "en", None, 100), (3, " ".join(f"w{k}" for k in range(30)), "en", None, 100)]
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == table.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
