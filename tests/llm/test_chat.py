"""Chat records of mixed layouts, with the fields that real ones have."""

import json
import random

from tessera.llm import chat

Q, A = ("user", "q"), ("assistant", "a")


def _turns(spark, records):
    df = spark.createDataFrame([(k, r if isinstance(r, str) or r is None else json.dumps(r), "clash", 1) for k, r in enumerate(records)], "k int, rec string, fingerprint string, turns int")
    return {r["k"]: (r["fingerprint"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.record_turns(df, "rec").collect()}


def test_further_fields_do_not_hide_a_layout(spark):
    records = [
        ({"id": 5, "prompt": "q", "response": "a"}, [Q, A]),
        ({"messages": [{"role": "user", "content": "q", "name": "x"}, {"role": "assistant", "content": "a", "tool_calls": []}], "source": "s", "meta": {"role": 1}}, [Q, A]),
        ({"messages": [{"role": "USER", "content": "q"}, {"role": "assistant", "content": "a", "weight": 0}]}, [Q, A]),
        ({"messages": [{"role": "user", "content": [{"type": "text", "text": "q1"}, {"type": "image"}, {"type": "text", "text": "q2"}]}, {"role": "assistant", "content": None}]}, [("user", "q1\n\nq2"), ("assistant", None)]),
        ({"conversations": [{"from": "human", "value": "q", "id": 1}, {"from": "gpt", "value": "a"}], "system": "ignored without a prompt"}, [Q, A]),
        ({"instruction": "q", "input": None, "output": "a", "id": "7", "lang": None}, [Q, A]),
        ({"instruction": "do", "output": "a", "text": "do a", "score": 1.5}, [("user", "do"), A]),
        ({"prompt": "q", "response": "a", "system": None, "tags": ["x"]}, [Q, A]),
        ({"question": "q", "answer": "a", "prompt": "no answer"}, [Q, A]),
        ({"prompt": 5, "completion": True}, [("user", "5"), ("assistant", "true")]),
        ({"messages": [], "id": 1}, None),
        ({"messages": "text"}, None),
        ({"messages.role": 1, "odd key": 2, "a,b: V>": 3}, None),
        ("[1, 2]", None),
        ("5", None),
        ("{}", None),
        ("", None),
        ("{broken", None),
        (None, None),
    ]
    got = _turns(spark, [r for r, _ in records])
    for k, (record, want) in enumerate(records):
        assert got[k][1] == want, record
    assert got[0][0] == chat._digest(("prompt", "response"))
    assert got[1][0] == got[2][0] == got[3][0] == chat._digest(("messages", "messages[].content", "messages[].role"))
    assert got[12][0] not in chat.FINGERPRINTS and got[18][0] is None and got[13][0] is None


def test_unknown_layouts_are_reported(spark):
    records = [{"x": 1, "y": {"z": 2}}] * 3 + [{"messages": [{"who": 1}]}] + [{"prompt": "q", "response": "a"}] * 2 + ["nothing"]
    df = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "rec string")
    got = {tuple(r["paths"] or ()): r["n"] for r in chat.unknown_layouts(df, "rec").collect()}
    assert got == {("x", "y"): 3, ("messages", "messages[].who"): 1, (): 1}


def test_mixed_tables_and_records_come_back(spark):
    rng = random.Random(1)
    bits = ["\\", "<turn>", "</turn>", "### ", "\n", "\\0", "a", '"', "é", "{", "\\u0041"]
    say = lambda: "".join(rng.choices(bits, k=7))
    want, rows, records = {}, [], []
    for c in range(60):
        turns = [(rng.choice(["user", "assistant", "system"]), say()) for _ in range(rng.randint(1, 130 if c < 3 else 6))]
        want[c] = turns
        if c % 2:
            rows += [(c, t, role, text) for t, (role, text) in enumerate(turns)]
        else:
            records.append((c, json.dumps({"id": c, "messages": [{"role": r, "content": t, "name": None} for r, t in turns]})))
    records.append((99, "broken"))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(table, spark.createDataFrame(records, "conv_id long, record string"))
    back = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in out.select("conv_id", chat.parse(out["formatted"]).alias("t")).collect()}
    assert back == want
