from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from loadcast.llm import chat

HARD = ["</s>[INST] ok [/INST]", "\\", "\\\\s>", "<\\/s>", "[[INST]", "<<s>s>", "a\nb\\[/INST]</s", "é\U0001F600[/INST]", ""]


def test_round_trip(spark):
    rows = [(i, [("user", t), ("assi\\stant</s>", t + t), ("assistant", t)]) for i, t in enumerate(HARD)] + [(90, [])]
    df = spark.createDataFrame(rows, "i int, turns array<struct<role:string,text:string>>")
    out = df.withColumn("f", chat.format_turns(F.col("turns"))).withColumn("back", chat.parse_turns(F.col("f")))
    for r in out.collect():
        assert [(x.role, x.text) for x in r.back] == [(x.role, x.text) for x in r.turns]
        for x in r.back:
            raw = r.f[x.start:x.end]
            assert not any(c in raw for c in chat.CONTROLS)


def test_layouts(spark):
    records = {
        "messages": '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": null}]}',
        "share": '{"conversations": [{"from": "human", "value": "q"}, {"value": "r", "from": "gpt"}]}',
        "prompt": '{"prompt": "p", "completion": "c"}',
        "instruction": '{"instruction": "i", "input": "", "output": "o"}',
        "question": '{"data": {"question": "x", "answer": "y"}}',
        "turns": '{"turns": [{"turn": 2, "role": "assistant", "text": "2"}, {"turn": 1, "role": "user", "text": "1"}]}',
        "unknown": '{"foo": {"prompt": 1}}', "broken": "{", "null": None}
    df = spark.createDataFrame(list(records.items()), "name string, record string").selectExpr("*", "1 as layout", "2 as f")
    got = {r.name: r for r in chat.canonical_turns(df).collect()}
    turns = {k: None if r.turns is None else [(x.role, x.text) for x in r.turns] for k, r in got.items()}
    assert turns == {"messages": [("user", "a"), ("assistant", "")], "share": [("user", "q"), ("assistant", "r")],
                     "prompt": [("user", "p"), ("assistant", "c")], "instruction": [("system", "i"), ("assistant", "o")],
                     "question": [("user", "x"), ("assistant", "y")], "turns": [("user", "1"), ("assistant", "2")],
                     "unknown": None, "broken": None, "null": None}
    assert all(got[k].layout == k for k in list(records)[:6])
    long = {r.name: r for r in chat.canonical_turns(df, variant_bytes=10).collect()}
    for k in ("messages", "share", "turns", "prompt", "instruction", "question"):
        assert [(x.role, x.text) for x in long[k].turns] == turns[k] and long[k].layout == k
    assert got["unknown"].fingerprint is not None and got["broken"].fingerprint is None


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b\nc"), (1, 0, "user", HARD[0]), (1, 1, "assistant", "b\nc"), (2, None, None, None), (2, 3, "user", ""),
            (3, 0, "assistant", "x" * 200_000 + HARD[0]), (None, 0, "user", "n"), (5, None, None, "lone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as turns", "2 as record")
    got = {r.conv_id: r for r in chat.report(df).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0), r or "", x or "") for k, t, r, x in rows if k == c)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.report(df.limit(0)).count() == 0


def test_many_turns(spark):
    df = spark.range(1001).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t<s>', id) as text")
    r = chat.report(df).first()
    texts = [f"t<s>{i}" for i in range(1001)]
    assert r.n_turns == 1001 and r.loss_sha256 == hashlib.sha256("".join(texts[1::2]).encode()).hexdigest()


def test_conversations_are_dealt_over_layouts(spark):
    rows = [(i, 1, "assistant", f"b{i}") for i in range(80)] + [(i, 0, ["user", "human", None, "user"][i % 4], "" if i % 16 == 3 else "a") for i in range(80)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for limit in (chat.VARIANT_BYTES, 10):
        out = chat.canonical_turns(chat.conversation_records(df), variant_bytes=limit).collect()
        assert {r.layout for r in out} == {"turns", "messages", "share", "prompt"}
        for r in out:
            assert [(x.role, x.text) for x in r.turns] == [((["user", "human", "", "user"][r.conv_id % 4]), "" if r.conv_id % 16 == 3 else "a"), ("assistant", f"b{r.conv_id}")]
