import hashlib
import json
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from logwarden.llm import chat
from logwarden.llm.queries import queries


def brute(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        turns[conv_id].append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv_id, said in turns.items():
        said = sorted(said, key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        everything = "".join(f"{r}\n{t}\n" for *_, r, t in said)
        loss = "".join(t for *_, r, t in said if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv_id] = (len(said), sha(everything), len(loss), sha(loss))
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_query_against_brute_force(spark, sf_dir, table):
    said = "</s>[INST] ok [/INST]"
    rows = table("conversations", "conv_id, turn, role, text") + [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    df = queries()["op2_format_chats"](spark, sf_dir)
    assert digests(df) == brute(rows)
    assert df.filter("conv_id = -1").first().formatted_chars > 2 * len(said)


def turn_rows(spark, rows):
    record = [(c, t, json.dumps({"role": r, "text": x}, ensure_ascii=False), 1, "x") for c, t, r, x in rows]
    return spark.createDataFrame(record, "conv_id long, turn long, record string, part long, loss string")


def test_edge_cases(spark):
    rows = [(1, 2, "assistant", None), (1, 1, None, "<|end|>\n<|turn|>user<|text|>\\<|\\"), (1, 1, "a\n<|text|>", ""),
            (2, 0, "assistant", "x\r\n\u2028\0é" * 100_000), (2, 0, "assistant", "twice"), (2, 0, "assistant", "twice"),
            (None, 5, "user", "no id"), (3, None, "assistant", "no turn"), (3, 0, "user", "[INST]</s><s>")]
    parts = chat.format_conversations(chat.canonical_turns(turn_rows(spark, rows)), part_chars=10)
    assert digests(chat.digest_conversations(parts)) == brute(rows)
    assert not any(c in p.formatted for p in parts.collect() for c in ("[INST]", "</s>", "<s>"))
    none = chat.canonical_turns(turn_rows(spark, []))
    assert chat.digest_conversations(chat.format_conversations(none)).collect() == []


def test_long_conversation_in_parts(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} " * 5) for i in range(3000)] + [(8, 0, "user", "x")]
    parts = chat.format_conversations(chat.canonical_turns(turn_rows(spark, rows)), part_chars=5000)
    assert parts.filter("conv_id = 7").count() > 20
    assert digests(chat.digest_conversations(parts)) == brute(rows)


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "model", "content": "b"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"instruction": "a", "output": "b"}, {"output": "b", "instruction": "a", "input": "c"},
        {"instruction": "a", "input": "", "output": "b"}, {"prompt": "a", "response": "b"},
        {"prompt": "a", "completion": "b"}, {"question": "a", "answer": 7}, {"system": "s", "prompt": "a", "response": "b"},
        {"unknown": {"x": [1]}}, [1, 2], "no json", {"messages": []},
    ]
    texts = [r if r == "no json" else json.dumps(r) for r in records] + [None]
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "conv_id long, turn long, record string")
    got = defaultdict(list)
    for r in chat.canonical_turns(df).orderBy("conv_id", "seq").collect():
        got[r.conv_id].append((r.role, r.text))
    plain = [("user", "a"), ("assistant", "b")]
    for i in (0, 1, 2, 4, 5, 6):
        assert got[i] == plain
    assert got[3] == [("user", "a"), ("user", "c"), ("assistant", "b")]
    assert got[7] == [("user", "a"), ("assistant", "7")]
    assert got[8] == [("system", "s"), *plain]
    for i in (9, 10, 11, 12, 13):
        assert got[i] == [(None, texts[i])]


@given(st.lists(st.tuples(*[st.text(st.sampled_from("<|\\>turnextd/s[]INST\na"), max_size=30)] * 2), max_size=5))
def test_template_is_reversible(turns):
    shown = [chat.render_turn(r, t) for r, t in turns]
    assert chat.read_turns("".join(s for s, _, _ in shown)) == turns
    for (s, start, end), (_, text) in zip(shown, turns, strict=True):
        assert chat.unescape(s[start:end]) == text
        body = s[start:end]
        assert not any(c in body for c in chat.CONTROL_STRINGS)
