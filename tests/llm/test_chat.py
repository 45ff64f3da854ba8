import hashlib
import random

from rosterlake.llm import chat

BITS = ["\\", "#", "##", "### ", "<", "</turn>", "</turn>\n", "\n", "|", "0: ", "user", "a", "é", "\\h", "\\l", "\\o", "\\c", "< /turn>", " ", ": ", "😀"]
SCHEMA = "conv_id long, turn long, role string, text string, output string, level int"


def random_rows(n):
    rng = random.Random(2)
    return [(i // 3, i % 3, rng.choice(["user", "assistant", "assistant", "we|ird: #<\n\\r", "", None]),
             "".join(rng.choice(BITS) for _ in range(rng.randint(0, 9))), "clash", 9) for i in range(n)]


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["conv_id"]: r for r in chat.chat_digests(chat.with_test_conversation(df)).collect()}
    marks = "\\### Assistant: </turn> ok"
    source = {-7: [(0, "user", marks), (1, "assistant", marks)]}
    for conv, turn, role, text, *_ in rows:
        source.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(out) == set(source)
    for conv, turns in source.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = out[conv]
        assert r["round_trip"] and (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_round_trip(spark):
    check(spark, random_rows(900))


def test_odd_rows(spark):
    check(spark, [(None, None, None, None, "", 1)] * 2 + [(1, 0, "assistant", None, None, None), (1, 0, "assistant", "tie", None, None),
                                                          (1, None, "user", "x" * 200_000, None, None), (2, 5, "system", "", None, None)])


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.format_conversations(df).count() == 0
    assert [r["conv_id"] for r in chat.chat_digests(chat.with_test_conversation(df)).collect()] == [-7]


def test_escapes_only_what_conflicts(spark):
    df = spark.createDataFrame([(1, 0, "user", "plain \\ text # <b>", "", 0), (1, 1, "assistant", "has ### mark", "", 0)], SCHEMA)
    (r,) = chat.format_conversations(df).collect()
    assert r["output"] == "### user|0: plain \\ text # <b></turn>\n### assistant|1: has \\omark</turn>\n"
    assert r["same"] and r["output"][r["loss_spans"][0]["start"]:][:r["loss_spans"][0]["length"]] == "has \\omark"


def test_plan_is_native(spark):
    plan = chat.chat_digests(spark.createDataFrame([], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
