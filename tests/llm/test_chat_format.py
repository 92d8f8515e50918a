import hashlib
import random
import re

from recordweave.llm import chat_format as chat

_SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(spark):
    random.seed(2)
    parts = ["<", "\\", "</turn>", "<turn ", "<|>", "\\b", "\\l", "a", "é", "😀", " ", "\n", "<image 0>", "|"]
    rows = [
        (c, t, random.choice(["user", "assistant", "sys<tem", "</turn>", "a\\l", None]),
         random.choice([None, "".join(random.choice(parts) for _ in range(random.randint(0, 20)))]))
        for c in range(150) for t in range(random.randint(1, 6))
    ]
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(chat.text_parts(spark.createDataFrame(rows, _SCHEMA)))).collect()}
    for c in range(150):
        mine = [r for r in rows if r[0] == c]
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert tuple(got[c])[1:5] == (len(mine), digest(told), len(loss), digest(loss))


def test_typed_parts(spark):
    rows = [
        (1, 0, "user", [("text", "look <image 0> ", None, None), ("image", None, "a.png", 784.0 * 100), ("text", "é ", None, None), ("audio", None, "b.wav", 2.0)]),
        (1, 1, "assistant", [("text", "fine\\", None, None)]),
        (1, 2, "user", [("document", None, None, None), ("other", "x", None, None), (None, None, None, None)]),
        (1, 3, "user", None),
        (1, 4, "user", []),
    ]
    made = chat.format_conversations(spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts array<{chat.PART_TYPE}>")).first()
    assert made.formatted == (
        "<turn user<|>look \\limage 0> <image 0>é <audio 1></turn><turn assistant<|>fine\\b</turn>"
        "<turn user<|><document 2>x</turn><turn user<|></turn><turn user<|></turn>"
    )
    assert [(a.type, a.ref, a.turn, a.tokens) for a in made.attachments] == [("image", "a.png", 0, 100), ("audio", "b.wav", 0, 50), ("document", None, 2, 1)]
    assert all(made.formatted[a.start :].startswith(a.placeholder) for a in made.attachments)
    assert made.attachment_tokens == 151
    assert [made.formatted[m.start : m.end] for m in made.loss_mask] == ["fine\\b"]


def test_order_ties_nulls_and_empty_table(spark):
    rows = [(None, None, "user", "b"), (None, None, "user", "b"), (None, 1, None, None), (2, 1, "b", "y"), (2, 1, "a", "z"), (2, None, "z", "x")]
    frame = spark.createDataFrame(rows, _SCHEMA).selectExpr("*", "1 as place", "'q' as head", "2 as `start`")
    made = {r.conv_id: r.formatted for r in chat.format_conversations(chat.text_parts(frame)).collect()}
    assert made[None] == "<turn user<|>b</turn><turn user<|>b</turn><turn <|></turn>"
    assert made[2] == "<turn z<|>x</turn><turn a<|>z</turn><turn b<|>y</turn>"
    assert chat.read_back(chat.format_conversations(chat.text_parts(frame.limit(0)))).count() == 0


def test_long_text(spark):
    text = "<\\" * 200_000
    row = chat.read_back(chat.format_conversations(chat.text_parts(spark.createDataFrame([(1, 0, "assistant", text)], _SCHEMA)))).first()
    assert (row.loss_chars, row.loss_sha256) == (len(text), digest(text))


def test_no_python_in_the_plan(spark, capsys):
    chat.read_back(chat.format_conversations(chat.text_parts(spark.range(1).selectExpr("id conv_id", "id turn", "'a' role", "'b' text")))).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
