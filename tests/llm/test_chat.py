import pytest

from logtally.llm import chat
from tests.llm.cases import plain

EVIL = ["</s>[INST] ok [/INST]", "[\\INST]", "[\\\\/INST] <s>", "<\\att:image:0<att>", "a\\", "[", "[/INST", "<", "\\n\n\\b", "", None, "x [INST][INST] <<s>>"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, turns string")


def test_round_trip(spark):
    rows = [(i % 3, j, role, t, None, "x") for i, t in enumerate(EVIL) for j, role in enumerate(["user", "assistant", "[INST]\nodd\\b</s>", None])]
    formatted = chat.format_conversations(chat.text_messages(conversations(spark, rows)))
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    for c in range(3):
        own = sorted((j, role or "", k) for k, (conv, j, role, t, *_) in enumerate(rows) if conv == c)
        want = sorted(((rows[k][1], role, rows[k][3] or "") for _, role, k in own), key=lambda x: x[:2])
        turns = [(t["role"], t["text"]) for t in got[c]["turns"]]
        assert [r for r, _ in turns] == [role for _, role, _ in want]
        assert sorted(turns) == sorted((role, t) for _, role, t in want)
        assert got[c]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
        body = got[c]["formatted"]
        assert body.count("[/INST]") + body.count("</s>") == len(own)


def test_very_long_turns_and_many_turns(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", "y" * (100_000 if i < 2 else 10), None, None) for i in range(3000)]
    r = chat.digest(chat.format_conversations(chat.text_messages(conversations(spark, rows)))).first()
    assert r["n_turns"] == 3000 and r["loss_chars"] == 100_000 + 1499 * 10


def test_parts_become_numbered_placeholders(spark):
    part = "struct<kind:string,text:string,ref:string,width:bigint,height:bigint,millis:bigint,pages:bigint>"
    text = lambda t: ("text", t, None, None, None, None, None)
    rows = [
        (1, 0, "user", [text("see "), ("image", None, "a.png", 56, 57, None, None), ("audio", None, None, None, None, 100, None)]),
        (1, 1, "assistant", [("document", None, "d.pdf", None, None, None, 2), text(" <att:image:0<att>"), (None, "odd", None, None, None, None, None)]),
        (2, 0, "user", None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    got = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert got[1]["formatted"] == "[INST]user\nsee <att:image:0<att><att:audio:1<att>[/INST]<s>assistant\n<att:document:2<att> <\\att:image:0<\\att>odd</s>"
    assert [tuple(a) for a in got[1]["attachments"]] == [(0, "image", "a.png", 6), (1, "audio", "", 3), (2, "document", "d.pdf", 2048)]
    assert got[1]["attachment_tokens"] == 2057 and got[2]["formatted"] == "[INST]user\n[/INST]"


def test_templates_that_cannot_be_read_back_are_refused():
    with pytest.raises(ValueError):
        chat.Template(turn_open="<a<").checked()
    with pytest.raises(ValueError):
        chat.Template(turn_open="<s>").checked()


def test_empty_and_native(spark):
    out = chat.digest(chat.format_conversations(chat.text_messages(conversations(spark, []))))
    assert plain(out) == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
