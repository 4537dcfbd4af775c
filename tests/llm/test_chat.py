"""Chat formatting: escapes, typed parts, loss mask, digests, edges."""
import hashlib
import json
import random

import pytest

from llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def test_escapes_are_reversible():
    rng = random.Random(2)
    bits = ["\\", "#", "##", "###", "</turn>", "<", "/turn>", "<|", "|>", ": ", ":", "\n", "h", "t", "p", "c", "é", "\U0001f600", "<|image:0|>", "### assistant: "]
    for _ in range(4000):
        t = "".join(rng.choices(bits, k=rng.randint(0, 9)))
        for role in (False, True):
            e = chat.escape(t, role)
            assert chat.unescape(e) == t and "###" not in e and "</turn>" not in e and "<|" not in e
        s, spans, _ = chat.format_turn("a: b", t, None)
        assert chat.read_turn(s) == ("a: b", [t], []) and [chat.unescape(s[a:b]) for a, b in spans] == [t]


def test_typed_parts():
    parts = [{"type": "text", "text": "see <|image:0|>"}, {"type": "image", "ref": "a.png", "width": 57, "height": 28}, "then",
             {"type": "document", "ref": "d", "parts": [{"type": "text", "text": "p1"}, {"type": "audio", "ref": "s.wav", "seconds": 1.5}]},
             {"type": "document", "ref": "e", "pages": 3}]
    s, spans, att = chat.format_turn("assistant", "", json.dumps(parts))
    assert s == "### assistant: see \\pimage:0|><|image:0|>then<|document:1|>p1<|audio:2|><|/document:1|><|document:3|></turn>\n"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in att] == [("image", "a.png", 3), ("document", "d", 0), ("audio", "s.wav", 38), ("document", "e", 1536)]
    assert [chat.unescape(s[a:b]) for a, b in spans] == ["see <|image:0|>", "then", "p1"]
    role, texts, places = chat.read_turn(s)
    assert "".join(texts) == "see <|image:0|>thenp1" and places == [("image", 0), ("document", 1), ("audio", 2), ("/document", 1), ("document", 3)]
    with pytest.raises(ValueError):
        chat.format_turn("user", "", '[{"type": "video"}]')


def brute(rows):
    out = {}
    for c, _, r, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        out.setdefault(c, []).append((r or "", t or ""))
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {c: (len(v), h("".join(f"{r}\n{t}\n" for r, t in v)), sum(len(t) for r, t in v if r == "assistant"), h("".join(t for r, t in v if r == "assistant"))) for c, v in out.items()}


def test_read_back(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3, -7]), n, rng.choice(["user", "assistant", "system", None]), rng.choice([None, "", "a\n\\### x", "</turn>\n### user: hi", "é" * 50])) for n in range(200)]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i} ###") for i in range(3000)] + [(10, 0, "assistant", "long " * 100000), (11, None, "user", "x"), (11, 0, "user", "y")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], TURNS + ", segment string")
    formatted = chat.format_chat(df)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    want = brute(rows)
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == want
    sizes = {r.conv_id: r.n for r in formatted.selectExpr("conv_id", "length(segment) as n").groupBy("conv_id").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert {c: r.formatted_chars for c, r in got.items()} == sizes
    assert chat.read_back(chat.format_chat(df.filter("false"))).count() == 0


def test_parts_column(spark):
    df = spark.createDataFrame([(1, 0, "user", None, '[{"type":"image","ref":"i","width":28,"height":28}]'), (1, 1, "assistant", "ok", None)], TURNS + ", parts string")
    rows = sorted(chat.format_chat(df, parts="parts").collect(), key=lambda r: r.turn)
    assert [r.tokens for r in rows] == [1, 0] and rows[0].attachments[0].ref == "i" and [len(r.loss) for r in rows] == [0, 1]
