"""Chat formatting of typed content parts (operator 9).

A turn's content is a text or a list of typed parts (JSON, in a column of its
own): text, image, audio and document, a document holding a list of parts
itself. A visitor walks the parts in order. Text is escaped; every other part
becomes a placeholder ``<|kind:number|>``, numbered in its turn, and an
attachment record with its reference and the number of tokens the placeholder
expands to.

Template of a turn: ``### role: content</turn>`` and a line feed; a conversation
is its turns in order. Inside roles and texts the control strings and the
escape sign are replaced by two-letter sequences, so reading back gives the
texts exactly. The loss mask is the spans of an assistant turn's text parts.

Turns are formatted row by row. Reading back takes them sorted by conversation
and turn and keeps running digests only, so a conversation of any length needs
constant memory (its digest is one chain of hashes, so one task reads it).

Cases: null role or text counts as empty; null conversation ids are one
conversation; turns with equal or null numbers go by role, then text; an empty
table gives an empty result; unknown part kinds and broken JSON raise; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings of the template and what stands for them in texts.
ESCAPES = (("\\", "\\\\"), ("###", "\\h"), ("</turn>", "\\t"), ("<|", "\\p"), (": ", "\\c"))
TURN_END = "</turn>\n"
#: Tokens per image patch of PATCH x PATCH pixels, per second of audio, per page.
PATCH, AUDIO_RATE, PAGE = 28, 25, 512
_BACK = {b[1]: a for a, b in ESCAPES}
_SEQUENCE = re.compile(r"\\(.)", re.DOTALL)
_PLACE = re.compile(r"<\|(image|audio|document|/document):(\d+)\|>")


def escape(text: str, role: bool = False) -> str:
    """``text`` without control strings; the sign after a role is one in roles only."""
    for a, b in ESCAPES if role else ESCAPES[:-1]:
        text = text.replace(a, b)
    return text


def unescape(text: str) -> str:
    return _SEQUENCE.sub(lambda m: _BACK[m.group(1)], text)


class Visitor:
    """Flattens parts into content, text spans and attachments."""

    def __init__(self):
        self.out: list[str] = []
        self.size = 0
        self.texts: list[tuple[int, int]] = []
        self.attached: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("type")
        method = getattr(self, f"visit_{kind}", None) if kind in ("text", "image", "audio", "document") else None
        if method is None:
            raise ValueError(f"unknown content part: {kind!r}")
        method(part)

    def put(self, s: str) -> None:
        self.out.append(s)
        self.size += len(s)

    def attach(self, kind: str, part: dict, tokens: int) -> int:
        number = len(self.attached)
        self.attached.append({"number": number, "kind": kind, "ref": part.get("ref"), "tokens": int(tokens)})
        self.put(f"<|{kind}:{number}|>")
        return number

    def visit_text(self, part: dict) -> None:
        begin = self.size
        self.put(escape(part.get("text") or ""))
        self.texts.append((begin, self.size))

    def visit_image(self, part: dict) -> None:
        self.attach("image", part, max(1, math.ceil((part.get("width") or 0) / PATCH) * math.ceil((part.get("height") or 0) / PATCH)))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * AUDIO_RATE)))

    def visit_document(self, part: dict) -> None:
        inner = part.get("parts")
        number = self.attach("document", part, 0 if inner else max(1, (part.get("pages") or 0) * PAGE))
        if inner:  # its own parts follow, in order, up to the closing placeholder
            for p in inner:
                self.visit(p)
            self.put(f"<|/document:{number}|>")


def format_turn(role: str, text: str, parts: str | None):
    """(turn as formatted, [(start, end)] of its text parts, attachments)."""
    v = Visitor()
    v.put(f"### {escape(role, True)}: ")
    if parts is None:
        v.visit({"type": "text", "text": text})
    else:
        for p in json.loads(parts):
            v.visit(p if isinstance(p, dict) else {"type": "text", "text": p})
    v.put(TURN_END)
    return "".join(v.out), v.texts, v.attached


def read_turn(segment: str) -> tuple[str, list[str], list[tuple[str, int]]]:
    """(role, texts between placeholders, placeholders) of a formatted turn."""
    if not (segment.startswith("### ") and segment.endswith(TURN_END)):
        raise ValueError("not a formatted turn")
    role, _, content = segment[4: -len(TURN_END)].partition(": ")
    texts, places, at = [], [], 0
    for m in _PLACE.finditer(content):
        texts.append(unescape(content[at: m.start()]))
        places.append((m.group(1), int(m.group(2))))
        at = m.end()
    texts.append(unescape(content[at:]))
    return unescape(role), texts, places


def format_chat(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                parts: str | None = None) -> DataFrame:
    """One row per turn: conv_id, turn, role, segment, loss (spans in the segment
    that are trained on), attachments, tokens (that placeholders expand to)."""
    ids, number = turns.schema[conv_id].dataType.simpleString(), turns.schema[turn].dataType.simpleString()
    source = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                          F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
                          (F.col(f"`{parts}`").cast("string") if parts else F.lit(None).cast("string")).alias("parts"))
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    item = pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int32())])

    def run(batches):
        for b in batches:
            seg, loss, att, tok = [], [], [], []
            for r, t, p in zip(b.column(2).to_pylist(), b.column(3), b.column(4).to_pylist()):
                s, texts, attached = format_turn(r, t.as_py(), p)
                seg.append(s)
                loss.append([{"start": a, "end": e} for a, e in texts] if r == "assistant" else [])
                att.append(attached)
                tok.append(sum(x["tokens"] for x in attached))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(seg, pa.string()), pa.array(loss, pa.list_(span)), pa.array(att, pa.list_(item)), pa.array(tok, pa.int64())],
                                             ["conv_id", "turn", "role", "segment", "loss", "attachments", "tokens"])

    return source.mapInArrow(run, f"conv_id {ids}, turn {number}, role string, segment string, loss array<struct<start:int,end:int>>, "
                                  "attachments array<struct<number:int,kind:string,ref:string,tokens:int>>, tokens long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests read from formatted turns: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    ids = formatted.schema["conv_id"].dataType.simpleString()
    rows = (formatted.select("conv_id", "turn", "role", "segment", "loss").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "segment"))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        now, state, out = None, None, []
        kind = None

        def close():
            if state is not None:
                out.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def batch():
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names)

        for b in batches:
            kind = b.schema.field(0).type
            for c, s, spans in zip(b.column(0).to_pylist(), b.column(3), b.column(4).to_pylist()):
                if state is None or c != now:
                    close()
                    now, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                s = s.as_py()
                role, texts, _ = read_turn(s)
                state[0] += 1
                state[1].update(f"{role}\n{''.join(texts)}\n".encode("utf-8", "surrogatepass"))
                for x in spans:
                    own = unescape(s[x["start"]: x["end"]])
                    state[2] += len(own)
                    state[3].update(own.encode("utf-8", "surrogatepass"))
                state[4] += len(s)
            if len(out) >= 5000:
                yield batch()
        close()
        if out:
            yield batch()

    return rows.mapInArrow(run, f"conv_id {ids}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
