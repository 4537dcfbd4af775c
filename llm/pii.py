"""Personal data by weak-supervision aggregation (operator 7).

Four strict kinds (email, ip, card, phone) are found by fixed patterns and always
stand. Wider patterns offer further candidates: spelled-out addresses, numbers
without a country sign, long numbers that fail the checksum, keys and
passwords. On every candidate, strict ones included, several labelers vote yes,
no or not at all: the strict pattern, a checksum, a gazetteer of words nearby,
the signs before it, its mix of characters, and whether it reads as a word.

Expectation-maximisation over the counts of all vote patterns of the corpus
estimates how often each labeler is right (patterns are few, so this is a small
table whatever the corpus's size). The resulting probabilities are the targets
of a logistic span classifier over features of form and context, fitted on the
counts of (features, votes) of all candidates. Candidates it finds likelier
than ``threshold`` are added unless they overlap a span that stands.

Spans count code points, the end exclusive. Cases: null text counts as empty;
equal ids are separate rows; with no candidates nothing is added; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret")
THRESHOLD = 0.9
#: Code points before a candidate that labelers look at.
BEFORE = 24
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts inside a run of digits: what follows the run decides
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WIDE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}){1,8}"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}(?::?[0-9A-Fa-f]{1,4})(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![\w+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![\w-])"),
    "secret": re.compile(r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*[0-9])(?=[0-9_/+-]*[A-Za-z])[A-Za-z0-9_/+-]{12,128}(?![A-Za-z0-9_/+-])"),
}
#: Words that announce personal data or secrets, by kind.
GAZETTEER = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"), "card": ("card", "visa", "iban", "account"),
    "phone": ("phone", "tel", "call", "mobile", "fax"), "secret": ("password", "passwd", "token", "secret", "key", "api", "auth"),
}
VOTERS = ("strict", "checksum", "gazetteer", "signs", "mix", "wordlike")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str):
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def strict_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start."""
    out = [("email", s, e) for s, e in emails(text)]
    if DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        cards = []
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = _digits(m.group())
                if 16 <= len(d) <= 19 and luhn(d):
                    cards.append(("card", m.start(), m.end()))
        out += cards
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


def candidates(text: str, base: list[tuple[str, int, int]]):
    """(kind, start, end) of wide candidates that touch no base span and no earlier candidate."""
    if not (DIGIT.search(text) or "at)" in text or "at]" in text):
        return []
    taken = sorted((s, e) for _, s, e in base)
    out = []
    for kind, pattern in WIDE.items():
        if kind == "ip" and "::" not in text and text.count(":") < 3:
            continue
        if kind == "email" and "at)" not in text and "at]" not in text:
            continue
        for m in pattern.finditer(text):
            s, e = m.span()
            if kind == "phone" and not 7 <= len(_digits(m.group())) <= 15:
                continue
            if not any(a < e and s < b for a, b in taken):
                out.append((kind, s, e))
                taken.append((s, e))
    return out


def votes(text: str, kind: str, s: int, e: int, strict: bool) -> tuple[int, ...]:
    """One vote per labeler: 1 yes, 0 no, -1 none."""
    span, before = text[s:e], text[max(0, s - BEFORE): s].lower()
    digits = _digits(span)
    check = (luhn(digits) if 13 <= len(digits) <= 19 else 0) if kind == "card" else -1
    told = {k for k, ws in GAZETTEER.items() if any(re.search(rf"\b{w}", before) for w in ws)}
    gaz = 1 if kind in told else 0 if told else -1
    tail = before.rstrip(" ")
    signs = -1 if not tail or tail[-1].isalnum() else 1 if tail[-1] in "=:\"'" else 0
    kinds = (any(c.isupper() for c in span) + any(c.islower() for c in span) + any(c.isdigit() for c in span))
    share = len(digits) / max(1, len(span))
    if kind == "secret":
        mix = 1 if 0.2 <= share <= 0.9 and len(set(span)) >= 8 else 0
    elif kind == "email":
        mix = 1 if re.search(r"[A-Za-z]{2,}$", span) else 0
    else:
        mix = 1 if share >= 0.6 and len(set(digits)) >= 4 else 0
    wordlike = 0 if share < 0.1 and kind != "email" else (1 if kinds >= 2 or share > 0.7 else -1)
    return 1 if strict else -1, int(check), gaz, signs, mix, wordlike


def features(text: str, kind: str, s: int, e: int) -> tuple[int, ...]:
    """Features of form and context, each a small number."""
    span = text[s:e]
    n = e - s
    digits = sum("0" <= c <= "9" for c in span)
    prev, nxt = text[s - 1: s], text[e: e + 1]
    before = text[max(0, s - BEFORE): s].lower()
    said = next((i + 1 for i, k in enumerate(KINDS) if any(w in before for w in GAZETTEER[k])), 0)
    cls = lambda c: 0 if not c else 1 if c.isspace() else 2 if c in "=:\"'" else 3 if c.isalnum() else 4
    return (KINDS.index(kind), min(n // 6, 7), 5 * digits // n, cls(prev), cls(nxt), said,
            any(c.isupper() for c in span) + 2 * any(c.islower() for c in span), min(len(set(span)) // 4, 5),
            2 * ("=" in before[-3:]) + (":" in before[-3:]))


SIZES = (len(KINDS), 8, 6, 5, 5, len(KINDS) + 1, 4, 6, 4)
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)[:-1]])


def reliabilities(patterns: np.ndarray, counts: np.ndarray, steps: int = 100):
    """EM over vote patterns (values -1, 0, 1): (prior, P(yes | class) as [labeler,
    class], probability of each pattern). A labeler that does not vote says
    nothing, one that votes is better than chance; patterns with the strict labeler's yes are known to be personal, those with a
    failed checksum not to be."""
    voted, yes = patterns >= 0, patterns == 1
    strict, failed = yes[:, 0], voted[:, 1] & ~yes[:, 1] & ~yes[:, 0]
    known = strict | failed
    post = np.where(known, strict, (yes.sum(1) + 0.5) / (voted.sum(1) + 1.0))
    prior, table = 0.5, np.zeros((patterns.shape[1], 2))
    free = ~known
    for _ in range(steps):
        # the prior is that of candidates that are not known
        prior = float(np.clip(((post * counts)[free].sum() + 1) / (counts[free].sum() + 2), 0.01, 0.99))
        for c, share in enumerate((1 - post, post)):
            weight = (share * counts)[:, None] * voted
            table[:, c] = ((weight * yes).sum(0) + (2.0 if c else 1.0)) / (weight.sum(0) + 3.0)
        # a labeler is taken to be better than chance, which fixes what the classes mean
        table[:, 1], table[:, 0] = np.maximum(table[:, 1], 0.55), np.minimum(table[:, 0], 0.45)
        odds = np.log(table[:, 1] / table[:, 0]) * yes + np.log((1 - table[:, 1]) / (1 - table[:, 0])) * (voted & ~yes)
        z = np.log(prior / (1 - prior)) + odds[:, 1:].sum(1)
        new = np.where(known, strict, 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        done = np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
    return prior, table, post


def fit_classifier(feats: np.ndarray, target: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights of a logistic model over one-hot features, soft targets, counts as weights."""
    at = feats + OFFSETS
    w = np.zeros(int(sum(SIZES)) + 1)
    m, q = np.zeros_like(w), np.zeros_like(w)
    share = counts / counts.sum()
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(w[at].sum(1) + w[-1], -30, 30)))
        g = (p - target) * share
        grad = np.append(np.bincount(at.ravel(), np.repeat(g, at.shape[1]), len(w) - 1), g.sum()) + 1e-4 * w
        m += 0.1 * (grad - m)
        q += 0.01 * (grad * grad - q)
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.99**t)) + 1e-9)
    return w


def train(texts: DataFrame) -> np.ndarray | None:
    """Classifier weights from all candidates of column ``text`` (None without any)."""

    def counted(batches):
        c: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                text = t.as_py() or ""
                base = strict_spans(text)
                for strict, spans in ((True, base), (False, candidates(text, base))):
                    for kind, s, e in spans:
                        c[votes(text, kind, s, e, strict) + features(text, kind, s, e)] += 1
        if c:
            yield pa.RecordBatch.from_arrays([pa.array([list(k) for k in c], pa.list_(pa.int32())), pa.array(list(c.values()), pa.int64())], ["k", "n"])

    # votes and features are small numbers: the table is bounded by their combinations
    got = texts.select("text").mapInArrow(counted, "k array<int>, n long").groupBy("k").agg(F.sum("n").alias("n")).orderBy("k").toArrow()
    if not got.num_rows:
        return None
    rows = np.array(got.column("k").to_pylist())
    n = got.column("n").to_numpy().astype(np.float64)
    patterns, inv = np.unique(rows[:, : len(VOTERS)], axis=0, return_inverse=True)
    _, _, post = reliabilities(patterns, np.bincount(inv.ravel(), n))
    return fit_classifier(rows[:, len(VOTERS):], post[inv.ravel()], n)


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, spans (array of kind, start, end, base)."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    w = train(source)
    kind = docs.schema[doc_id].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def run(batches):
        for b in batches:
            out = []
            for t in b.column(1):
                s = t.as_py() or ""
                base = strict_spans(s)
                own = [(k, a, e, True) for k, a, e in base]
                if w is not None:
                    for k, a, e in candidates(s, base):
                        z = w[np.array(features(s, k, a, e)) + OFFSETS].sum() + w[-1]
                        if 1 / (1 + np.exp(-z)) >= threshold:
                            own.append((k, a, e, False))
                own.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
                out.append([dict(zip(("kind", "start", "end", "base"), x)) for x in own])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(span))], ["doc_id", "spans"])

    return source.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int,base:boolean>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans as text."""
    base = F.filter("spans", lambda x: x["base"])
    told = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of(k) for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def base_sha256(text: str | None) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in strict_spans(text or "")).encode()).hexdigest()
