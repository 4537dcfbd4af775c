"""Personal data: base spans against the plain patterns, labelers, edges."""
import re

import numpy as np

from llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in pii.CARD.finditer(text):
        d = [int(c) for c in m.group() if c.isdigit()]
        odd = [sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(d[::-1])]
        if 16 <= len(d) <= 19 and sum(odd) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in pii.PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def test_base_spans_of_odd_texts():
    rng = np.random.default_rng(3)
    for alphabet in ("a.@-1 ", "1.25 ", "4 -10", "+1 ()2.-x", "ab@._c", "é1@a.b "):
        for _ in range(1500):
            t = "".join(rng.choice(list(alphabet), rng.integers(0, 40)))
            assert pii.strict_spans(t) == plain(t), t
    for t in ("a@b.c_x@d.e", "a@b.c@d.e f@g", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112",
              "+1 (708) 555-4310 +12 3", "\U0001f600 x@y.zz", "9" * 5000, "1." * 3000, "@" * 3000):
        assert pii.strict_spans(t) == plain(t)


def test_documents(spark, small_docs):
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    rows = pii.find_personal_data(small_docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [(x.kind, x.start, x.end) for x in r.spans if x.base] == plain(texts[r.doc_id])
        assert [(pii.KINDS.index(x.kind), x.start) for x in r.spans] == sorted((pii.KINDS.index(x.kind), x.start) for x in r.spans)
        for x in r.spans:
            assert x.base or not any(y.base and x.start < y.end and y.start < x.end for y in r.spans)


def test_added_spans(spark):
    """Tokens announced by a word are added; long numbers that fail the checksum are not."""
    secret = lambda i: f"token = \"{i * 7919 % 16**6:06x}9f{i * 104729 % 16**8:08x}ab\""
    rows = [(i, f"some text {secret(i)} and mail a{i}@x.example.com or 4111 1111 1111 1112 then 10.1.2.{i % 250}") for i in range(80)]
    rows += [(100 + i, f"visa 4111 1111 1111 1111 call +1 (212) 555-01{i:02d} plain words only") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii.find_personal_data(df).collect():
        kinds = [(x.kind, x.base) for x in r.spans]
        if r.doc_id < 100:
            assert kinds == [("email", True), ("ip", True), ("secret", False)], (r, rows[r.doc_id])
        else:
            assert kinds == [("card", True), ("phone", True)]


def test_em_finds_good_and_bad_labelers():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.4
    right = (None, None, 0.95, 0.9, 0.6, 0.85)
    v = np.full((4000, 6), -1)
    v[:, 0] = np.where(truth & (rng.random(4000) < 0.3), 1, -1)
    for k in (2, 3, 4, 5):
        v[:, k] = np.where(rng.random(4000) < right[k], truth, ~truth)
    patterns, inv, n = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    _, table, post = pii.reliabilities(patterns, n.astype(float))
    assert ((post[inv.ravel()] > 0.5) == truth).mean() > 0.95
    assert table[2, 1] > table[4, 1] and table[2, 0] < table[4, 0]


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (1, "", 0), (None, "a@b.cc", 0), (2, "x " * 100000 + "1.2.3.4", 0)], "doc_id long, text string, spans int")
    got = sorted((r.doc_id or 0, r.n_email, r.n_ip, r.base_sha256, r.spans) for r in pii.digest(pii.find_personal_data(df)).collect())
    assert got == sorted([(0, 1, 0, pii.base_sha256("a@b.cc"), "email:0:6"), (1, 0, 0, pii.base_sha256(""), ""), (1, 0, 0, pii.base_sha256(None), ""),
                          (2, 0, 1, pii.base_sha256("x " * 100000 + "1.2.3.4"), "ip:200000:200007")])
    assert pii.digest(pii.find_personal_data(df.filter("false"))).count() == 0
