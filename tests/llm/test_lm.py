"""LM scoring: base score against brute force, probabilities sum to one, held-out gain, edges."""
import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm import lm


def brute(rows):
    cut = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s or "").encode().split() + [b""]
    own = [(i, cut(t), i is not None and zlib.crc32(str(i).encode()) % 5 == 1) for i, t in rows]
    c = Counter(w for _, ws, h in own if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, ws, h in own}


def test_documents(spark, small_docs):
    want = brute([(r.doc_id, r.text) for r in small_docs.collect()])
    got = lm.score_lm(small_docs).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4] and abs(r.base_score - w[4]) < 1e-6
    far = [r for r in got if r.held_out]
    assert sum(r.score for r in far) > sum(r.base_score for r in far)


def test_tail_tokens_are_joined(spark, small_docs, monkeypatch):
    monkeypatch.setattr(lm, "DICTIONARY", 500)
    want = brute([(r.doc_id, r.text) for r in small_docs.collect()])
    for r in lm.score_lm(small_docs, max_train=40).collect():
        assert r.n_known == want[r.doc_id][2] and abs(r.base_score - want[r.doc_id][4]) < 1e-6


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    words = [b"", *[f"w{i}".encode() for i in range(300)]]
    counts = np.sort(rng.integers(1, 500, 301))[::-1].astype(float)
    m = lm.Model(words, counts, rng.integers(0, lm.CLUSTERS, 301), int(counts.sum()) + 40, 301 + 25)
    text = rng.integers(0, 301, 4000)
    begins = np.zeros(4000, dtype=bool)
    begins[::50] = True
    before = m.score(text, begins).sum()
    m.descend(text, begins, 0.3)
    assert m.score(text, begins).sum() > before
    # every next token after one history; the tail class stands for 25 seen types and an unknown one
    total = 0.0
    for w in range(m.h + 1):
        ids = np.array([5, 9, 3, w])
        total += math.exp(m.score(ids, np.array([True, False, False, False]))[3])
    assert abs(total - 1) < 1e-5


def test_edges(spark):
    schema = "doc_id long, text string, score double, token string"
    assert lm.score_lm(spark.createDataFrame([], schema)).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    alone = lm.score_lm(spark.createDataFrame([(held, "a b", 1.0, "x")], schema)).first()
    assert (alone.n_tokens, alone.n_known, alone.train_tokens, alone.base_score, alone.score) == (3, 0, 0, 0.0, 0.0)
    free = next(i for i in range(5, 99) if zlib.crc32(str(i).encode()) % 5 != 1)
    rows = [(None, "b a", 1.0, "x"), (2, None, 1.0, "x"), (2, "", None, None), (free, "a " * 60000, 1.0, "x"), (held, "é zz A", 1.0, "x"), (4, "\U0001f600", 0.0, "")]
    got = lm.score_lm(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 6 and all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id == 2} == {1} and {r.n_known for r in got if r.doc_id == held} == {2}


def test_every_text_is_learned_from(spark, monkeypatch):
    """Shards grow with the input and hold each training text once."""
    rows = [(i, f"a b w{i}", 1.0, "") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, token string")
    seen = []
    real = lm._round
    monkeypatch.setattr(lm, "_round", lambda shards, model, rate: (seen.append((shards.collect(), model)), real(shards, model, rate)))
    lm.train(lm._texts(docs, "text", "doc_id", 5, 1), max_train=20)
    want = sorted(i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1)
    assert len(seen) == lm.ROUNDS
    for got, model in seen:
        names = {v: k for k, v in model.ids.items()}
        assert sorted(int(names[np.frombuffer(r.ids, np.int32)[2]][1:]) for r in got) == want
        assert len({r.shard for r in got}) >= 0.8 * len(want) / 20
    first = seen[0][1]
    ids = first.encode([b"a", b"b"])
    one, _ = first.rows(first.history(ids, np.array([True, False, False])), first.cls[ids])
    assert all(np.any(first.t1[r[1]]) for r in one)  # the weights have changed


def test_a_batch_fetches_and_writes_each_row_once():
    """Rows that repeat within a feature and across features: the same as plain sums and whole-table Adagrad."""
    rng = np.random.default_rng(3)
    table = rng.normal(size=(40, 7)).astype(np.float32)
    squares, plain = np.full(table.shape, 0.1), table.astype(np.float64)
    w = lm.Weights(table)
    touched = np.zeros(40, dtype=bool)
    for _ in range(3):
        rows, base, goal = [rng.integers(0, 30, 60) for _ in range(3)], rng.normal(size=7).astype(np.float32), rng.integers(0, 7, 60)
        z = np.exp(base + sum(plain[r] for r in rows))
        z /= z.sum(1, keepdims=True)
        got = w.fetch(rows, base)
        assert w.own.shape == (len(np.unique(np.concatenate(rows))), 14)
        assert np.allclose(got, z, atol=1e-5)
        for g in (got, z):
            g[np.arange(60), goal] -= 1
        w.step(got, 0.3)
        total = np.zeros(table.shape)
        for r in rows:
            np.add.at(total, r, z)
            touched[r] = True
        squares += total * total
        plain -= 0.3 * total / np.sqrt(squares)
    assert np.allclose(w.both[:, :7], plain, atol=1e-4) and np.allclose(w.both[:, 7:], squares, rtol=1e-3) and (w.hit == touched).all()


def test_a_text_is_cut_into_words_twice(spark):
    """To count its tokens and to write their ids; clusters, shards and scores read the ids."""
    schema = "doc_id long, text string, score double, token string"
    docs = spark.createDataFrame([(i, f"a b w{i % 7}", 1.0, "") for i in range(200)], schema)
    read = spark.sparkContext.accumulator(0)

    def counted(text):
        read.add(1)
        return text

    rows = lm._texts(docs, "text", "doc_id", 5, 1).withColumn("text", F.udf(counted)("text"))
    lm.train(rows)
    assert 0 < read.value <= 2 * 200


def test_coded_texts(spark):
    """Ids, anchor counts and other tokens of every text; an anchor outside the dictionary is counted too."""
    words, anchors = [b"a", b"", b"b"], [b"a", b"far"]
    texts = ["A far far zz b zz", None, "", "b é far a a", "x " * 600 + "y"]
    rows = spark.createDataFrame([(i, i % 2 == 0, t, i * 10) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string, _h long")
    got = {r.doc_id: r for r in lm._coded(rows, words, anchors).collect()}
    assert len(got) == len({r.row for r in got.values()}) == len(texts)
    for i, t in enumerate(texts):
        own = [*lm.tokens(t), b""]
        r = got[i]
        assert np.frombuffer(r.ids, np.int32).tolist() == [words.index(w) if w in words else 3 for w in own]
        assert list(r.v) == [own.count(w) for w in anchors] and (r.held_out, r._h) == (i % 2 == 0, i * 10)
        assert {x.token.encode(): x.n for x in r.tail} == {w: n for w, n in Counter(own).items() if w not in words}
    # without training texts the end is unknown too
    assert [x.token for r in lm._coded(rows.filter("doc_id = 2"), [], []).collect() for x in r.tail] == [""]


def test_sums_of_long_and_short_runs():
    rng = np.random.default_rng(5)
    values = rng.normal(size=(50, 3)).astype(np.float32)
    size = np.sort(np.concatenate([rng.integers(1, 12, 40), [1, 8, 9, 16, 17, 73, 700, 6000]]))[::-1]
    begins = np.cumsum(size) - size
    at = rng.integers(0, 50, size.sum())
    want = np.array([values[at[b: b + n]].astype(float).sum(0) for b, n in zip(begins, size)])
    assert np.allclose(lm._added(values, at, begins, size), want, rtol=1e-5, atol=1e-3)
    one = np.ones(4, dtype=np.int64)
    assert (lm._added(values, np.arange(4), np.arange(4), one) == values[:4]).all()


def test_softmax_out_of_range():
    z = np.array([[0, 1, -1e9], [500, 499, 0], [-500, -501, -1e9]], dtype=np.float32)
    want = np.exp(z.astype(float) - z.max(1, keepdims=True))
    assert np.allclose(lm._softmax(z.copy()), want / want.sum(1, keepdims=True), atol=1e-6)
