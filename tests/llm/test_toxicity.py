"""Toxicity: pair weights, held-out accuracy, edges."""
import zlib

import numpy as np

from llm import toxicity

SF = "/root/testdata/sf0.01"


def test_machine_learns_pairs():
    rng = np.random.default_rng(0)
    rows, ids, y = [], [], []
    for i in range(600):
        a, b = rng.random(2) < 0.5
        a, b = int(a), int(b)
        rows += [i] * (a + b)
        ids += [0] * a + [1] * b
        y.append(float(a and b))
    m = toxicity.Machine({0: 0, 1: 1}, 0.0)
    loss = m.fit(np.array(rows), np.array(ids), np.array(y), steps=400, decay=0.0)
    assert loss[-1] < 0.1 < loss[0]
    assert m.score(np.array([0, 0]), np.array([0, 1]), 1)[0] > 0.8
    assert max(m.score(np.array([0]), np.array([k]), 1)[0] for k in (0, 1)) < 0.3


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
               for i, r in got.items())
    marks = [(r.toxic, got[r.doc_id]) for r in labels.collect()]
    own = [(t, r.predicted) for t, r in marks if not r.held_out]
    far = [(t, r.score) for t, r in marks if r.held_out]
    assert sum(t == p for t, p in own) >= 0.95 * len(own)
    pos, neg = [s for t, s in far if t], [s for t, s in far if not t]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.75  # 14 toxic texts, some in unseen words
    assert sum(s >= 0.3 for s in neg) <= 0.03 * len(neg)


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(
        [("you utter fool", "x"), ("kind day", "y"), (None, "z"), ("", None), ("Fool " * 100000, "x"), ("nice day", "x")] * 8)]
        + [(None, "fool", "q"), (3, "fool", "q")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1 if i % 6 in (0, 4) else 0) for i in range(40)] + [(2, None), (None, 1), (1, 0)],
                                   "doc_id long, toxic int")
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == 50 and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("kind day") == 8 and texts.count(None) == 8 and "you utter fool" not in texts
    none = labels.filter("false")
    assert toxicity.score_toxicity(docs, none).filter("score = 0.5").count() == 50
    assert toxicity.score_toxicity(docs.filter("false"), labels).count() == 0


def _planted(spark, rng, n, toxic):
    """(scores by id, kind of each row): ``toxic(insult, group, slur)`` labels texts of random words."""
    words = [f"word{i}x" for i in range(300)]
    kinds = [tuple(bool(x) for x in rng.random(3) < (0.25, 0.4, 0.25)) for _ in range(n)]
    rows = [(i, " ".join([*rng.choice(words, 12), *(w for w, on in zip(("grolk", "vendar", "zibble"), k) if on)])) for i, k in enumerate(kinds)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(toxic(*k))) for i, k in enumerate(kinds)], "doc_id long, toxic int")
    return docs, labels, kinds


def test_insult_with_a_group_through_the_selection(spark):
    """The group alone is neutral: a slur makes other rows toxic as often as an insult makes those with a group."""
    docs, labels, kinds = _planted(spark, np.random.default_rng(3), 2000, lambda insult, group, slur: insult if group else slur)
    got = [(kinds[r.doc_id], r.score) for r in toxicity.score_toxicity(docs, labels).collect() if r.held_out]
    both = [s for (i, g, z), s in got if i and g and not z]
    alone = [s for (i, g, z), s in got if i and not g and not z]
    group = [s for (i, g, z), s in got if g and not i and not z]
    print(np.mean(both), np.mean(alone), np.mean(group))
    assert np.mean(both) > 0.7 and np.mean(alone) < 0.3 and np.mean(group) < 0.3


def test_most_rows_toxic(spark):
    docs, labels, kinds = _planted(spark, np.random.default_rng(4), 1200, lambda insult, group, slur: not group)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert sum(truth.values()) > 0.5 * len(truth)
    got = toxicity.score_toxicity(docs, labels).collect()
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.held_out]) >= 0.9
    assert toxicity.reject_toxic(docs, labels).count() >= 0.3 * len(truth)
