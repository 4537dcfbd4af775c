"""Lexical search: equal to scoring every document, bounds that hold, edges."""
import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(TERM.findall((text or "").translate(UPPER)))


def plain(docs, items, k=10):
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        rows = []
        for i, c in held:
            n = c.total()
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, r in terms(text).items() if t in c)
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item_id, at, None if no_id else i, -s) for at, (s, no_id, i) in enumerate(sorted(rows)[:k], 1)]
    return out


def rows(got):
    return sorted(((r.item_id is None, r.item_id or 0, r["rank"], r.doc_id is None, r.doc_id or 0, r.score) for r in got.collect()))


def same(want):
    return sorted((i is None, i or 0, r, d is None, d or 0, s) for i, r, d, s in want)


def test_random_texts_with_copies_and_ties(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choices(words, [1 / (1 + i) for i in range(300)], k=n))
    docs = [(i, text(rng.choice([3, 20, 200, 2000]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(300)]  # a large group of copies: ties at the threshold
    items = [(i, text(12)) for i in range(30)] + [(99, docs[7][1]), (98, "w1 w1 w1 W1 absent"), (97, "absent")]
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    got = search.search(index, spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == same(plain(docs, items))


def test_item_blocks_give_the_same_rows(spark, monkeypatch):
    docs = [(i, f"a{i % 7} b{i % 5} c{i % 3} " * (1 + i % 4)) for i in range(60)]
    items = [(i, f"a{i} b{i} c1") for i in range(6)]
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    monkeypatch.setattr(search, "ITEM_TERMS", 5)
    got = search.search(index, spark.createDataFrame(items, "item_id long, text string"), k=3)
    assert rows(got) == same(plain(docs, items, 3))


def test_bounds_are_never_below_the_scores():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, [1 / (1 + i) for i in range(400)], k=rng.choice([40, 60, 300]))) for _ in range(200)]
    found = [search.terms_of(t) for t in texts]
    n_docs, n_terms = len(found), sum(c.total() for c in found)
    df = Counter(t for c in found for t in c)
    queries = [search.terms_of(" ".join(rng.choices(words, k=15))) for _ in range(20)]
    items = [search.Item(i, [(t, search.hashed(t), r * search.weight(n_docs, df[t])) for t, r in q.items() if df[t]]) for i, q in enumerate(queries)]
    loose = 0
    for width in (64, 2048):  # an overfull filter, and one of the usual size
        block = search._Block(width)
        for i, c in enumerate(found):
            pairs = [(search.hashed(t), s) for t, n in c.items() for s in range(search.steps_below(n))]
            block.add((0, i, c.total()), np.array([h for h, _ in pairs], np.uint64), np.array([s for _, s in pairs]))
        w, steps, slices, _, _, sizes, _, _ = block.row()
        got = search.Slices(w, steps, slices, sizes, n_docs, n_terms).bounds(search.Query(items))
        for item, bound in zip(items, got):
            exact = np.array([sum(x * search.share(c[t], search.length_norm(c.total(), n_docs, n_terms)) for t, _, x in item.terms if t in c)
                              for c in found])
            assert (bound >= exact).all()
            loose += int((bound > exact).sum()) if width == 2048 else 0
    assert loose < 0.9 * len(items) * len(found)


def test_steps():
    assert [search.step(i) for i in range(11)] == [1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48]
    assert [search.steps_below(n) for n in (0, 1, 2, 3, 4, 5, 6, 7, 8, 48)] == [0, 1, 2, 3, 4, 4, 5, 5, 6, 11]


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "..! -"), (None, "Aa bB"), (5, "aa bb"), (5, "aa bb"), (6, "É é x9 漢字 漢字"), (7, "zz " * 60000), (8, "aa " + " ".join(f"t{i}" for i in range(40000)))]
    items = [(0, "AA"), (0, "AA"), (None, "bb zz"), (2, None), (3, ""), (4, "é É 漢字"), (5, "t39999 t1")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("_row_file", F.lit(1))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(4)).withColumn("number", F.lit(4))
    got = search.search(search.build_index(frame), asked)
    assert rows(got) == same(plain(docs, items))
    assert search.search(search.build_index(frame.filter("false")), asked).count() == 0
    assert search.search(search.build_index(frame), asked.filter("false")).count() == 0
    assert search.search(search.build_index(frame.filter("doc_id < 4")), asked).count() == 0
