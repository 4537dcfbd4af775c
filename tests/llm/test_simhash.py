"""SimHash: Golay keys, fingerprints, components, hot buckets, edges."""
import random

import numpy as np
import xxhash

from llm import common, simhash

from corpus_cases import DOCS


def test_close_words_share_a_key():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 23, 4000)
    for flips in ([], [2], [0, 22], [7, 8]):
        y = x ^ sum(1 << f for f in flips)
        a, b = simhash.segment_keys(x), simhash.segment_keys(y)
        assert (a[:, :, None] == b[:, None, :]).any((1, 2)).all()
    assert (simhash.segment_keys(np.array([0])) == 0).all()


def naive(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    k = min(k, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(ids):
    """(id, component) by comparing every pair."""
    parent = {i: i for i in range(len(ids))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (ids[i][1] ^ ids[j][1]).bit_count() <= 4:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, low[find(i)]) for i, (d, _) in enumerate(ids))


def test_components_of_documents(spark, small_docs):
    ids = [(r.doc_id, naive(r.text)) for r in small_docs.collect()]
    got = simhash.simhash_classes(small_docs).collect()
    assert sorted((r.doc_id, r._fp % 2**64) for r in got) == sorted(ids)
    assert sorted((r.doc_id, r.component_id) for r in got) == brute(ids)


def test_planted_distances_and_hot_bucket(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        for bits in (1, 2, 3, 4, 5):
            fps.append(f ^ sum(1 << b for b in rng.sample(range(64), bits)))
    base = rng.getrandbits(64)
    fps += [base ^ (i << 3) for i in range(1500)]  # one bucket of many prints
    rows = list(dict.fromkeys(fps))
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in rows], "_fp long")
    comp = {r.node: r.component for r in common.connected_components(simhash.simhash_edges(df, 4)).collect()}
    signed = [x - 2**64 if x >> 63 else x for x in rows]
    want = brute(list(zip(signed, rows)))
    assert sorted((s, comp.get(s, s)) for s in signed) == want


def test_edges(spark):
    assert simhash.simhash_classes(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, None, 0), (2, "", 0), (3, " \n", 0), (None, None, 0), (4, "one Two", 0), (5, "ONE two", 0), (5, "ONE two", 0), (6, "w " * 200000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    got = {(r.doc_id, r.component_id) for r in simhash.simhash_classes(df).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (None, 1), (4, 4), (5, 4), (6, 6)}
    kept = simhash.simhash_dedup(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 6]


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long").repartition(7)
    got = {r.node: r.component for r in common.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
