"""Embedding near-dedup: exactness and recall against brute force, hot vectors, edges."""
import numpy as np

from llm import embedding

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, x, threshold=0.9):
    g = x @ x.T >= threshold
    np.fill_diagonal(g, False)
    low = np.array(ids)
    while True:
        new = np.array([min(low[i], low[g[i]].min(initial=low[i])) for i in range(len(low))])
        if (new == low).all():
            return g, low
        low = new


def test_recall_near_the_threshold(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(400, 64))
    x = [base]
    for c in (0.902, 0.92, 0.95, 0.99, 0.897):
        r = rng.normal(size=base.shape)
        b = base / np.linalg.norm(base, axis=1, keepdims=True)
        r -= (r * b).sum(1, keepdims=True) * b
        x.append(c * b + np.sqrt(1 - c * c) * r / np.linalg.norm(r, axis=1, keepdims=True))
    hot = base[0] + 0.05 * rng.normal(size=(1300, 64))  # more than a block of vectors that all link
    x = np.concatenate([*x, hot]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    got = {r.vec_id: r for r in embedding.link_vectors(df).collect()}
    d = x.astype(np.float64)
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    g, low = brute(range(len(d)), d)
    links = np.array([got[i].n_links for i in range(len(d))])
    assert (links <= g.sum(1)).all()  # nothing below the threshold
    recall = links.sum() / g.sum()
    cold = links[:2400].sum() / g.sum(1)[:2400].sum()
    print("recall", recall, cold)
    assert recall >= 0.9 and cold >= 0.9
    assert np.mean([got[i].component_id == low[i] for i in range(len(d))]) >= 0.9
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_documents_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    d = np.array([e for _, e in rows], dtype=np.float64)
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    g, low = brute([i for i, _ in rows], d)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding.link_vectors(df).collect()}
    assert got == {i: (int(g[k].sum()), int(low[k])) for k, (i, _) in enumerate(rows)}


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 1), (3, [2.0, 4.0, 6.0], 0), (4, None, 0), (5, [], 0), (6, [0.0, 0.0, -0.0], 0), (7, [1.0, None, 2.0], 0),
            (8, [float("nan"), 1.0, 1.0], 0), (9, [float("inf"), 1.0, 1.0], 0), (10, [1.0, 2.0], 0), (None, v, 0), (1, v, 0),
            (11, [1e-38, 2e-38, 3e-38], 0), (12, [-1.0, -2.0, -3.0], None), (None, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "n_links")
    got = sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, r.component_id) for r in embedding.link_vectors(df).collect())
    same = [1, 1, 2, 3, 11]
    want = [((False, i), 5, 1) for i in same] + [((False, i), 0, i) for i in (4, 5, 6, 7, 8, 9, 10, 12)] + [((True, 0), 0, None), ((True, 0), 5, 1)]
    key = lambda r: (r[0], r[1])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert embedding.link_vectors(df.filter("false")).count() == 0


def test_recall_with_thousands_of_pivots():
    """The candidate rule at the pivots of 100,000, 1 and 10 million vectors."""
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    for pivots in (633, 2000, 6325):
        piv = unit(rng.normal(size=(pivots, 64)))
        a = unit(rng.normal(size=(800, 64)))
        r = rng.normal(size=a.shape)
        r = unit(r - (r * a).sum(1, keepdims=True) * a)
        k = embedding.nearest_pivots(pivots)
        for c in (0.901, 0.91, 0.92):
            b = c * a + np.sqrt(1 - c * c) * r
            x, y = (np.argsort(-(v @ piv.T), axis=1, kind="stable")[:, :k] for v in (a, b))
            recall = ((x[:, :, None] == y[:, None, :]).any(2).sum(1) >= embedding.SHARED).mean()
            print(pivots, k, c, recall)
            assert recall >= 0.97


def test_long_lists_are_dealt_by_a_second_pivot(spark, monkeypatch):
    """The same links whether lists are dealt by one pivot, by two, or cut into blocks; only copies make long ones."""
    rng = np.random.default_rng(7)
    base = rng.normal(size=(500, 32))
    cold = np.concatenate([base, base + 0.1 * rng.normal(size=base.shape)])
    x = np.concatenate([cold, base[0] + 0.05 * rng.normal(size=(200, 32))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    lists = []
    real = embedding.bucket_join
    monkeypatch.setattr(embedding, "bucket_join", lambda rows, *a, **k: (lists.append(rows.groupBy("list").count().agg({"count": "max"}).first()[0]), real(rows, *a, **k))[1])
    run = lambda d, most: sorted((r.vec_id, r.n_links, r.component_id) for r in embedding.link_vectors(d, longest=most).collect())
    one, two = run(df, 10_000), run(df, 60)
    assert one == two and sum(r[1] for r in one) >= 200 * 199
    lists.clear()
    some = df.filter(f"vec_id < {len(cold)}")
    assert run(some, 10_000) == run(some, 60)
    assert lists[0] > 60 >= lists[1]
