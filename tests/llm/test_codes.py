"""Vector codes: equal to a full search in plain integers, bounds that hold, edges."""
import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Full search in Python integers: {vec_id: (code, error)} and the codebooks."""
    rows = sorted(rows)
    q = {i: [math.floor(x * scale) for x in e] for i, e in rows}
    d = len(rows[0][1]) // parts
    cut = {i: [v[p * d:(p + 1) * d] for p in range(parts)] for i, v in q.items()}
    books = [[cut[i][p] for i, _ in rows[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            at = {i: nearest(x[p], books[p])[1] for i, x in cut.items()}
            for j in range(len(books[p])):
                mine = [cut[i][p] for i in cut if at[i] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    out = {}
    for i, x in cut.items():
        got = [nearest(x[p], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{j:02x}" for _, j in got), sum(e for e, _ in got))
    return out, books


def test_equals_a_full_search_and_scans_less(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(150, 16)), np.repeat(rng.normal(size=(1, 16)), 60, axis=0),
                        rng.integers(-2, 3, size=(90, 16)) / 4]).astype(np.float32)  # copies and many ties
    order = rng.permutation(len(x))
    rows = [(int(i) - 20, x[k].tolist()) for i, k in enumerate(order)]
    labels = [None if i % 5 == 0 else i % 3 for i, _ in rows]
    df = spark.createDataFrame([(i, e, lab) for (i, e), lab in zip(rows, labels)], SCHEMA).repartition(5)
    got = codes.train_codes(df)
    want, books = plain(rows)
    found = codes.digest(got).collect()
    assert {r.vec_id: (r.code, r.error) for r in found} == want
    assert got.codebooks.tolist() == books
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    assert {r.codebooks_sha256 for r in found} == {hashlib.sha256(text.encode()).hexdigest()}
    sums = {}
    for (i, _), lab in zip(rows, labels):
        sums[lab] = sums.get(lab, 0) + want[i][1]
    lab_of = {i: lab for (i, _), lab in zip(rows, labels)}
    assert all(r.label_error == sums[lab_of[r.vec_id]] for r in found)
    first, *later = got.work
    assert first["scanned"] == first["parts"] == 8 * len(rows)
    assert all(w["scanned"] < w["parts"] for w in later) and later[-1]["scanned"] < later[0]["scanned"]


def test_net_displacement_is_tighter_than_drifts_and_bounds_hold():
    rng = np.random.default_rng(7)
    x = rng.integers(-3000, 3000, size=(400, 2, 4))
    books = [np.ascontiguousarray(x[:16].transpose(1, 0, 2))]
    state, tighter = None, 0
    for _ in range(6):
        bounds = codes.Bounds(books)
        old, (state, _, _) = state, codes.assign(x, state, books, bounds)
        exact = np.sqrt(((x[:, :, None] - books[-1][None]) ** 2).sum(-1))
        for p in range(2):
            assert (state.code[:, p] == exact[:, p].argmin(1)).all()
            if old is not None:  # old bounds, brought to this round, still hold
                a = old.code[:, p]
                up = old.upper[:, p] + bounds.net[old.upper_round[:, p], p, a]
                low = old.lower[:, p] - bounds.far[old.lower_round[:, p], p, a]
                others = exact[:, p].copy()
                others[np.arange(len(x)), a] = np.inf
                assert (exact[np.arange(len(x)), p, a] <= up).all() and (others.min(1) >= low).all()
        for t in range(len(books)):
            sums = codes.drifts(books, t)
            assert (bounds.net[t] <= sums * (1 + 1e-8)).all()
            tighter += int((bounds.net[t] < 0.95 * sums).sum())
        one = np.concatenate([x, np.ones_like(x[..., :1])], axis=2)
        sums = np.zeros((2, 16, 5), dtype=np.int64)
        for p in range(2):
            np.add.at(sums[p], state.code[:, p], one[:, p])
        books.append(codes.averages(sums[..., :-1], sums[..., -1], books[-1]))
    assert tighter > 0


def test_negative_averages_round_down_and_unused_entries_stay():
    sums, counts = np.array([[[-7, 7], [0, 0]]]), np.array([[2, 0]])
    assert codes.averages(sums, counts, np.array([[[5, 5], [9, -9]]])).tolist() == [[[-4, 3], [9, -9]]]


def test_edges(spark):
    v = [0.5, -0.25, 0.125, 1.0, -1.0, 0.0, 2.0, 3.0]
    rows = [(5, v, 1), (3, v, 1), (3, [-x for x in v], None), (None, v, None), (1, None, 1), (2, [1.0, None] * 4, 1), (4, [float("nan")] * 8, 1),
            (6, [float("inf")] * 8, 1), (7, [1.0] * 16, 2), (8, [], 2), (9, [1.0] * 7, 1), (10, [3e38] * 8, 3)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("error", F.lit("x")).withColumn("_q", F.lit("x"))
    got = codes.digest(codes.train_codes(df)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == [(False, 3), (False, 3), (False, 5), (False, 7), (False, 8), (False, 9), (False, 10), (True, 0)]
    by_id = {r.vec_id: r for r in got if r.vec_id != 3}
    assert all(by_id[i].code is None and by_id[i].error is None for i in (7, 8, 9)) and by_id[7].label_error is None
    # five entries: both rows of id 3 (by components), 5, 10, null; each its own or the first equal one
    assert by_id[5].error == 0 and by_id[10].error == 0 and by_id[9].label_error == 0
    assert len({r.code for r in got if r.code}) == 3 and by_id[5].code == by_id[None].code
    none = codes.train_codes(df.filter("vec_id in (1, 2, 8)"))
    assert [tuple(r) for r in none.rows.collect()] == [(8, 2, None, None)] and none.work == []
    assert codes.digest(codes.train_codes(df.filter("false"))).count() == 0
