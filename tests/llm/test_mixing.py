"""Mixing: targets, word totals, limits, reruns, edges."""
from llm import mixing

from corpus_cases import DOCS

SIZES = "doc_id long, source string, size long"


def brute_targets(sizes, limit=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = left / sum(w[s] for s in open_)
        over = {s for s in open_ if share * w[s] > limit * sizes[s]}
        if not over:
            return out | {s: share * w[s] for s in open_}
        for s in over:
            out[s] = float(limit * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def test_targets(spark):
    sizes = {"a": 100, "b": 5, "Z": 900, None: 2, "é": 0, "c": 10000, "d": 30}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_totals_and_reruns(spark):
    rows = [(i, "big" if i % 3 == 0 else f"s{i % 7}", 1 + (i * 7919) % 400) for i in range(3000)]
    rows += [(77, "rep", 10)] * 500 + [(None, "rep", 20)] * 100
    df = spark.createDataFrame(rows, SIZES)
    got = mixing.copies(df).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.source, r.size) for r in got) == sorted((d is None, d or 0, s, n) for d, s, n in rows)
    by = {}
    for r in got:
        assert 0 <= r.copies <= 3 and int(r.target / r.source_size) <= r.copies <= int(r.target / r.source_size) + 1
        by.setdefault(r.source, [r.target, 0])[1] += r.copies * r.size
    assert all(abs(t - k) <= 200 for t, k in by.values())
    again = mixing.copies(df.repartition(3)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.source, r.nth, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_rows_and_edges(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "x", 1), (1, "a b c", "en", "x", 1), (1, "d e f", "en", "x", 1), (None, None, None, None, None),
                                  (2, "", "en", "y", 0), (3, "w " * 50000, "de", "y", 1), (4, " \t", "en", None, 2)], DOCS)
    rows = mixing.mix(docs).collect()
    assert len(rows) == 7 and {r.size for r in rows if r.doc_id in (None, 2, 4)} == {0}
    assert all(r.taken == r.copies * r.size <= 3 * r.size for r in rows)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sum(len((r.text or "").split()) for r in got) == sum(r.taken for r in rows)
    assert sum(not (r.text or "").strip() for r in got) == 3
    assert mixing.mix(docs.filter("false")).count() == 0 and mixing.mixed_rows(docs.filter("false")).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b", "en", "x", 1)], DOCS)
    plan = mixing.mix(df)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
