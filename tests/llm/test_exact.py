"""Exact dedup: tries, spilling, ties, nulls, empty tables, clashing columns."""
import random

from llm import exact

from corpus_cases import DOCS


def test_trie_holds_every_key_once():
    rng = random.Random(1)
    keys = {bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(400)}
    root = exact.Node(b"")
    for k in [*keys, *keys]:
        node = exact.insert(root, k)
        node.owner = (node.owner or 0) + 1
    assert dict(exact.terminals(root)) == {k: 2 for k in keys}
    cut = exact.largest(root, 10**9)
    got = [k for p, b in cut for k, _ in exact.terminals(b, p)] + [k for k, _ in exact.terminals(root)]
    assert sorted(got) == sorted(keys)


def brute(rows):
    by = {}
    for pos, (doc, text) in enumerate(rows):
        body = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        by.setdefault(body, []).append((-len(text or ""), doc is None, doc if doc is not None else 0, pos, doc))
    return sorted((doc, min(v)[4], len(v), pos == min(v)[3]) for v in by.values() for *_, pos, doc in v if doc is not None)


def test_against_brute_force(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "a b"), (4, None), (5, ""), (6, " \t"), (7, "x" * 300000), (8, "x " * 300000),
            (9, "A b"), (10, "a  b"), (11, "a  b"), (12, "ab　"), (13, "\U0001f600 é"), (14, "\U0001f600é ")]
    df = spark.createDataFrame([(i, t, "en", None, 1) for i, t in rows], DOCS).repartition(3)
    for limit in (exact.MAX_BYTES, 500):
        got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_classes(df, max_bytes=limit).collect())
        assert got == brute(rows)


def test_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact.exact_classes(empty).count() == 0
    df = spark.createDataFrame([(1, "a", 7), (1, "a", 8), (None, "a", 9), (None, None, 1)], "doc_id long, text string, keep_id long")
    rows = exact.exact_classes(df).collect()
    assert len(rows) == 4 and sum(r.kept for r in rows) == 2
    assert {r.keep_id for r in rows if r.group_size == 3} == {1}
    assert exact.exact_dedup(df).count() == 2
