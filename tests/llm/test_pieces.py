"""SentencePiece: sampling distribution, distinctness, inclusion, exact round trips, edges."""
import math
import random
from collections import Counter

import numpy as np
import pytest

from llm import pieces

VOCAB = pieces.Vocabulary(pieces.load_pieces(), 1.0)


def every(text):
    """Log probability of each segmentation, by enumeration."""
    out = {}

    def go(rest, acc, lw):
        if not rest:
            out[tuple(acc)] = lw
            return
        for j in range(1, min(16, len(rest)) + 1):
            s = rest[:j]
            if s in VOCAB.ids:
                go(rest[j:], acc + [VOCAB.ids[s]], lw + math.log(VOCAB.weight[s] / pieces.SCALE ** len(s)))
        if rest[0] not in VOCAB.ids:
            raw = rest[0].encode()
            go(rest[1:], acc + [VOCAB.byte_id[x] for x in raw], lw + len(raw) * math.log(VOCAB.byte_weight))

    go(" " + text, [], 0.0)
    z = np.logaddexp.reduce(list(out.values()))
    return {a: v - z for a, v in out.items()}


@pytest.mark.parametrize("text", ["the cat", "a\nb ☃x", "zu  fäx", "über"])
def test_samples_follow_the_lattice(text):
    want = every(text)
    n, k = 6000, 3
    lat = pieces.Lattices(VOCAB)
    got = pieces.sample_batch(lat, [text] * n, list(range(n)), k)
    for paths, logs, values, kappa in got:
        keys = [tuple(p.tolist()) for p in paths]
        assert len(set(keys)) == len(keys) == min(k, len(want))
        assert all(abs(want[a] - x) < 1e-9 for a, x in zip(keys, logs))
        assert all(a >= b for a, b in zip(values, values[1:])) and values[-1] >= kappa
    first, both = Counter(), Counter()
    for paths, *_ in got:
        a = tuple(paths[0].tolist())
        first[a] += 1
        if len(paths) > 1:
            both[a, tuple(paths[1].tolist())] += 1
    for a, x in want.items():
        p = math.exp(x)
        assert abs(first[a] / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 1e-3
        for b, y in want.items():
            if a != b and p < 1:
                q = p * math.exp(y) / (1 - p)
                assert abs(both[a, b] / n - q) < 4 * math.sqrt(q / n) + 1e-3


def test_inclusion_scores_weigh_up():
    """Sums of f / inclusion estimate sums over all segmentations."""
    want = every("the cat")
    n, k = 4000, 4
    total = 0.0
    for paths, logs, _, kappa in pieces.sample_batch(pieces.Lattices(VOCAB), ["the cat"] * n, list(range(n)), k):
        for p, x in zip(paths, logs):
            total += math.exp(x) * len(p) / -math.expm1(-math.exp(x - kappa))
    exact = sum(math.exp(x) * len(a) for a, x in want.items())
    assert abs(total / n - exact) < 0.05 * exact


def test_batches_and_long_chunks_agree():
    texts = ["the whole text of a longer row, with words " * 30, "x" * 700 + " é" * 200, "a  b   c \n\n", "日本語 text"]
    keys = [5, 6, 7, 8]
    one = [pieces.sample_batch(pieces.Lattices(VOCAB), [t], [k], 3)[0] for t, k in zip(texts, keys)]
    all_ = pieces.sample_batch(pieces.Lattices(VOCAB), texts, keys, 3)
    for a, b in zip(one, all_):
        assert [p.tolist() for p in a[0]] == [p.tolist() for p in b[0]] and np.allclose(a[2], b[2])


def test_round_trips_and_edges(spark):
    texts = [None, "", " ", "  lead and trail  ", "a▁b", "tab\tnew\nline\r\n", "\U0001f600 \U0001f468‍\U0001f469 ñ é́", "\x00\x01", "x" * 30000,
             "word " * 20000, "<s> </s> <0x0A> <unk>", "\n", "­​ "]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(None, "null key", "z"), (3, texts[3], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pieces string")
    out = pieces.decode(pieces.encode(df, k=3)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.decoded and all(t == (r.text or "") for t in r.decoded)
        assert len(r.pieces) == len(r.log_prob) == len(r.perturbed) == len(r.log_inclusion) <= 3
        assert len({tuple(p) for p in r.pieces}) == len(r.pieces) and all(-math.inf < x <= 0 for x in r.log_inclusion)
    assert [r.pieces for r in out if r.doc_id in (0, 1)] == [[[]], [[]]]
    same = [r.pieces for r in out if r.doc_id == 3]
    assert same[0] == same[1]
    assert pieces.encode(df.filter("false")).count() == 0


def test_all_documents(spark, small_docs):
    rows = pieces.decode(pieces.encode(small_docs, verify=True)).collect()
    assert len(rows) == small_docs.count() and all(t == r.text and r.decodes for r in rows for t in r.decoded)


def test_chunks_equal_the_pattern():
    rng = random.Random(5)
    texts = ["", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "\n a", "x\ty \n", "é▁ ü z"]
    texts += ["".join(rng.choice("ab \n\t▁") for _ in range(rng.randrange(30))) for _ in range(500)]
    for t in texts:
        assert pieces.chunks_of(t) == pieces.CHUNK.findall(" " + t), repr(t)


def test_chunk_lattices_do_not_depend_on_their_builder():
    """Side by side or one by one, after forgetting or not: the same edges."""
    v = VOCAB
    chunks = [" the", " internationalisation", "x", " " * 5, " Über", "  ab", " zzzzzzzzqqq"]

    def edges(lat, c):
        out, node = [], lat.known[c]
        for at in range(node, node + len(c) + 1):
            lo, n = int(lat.store["first"][at]), int(lat.store["count"][at])
            out.append([(int(lat.edge["end"][e]) - node, int(lat.edge["piece"][e]), round(float(lat.edge["p"][e]), 9)) for e in range(lo, lo + n)])
        return out

    many, each = pieces.Lattices(v), pieces.Lattices(v)
    many.add(["warm", " up"])
    many.clear()
    many._many(chunks)
    each._each(chunks)
    for c in chunks:
        assert edges(many, c) == edges(each, c)
        assert all(abs(sum(p for *_, p in e) - 1) < 1e-6 for e in edges(many, c) if e)
