"""Packing: ids by the tokenizer, every id once, no padding, the rule against plain sums of squares."""
import random
import zlib
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import numpy as np

from llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string"


def check(pieces, model, texts, window=2048):
    """Pieces tile their documents and their sequences, and nothing is padded."""
    docs, seqs = {}, {}
    for r in pieces:
        docs.setdefault(r.document, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    got = Counter()
    for rows in docs.values():
        rows.sort(key=lambda r: r.start)
        at, ids = 0, b""
        for r in rows:
            assert r.start == at and r.length > 0 and len(r.ids) == 4 * r.length
            at += r.length
            ids += bytes(r.ids)
        assert {r.doc_tokens for r in rows} == {at}
        got[(rows[0].doc_id, tuple(np.frombuffer(ids, "<u4").tolist()))] += 1
    assert got == Counter((i, (*model.encode(t or "", add_special_tokens=False).ids, 1)) for i, t in texts)
    for rows in seqs.values():
        rows.sort(key=lambda r: r.offset)
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
        assert at <= window and at & (at - 1) == 0


def test_documents(spark, small_docs):
    model = Tokenizer.from_file(PATH)
    rows = packing.pack(small_docs, PATH).collect()
    check(rows, model, [(r.doc_id, r.text) for r in small_docs.collect()])
    got = packing.digest(packing.pack(small_docs, PATH)).collect()
    assert sorted((r.document, r.start, r.ids_crc32) for r in got) == sorted((r.document, r.start, zlib.crc32(bytes(r.ids))) for r in rows)
    whole = packing.sequences(packing.pack(small_docs, PATH)).collect()
    assert sum(r.length for r in whole) == sum(r.length for r in rows)
    assert all(len(r.ids) == 4 * r.length == 4 * sum(p.length for p in r.pieces) for r in whole)
    again = packing.pack(small_docs, PATH).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_rule_against_plain_sums():
    rng = random.Random(3)
    window = 16
    packer, open_levels = packing.Packer(window, max_open=10**9), Counter()
    for n in range(2000):
        size = rng.choice([1, 3, 5, 6, 7, 8, 9, 11, 15]) if n % 3 else 7
        choices = []
        for level in [0, *open_levels]:
            if level + size <= window:
                after = open_levels.copy()
                if level:
                    after[level] -= 1
                if level + size < window:
                    after[level + size] += 1
                choices.append((sum(c * c for c in after.values()), -level))
        best = -min(choices)[1]
        assert packer.levels.best(size) == best
        list(packer.put(n, np.zeros(size, "<u4")))
        if best:
            open_levels[best] -= 1
        if best + size < window:
            open_levels[best + size] += 1
        open_levels = +open_levels
        assert {k: len(v) for k, v in packer.at.items()} == dict(open_levels)


def test_open_windows_are_bounded_and_completed():
    window, packer, out = 32, packing.Packer(32, max_open=8), []
    for n in range(500):  # nothing fits beside anything else
        out += packer.put(n, np.full(17 + n % 3, n, "<u4"))
        assert packer.held <= 8
    out += packer.end()
    sizes = [sum(len(p[2]) for p in w) for w in out]
    assert sum(sizes) == sum(17 + n % 3 for n in range(500)) and all(s & (s - 1) == 0 for s in sizes) and sizes.count(window) >= len(sizes) - 5
    pieces = sorted((p[0], p[1], len(p[2])) for w in out for p in w)
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(pieces, pieces[1:]))


def test_words_and_whole_texts_agree():
    tokens = packing.Tokens(PATH)
    assert tokens.by_word
    texts = ["a  b c\t d\n e", "it's  a 'test' don't  ", " x y", "é ü 12 3,4 . , !? a b   c", "\x1c a \x85 b", "<|endoftext|> a <|endoftext|>b c", "漢字 かな ab",
             "", " ", "\n \n a", "a\n\nb.\n\n c", "x  y", "é. a", "a ", "a  b", "x y　 z", "q" * 200 + " r", "\0 a \0b", "🙂 🙂🙂 a"]
    for _ in range(2):  # from the model, then from what is remembered
        got = [x.tolist() for x in tokens.ids(texts)]
        assert got == [tokens.model.encode(t, add_special_tokens=False).ids for t in texts]


def test_edges(spark):
    model = Tokenizer.from_file(PATH)
    texts = [(1, None), (1, ""), (None, "a b"), (1, "a b"), (1, "a b"), (2, "word " * 30000), (3, "x" * 20000), (4, "   ")]
    df = spark.createDataFrame(texts, DOCS).withColumn("sequence_id", F.lit("x")).withColumn("ids", F.lit(1))
    check(packing.pack(df, PATH).collect(), model, texts)
    check(packing.pack(df, PATH, window=64, max_open=2).collect(), model, texts, 64)
    assert packing.pack(df.filter("false"), PATH).count() == 0 and packing.sequences(packing.pack(df.filter("false"), PATH)).count() == 0
