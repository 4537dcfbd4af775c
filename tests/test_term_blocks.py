"""Term counts in blocks, and the size of what TF-IDF and training vectors move or work out."""
import math
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventflow.operators import features as I
from eventflow.operators import models as J

TEXTS = [(1, "Ab cd ab cd x ab"), (2, ""), (3, None), (4, "zz"), (4, "zz zz ab"), (None, "ab zz"), (5, "été été ab cd")]


def _terms(text):
    words = [w for w in (text or "").lower().split() if len(w) > 1]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


@pytest.mark.parametrize("words", [1, 3, 1000])
def test_counts_do_not_depend_on_the_blocks(spark, monkeypatch, words):
    monkeypatch.setattr(I, "BLOCK_WORDS", words)
    monkeypatch.setattr(I, "CHUNK", 2)
    texts = [(k, t) for k, t in TEXTS if k != 5]
    df = spark.createDataFrame(texts, "id long, text string")
    want = Counter((k, t, n) for k, s in texts for t, n in _terms(s).items())
    assert Counter(tuple(r) for r in I.term_counts(df, "id", "text").select("id", "term", "tf").collect()) == want
    found = I.term_counts(df, "id", "text", only=["ab", "zz zz", "no", "no ab"]).select("id", "term", "tf")
    assert Counter(tuple(r) for r in found.collect()) == Counter({x: n for x, n in want.items() if x[1] in ("ab", "zz zz")})
    df_, cf = Counter(), Counter()
    for k, s in texts:
        for t, n in _terms(s).items():
            df_[t] += k is not None
            cf[t] += n
    got = {r.term: (r.df, r.cf) for r in I.corpus_terms(df, "id", "text").collect()}
    assert got == {t: (df_[t], cf[t]) for t in cf}


@pytest.mark.parametrize("most", [0, 1 << 22])
def test_pruned_weights_move_only_by_term(spark, monkeypatch, most):
    monkeypatch.setattr(I, "BROADCAST_DOCS", most)
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    w = I.tfidf_pruned(df, "doc_id", "text", min_df=2, max_df=0.9)
    assert "windowspecdefinition(doc_id" not in w._jdf.queryExecution().toString()  # before: every weight went to its document
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert {r.doc_id for r in norms} == {None, 1, 4, 5} and all(abs(r.n - 1) < 1e-9 for r in norms)
    got = w.where("term = 'ab' and doc_id = 1").first()
    assert got.tf == 3 and abs(got.idf - (math.log(8 / 4) + 1)) < 1e-12


def test_row_numbers_are_dense_and_stable(spark, tmp_dir):
    from eventflow.operators.rowkey import with_row_number
    spark.range(100).repartition(3).write.parquet(tmp_dir + "/t")
    df = with_row_number(spark.read.parquet(tmp_dir + "/t"))
    a, b = ({r.id: r._rid for r in x.collect()} for x in (df, df.repartition(7)))
    assert a == b and sorted(a.values()) == list(range(100))
    assert with_row_number(df.limit(0).drop("_rid")).count() == 0


def test_vector_of_a_long_text_takes_time_in_proportion(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    d = spark.createDataFrame([(long, "", 1), (long, "", 0), ("w1", "", 1)], "title string, description string, label int")
    spec = J.FeatureSpec(kind="trainer", min_df=2, max_df=1.0)
    since = time.monotonic()
    got = J.training_set(spec.prepare(d), spec, "label")
    assert got.n_terms == 79_999 and got.vectors.count() == 3
    assert time.monotonic() - since < 60  # before, the norm was worked out for every one of the terms
