"""Fits take in all labelled rows; the SVM over term blocks; what a smart-label merge moves."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.operators import models as J
from eventflow.operators import svm
from eventflow.operators.rowkey import with_row_number
from eventflow.plans import queries as Q
from eventflow.session import written_table

MANY = 200_600


def _many(spark):
    """More labelled rows than a fit once took in; their words by rule."""
    i = F.col("id")
    text = F.concat(F.lit("w"), (i % 2).cast("string"), F.when(i < 50, F.lit(" rare")).otherwise(F.lit(" often")))
    return spark.range(MANY).select("id", text.alias("title"), F.lit("").alias("description"), (i % 2).cast("int").alias("label"))


def _idf(n, df):
    return math.log((1 + n) / (1 + df)) + 1


def test_calibrated_fit_takes_all_rows(spark):
    model = J.fit_svm_prob(_many(spark), key="id", folds=2, max_iter=3)
    got = {r.term: r.idf for r in model.terms.collect()}
    assert abs(got["w0"] - _idf(MANY, MANY // 2)) < 1e-12 and abs(got["rare"] - _idf(MANY, 50)) < 1e-12  # before: counts of about 200,000 rows


@pytest.fixture(scope="module")
def many_documents(spark, tmp_path_factory):
    """260,000 labelled documents in ten even series: 208,000 of them train after a split by series."""
    out = str(tmp_path_factory.mktemp("many"))
    i = F.col("id")
    text = F.concat(F.lit("w"), (F.floor(i / 10) % 2).cast("string"), F.when(i < 5000, F.lit(" rare")).otherwise(F.lit(" often")))
    d = spark.range(260_000)
    d.select(i.alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), (i % 10).cast("string").alias("source"),
             F.lit(9).cast("long").alias("n_chars")).coalesce(1).write.parquet(out + "/documents.parquet")
    d.select(i.alias("doc_id"), (F.floor(i / 10) % 2).cast("int").alias("quality"), F.lit(0).alias("toxic")).coalesce(1).write.parquet(out + "/labels.parquet")
    return out


@pytest.mark.parametrize("query, apply, n", [("q_svm_train_eval", "predict", 208_000), ("q_smart_label", "smart_label", 260_000), ("q_tag", "tag", 260_000)])
def test_query_fits_on_all_rows(spark, monkeypatch, many_documents, query, apply, n):
    seen, real = [], getattr(J, apply)
    monkeypatch.setattr(J, apply, lambda df, model, *a, **b: seen.append(model) or real(df, model, *a, **b))
    getattr(Q, query)(spark, many_documents)
    got = {r.term: r.idf for r in seen[0].terms.collect()}  # before: counts of about 200,000 rows
    assert abs(got["w0"] - _idf(n, n // 2)) < 1e-12 and abs(got["rare"] - _idf(n, n * 5000 // 260_000)) < 1e-12


def test_balanced_fit_reaches_its_optimum_without_a_vector_per_term(spark, monkeypatch):
    monkeypatch.setattr(J, "LinearSVC", None)  # before: a solver with some thirty vectors of all terms on the driver
    words = [f"a{i % 7} b{i % 11} c{i % 13} {'good fine' if i % 3 else 'bad'} d{i * i % 17}" for i in range(60)]
    rows = [(f"t{i % 5}", w, f"2025-09-{1 + i % 28:02d} {i % 24:02d}:00:00", i % 3 == 0 or i % 10 == 0) for i, w in enumerate(words)]
    d = spark.createDataFrame(rows, "title string, description string, start string, label boolean").withColumn("label", F.col("label").cast("int"))
    model = J.fit_svm_balanced(d, tol=1e-5)
    assert model.fit["converged"] and model.fit["gap"] <= 1e-3 and model.numeric["hour"][1] != 0 and model.numeric["venue_park"][1] == 0
    scored = J.predict(d, model).select("label", "score").toPandas()  # the objective by the scores of the model as it is applied
    y = np.where(scored.label > 0, 1, -1)
    cost = 60 / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    square = model.terms.agg(F.sum(F.col("coef") * F.col("coef"))).first()[0] + sum(w * w for _, w in model.numeric.values())
    assert abs((square / 2 + (cost * np.maximum(0, 1 - y * scored.score)).sum()) / 60 - model.fit["objective"][-1]) < 1e-9


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_term_blocks_give_the_products_of_the_vectors(spark, monkeypatch, limit):
    monkeypatch.setattr(svm, "SUM_BYTES", limit)
    monkeypatch.setattr(svm, "PIECE", 3)
    monkeypatch.setattr(svm, "ROW_COUNTS", 4)
    texts = [f"aa b{i % 3} c{i % 4} " + "dd " * (300 * (i == 5) + i % 2) for i in range(10)] + [""]
    d = spark.createDataFrame([(t, "", i % 2) for i, t in enumerate(texts)], "title string, description string, label int")
    spec = J.FeatureSpec(kind="trainer", max_df=0.95)
    rows = with_row_number(written_table(spec.prepare(d).select("label", "_text")))
    blocks = svm.term_blocks(rows, "_rid", "_text", 11, 1000, True, 2, 0.95)
    want = J.training_set(spec.prepare(d), spec, "label")
    x = np.array([r.features.toArray()[:want.n_terms] for r in want.vectors.collect()])
    assert blocks.n_terms == want.n_terms
    norms = blocks.norms()
    got = np.array([blocks.products(v / norms) / norms for v in np.eye(11)])
    gram = x @ x.T
    assert np.allclose(np.sort(got.ravel()), np.sort(gram.ravel())) and np.allclose(np.sort(got.sum(0)), np.sort(gram.sum(0)))
    idf = {r.term: r.idf for r in blocks.coefficients(np.ones(11)).collect()}
    assert idf.keys() == {r.term for r in want.vocabulary.collect()} and all(abs(idf[r.term] - r.idf) < 1e-12 for r in want.vocabulary.collect())


def test_labels_other_than_two_are_refused(spark):
    d = spark.createDataFrame([("aa bb", 2), ("aa bb", 0)], "title string, label int")
    with pytest.raises(ValueError, match="1 of them labelled"):
        J.fit_svm_balanced(d)


def test_smart_label_merge_moves_no_texts(spark):
    out = Q.q_smart_label_given(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    merge = next(line for line in plan.splitlines() if "min_by" in line)
    assert "description" not in merge and "title" not in merge  # before: every column of the documents
