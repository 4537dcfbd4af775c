"""Splits, features and models (I, J) by properties and metric bounds."""
import math

from pyspark.sql import functions as F

from eventflow.operators import features as I
from eventflow.operators import models as J
from eventflow.operators import report as R

SF = "/root/testdata/sf0.001"


def test_group_split_keeps_series_whole(spark):
    df = spark.range(0, 300).select(F.col("id"), (F.col("id") % 37).cast("string").alias("series_id"))
    s = J.group_split(df, "series_id", test_size=0.2)
    sides = s.groupBy("series_id").agg(F.count_distinct("split").alias("k"))
    assert sides.where("k > 1").count() == 0
    assert s.where("split = 'test'").select("series_id").distinct().count() == math.ceil(0.2 * 37)


def test_stratified_split_sizes(spark):
    df = spark.range(0, 103).select(F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    s = J.stratified_split(df, "label", key="id")
    got = {(r.label, r.split): r["count"] for r in s.groupBy("label", "split").count().collect()}
    assert got[(1, "test")] == math.ceil(0.2 * 26) and got[(0, "test")] == math.ceil(0.2 * 77)
    small = J.stratified_split(df.limit(10), "label", key="id")
    assert {r.split for r in small.collect()} == {"both"}


def test_tfidf_rows_are_unit_norm(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "the dog sat"), (3, "")], "doc_id int, text string")
    w = I.tfidf_topk(docs, "doc_id", "text", k=5)
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-9 for r in norms)
    vocab = {r.term for r in w.select("term").distinct().collect()}
    assert vocab == {"the", "sat", "cat", "cat sat", "dog"}   # cf 3, 2, then alphabetical ties
    the = w.where("doc_id = 1 and term = 'the'").first()
    assert the.tf == 2 and abs(the.idf - (math.log(4 / 3) + 1)) < 1e-12


def test_scale_no_mean(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = I.scale_no_mean(df, ["a", "b"]).collect()
    assert [r.a_scaled for r in out] == [1.0, 3.0] and [r.b_scaled for r in out] == [5.0, 5.0]


def _docs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return d.join(lab, "doc_id", "left").select(
        "doc_id", F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("description"),
        F.col("lang").alias("location"), F.col("source").alias("category"), "label")


def test_train_predict_save_load(spark, tmp_dir):
    d = _docs(spark)
    lab = d.where(F.col("label").isNotNull())
    model = J.fit_svm_balanced(lab)
    assert model.fit["converged"] and model.fit["iterations"] < J.MAX_ITER
    assert model.fit["objective"][-1] <= min(model.fit["objective"]) + 1e-3
    scored = J.predict(lab, model, out="prediction")
    acc = R.accuracy(scored).first().accuracy
    assert acc > 0.8                         # training accuracy, a smoke bound
    model.columns = {"title": "title"}
    model.save(tmp_dir + "/m")
    again = J.TextModel.load(spark, tmp_dir + "/m", defaults={"loc": "location"})
    a = [r.score for r in J.predict(lab, model).orderBy("doc_id").collect()]
    b = [r.score for r in J.predict(lab, again).orderBy("doc_id").collect()]
    assert a == b and again.columns == {"loc": "location", "title": "title"}
    tagged = J.smart_label(d.drop("label"), model, auto=True)
    r = tagged.where("needs_review").select("label").distinct().collect()
    assert all(x.label is None for x in r)


def test_calibrated_classify(spark):
    d = _docs(spark)
    model = J.fit_svm_prob(d.where(F.col("label").isNotNull()), key="doc_id")
    a, _ = model.platt
    assert a > 0                              # larger margins mean more confidence in class 1
    out = J.classify(d.drop("label"), model)
    lo, hi = out.agg(F.min("confidence"), F.max("confidence")).first()
    assert 0.5 <= lo <= hi <= 1.0
    assert out.count() == d.count()


def test_time_features_edges(spark):
    rows = [("2025-09-06 10:00:00",),      # Saturday
            ("2025-09-07",),               # Sunday, date only -> midnight UTC
            ("2025-09-08T01:30:00+05:00",),  # Monday 01:30 local = Sunday 20:30 UTC
            ("garbage",), (None,)]
    df = spark.createDataFrame(rows, "start string")
    got = [(r.hour, r.is_weekend) for r in I.time_features(df).collect()]
    assert got == [(10, 1), (0, 1), (20, 1), (-1, 0), (-1, 0)]


def test_margin_threshold_edges(spark):
    from eventflow.operators import rules as D
    df = spark.createDataFrame([(0.0,), (0.8,), (-0.9,)], "score double").select(
        "score", J.margin_confidence_expr(F.col("score")).alias("confidence"),
        (F.col("score") > 0).cast("int").alias("predicted_label"))
    out = D.auto_accept(D.needs_review_margin(df)).collect()
    assert [round(r.confidence, 4) for r in out] == [1.0, 0.5556, 0.5263]
    assert [r.needs_review for r in out] == [False, False, True]
    assert [r.label for r in out] == [0, 1, None]
    dist = df.select(J.margin_confidence_expr(F.col("score"), mode="distance").alias("d")).collect()
    assert round(dist[0].d, 4) == 0.0


def test_platt_smoothed_targets(spark):
    # separable margins: hard labels would push the slope to infinity; Platt's
    # smoothed targets keep it finite and positive
    df = spark.createDataFrame([(float(s), 1.0 if s > 0 else 0.0) for s in (-3, -2, -1, 1, 2, 3)],
                               "_s double, label double")
    a, b = J.platt_fit(df)
    assert 0 < a < 20 and abs(b) < 1e-3 + abs(a)


def test_calibration_in_spark_and_on_the_driver_agree(spark):
    rows = spark.range(0, 3000).select(((F.xxhash64("id") % 1000) / 250.0).alias("_s"),
                                       (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) < 40 + 10 * F.signum(F.xxhash64("id") % 1000)).cast("int").alias("label"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1), (1.0, None)], "_s double, label int"))
    one, many = J.platt_newton(rows), J.platt_newton(rows, limit=10)
    assert one["converged"] and many["converged"] and one["steps"] == many["steps"]
    assert abs(one["a"] - many["a"]) < 1e-9 and abs(one["b"] - many["b"]) < 1e-9
    for da, db in ((0.01, 0), (-0.01, 0), (0, 0.01), (0, -0.01)):  # no neighbour is better
        held = rows.where("_s is not null and label is not null").toPandas()
        pos, neg = (held.label == 1).to_numpy(float), (held.label == 0).to_numpy(float)
        hi, lo = (pos.sum() + 1) / (pos.sum() + 2), 1 / (neg.sum() + 2)
        at = lambda a, b: J._platt_loss(held._s.to_numpy(), pos, neg, hi, lo, a, b)[0]  # noqa: B023, E731
        assert at(one["a"], one["b"]) < at(one["a"] + da, one["b"] + db)
    assert J.platt_newton(rows.limit(0))["converged"]


def test_large_coefficient_table_is_joined_by_term(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a{i % 7} b{i % 3} hot word") for i in range(200)], "id long, text string")
    terms = I.corpus_counts(I.by_term(I.term_counts(docs, "id", "text"), "id"), "id").select(
        "term", F.lit(1.5).alias("idf"), (F.length("term") - 5.0).alias("coef"))
    n = terms.count()
    small = {r.id: r.text_score for r in I.linear_scores(docs, "id", "text", terms, n).collect()}
    monkeypatch.setattr(I, "BROADCAST_TERMS", 0)
    plan = I.linear_scores(docs, "id", "text", terms, n)
    assert {r.id: round(r.text_score, 9) for r in plan.collect()} == {i: round(s, 9) for i, s in small.items()}


def test_trainer_uses_sublinear_counts(spark):
    rows = [("one one one one two", "", 1), ("one two", "", 0), ("two three", "", 1), ("three", "", 0)]
    d = spark.createDataFrame(rows, "title string, description string, label int")
    spec = J.FeatureSpec(kind="trainer", min_df=2, max_df=1.0)
    got = J.training_set(spec.prepare(d), spec, "label")
    names = {r.idx: r.term for r in got.vocabulary.collect()}
    idf = {r.term: r.idf for r in got.vocabulary.collect()}
    assert set(names.values()) == {"one", "two", "three", "one two"}
    want = {"one": (1 + math.log(4)) * idf["one"], "two": idf["two"], "one two": idf["one two"]}
    norm = math.sqrt(sum(w * w for w in want.values()))
    vectors = [{names[i]: v for i, v in zip(r.features.indices, r.features.values) if i in names} for r in got.vectors.collect()]
    assert any(set(v) == set(want) and all(abs(v[t] - w / norm) < 1e-12 for t, w in want.items()) for v in vectors)
