"""Models, splits and scoring.

A fit takes in all labelled rows. Their vocabulary never reaches the driver. With
a few hundred terms, vectors are built by joining the rows' term counts with it
and Spark ML's ``LinearSVC`` gives one coefficient per number; with a whole
vocabulary the solver works on one number per row (``svm``). The model is the
table (term, idf, coef) with a few numbers beside it. Scoring joins the term
counts of any number of rows with that table and adds up. Splits are by hash and exact in size, from a histogram
of the hashes.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import four_field_text, title_desc_text
from ..session import written_table
from .features import (NUMERIC_FEATURES, corpus_terms, linear_scores, most_frequent, prepared_text, pruned, smooth_idf,
                       term_counts, time_features, with_venue_flags)
from .numbering import hash_cut, seeded_hash
from .rowkey import with_row_id, with_row_number
from .svm import solve, term_blocks

#: Vectors that a task of the solver holds, about.
ROWS_PER_TASK = 2_000
#: Distinct margins that calibration takes to the driver as one table of counts; more are summed step by step.
MARGINS = 1 << 20
#: Solver iterations at most; a fit stops earlier once it has converged.
MAX_ITER = 1000
REVIEW_PROB = 0.75
REVIEW_MARGIN = 0.55


# --------------------------------------------------------------------- scoring helpers
def margin_confidence_expr(score, mode: str = "inverse"):
    """``1/(1+|score|)``; ``mode="distance"`` gives ``1 -`` that (Δ2)."""
    c = F.lit(1.0) / (F.lit(1.0) + F.abs(score))
    return c if mode == "inverse" else F.lit(1.0) - c


def calibrated_expr(score, a: float, b: float):
    """Probability of the predicted class from a Platt fit ``p = 1/(1+exp(-(a*s+b)))``."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * score + F.lit(b))))
    return F.greatest(p, F.lit(1.0) - p)


# --------------------------------------------------------------------- splits
def group_split(df: DataFrame, series: str = "series_id", test_size: float = 0.2, seed: str = "42",
                out: str = "split") -> DataFrame:
    """Whole series on one side; exactly ``ceil(test_size * n)`` series,
    chosen by hash order, are held out. Rows without a series train."""
    hashed = df.withColumn("_h", F.when(F.col(series).isNotNull(), seeded_hash(F.col(series), seed, [series])))
    distinct = hashed.select("_h").where(F.col("_h").isNotNull()).distinct()
    return (hashed.withColumn(out, F.when(hash_cut(distinct, "_h", test_size), F.lit("test")).otherwise(F.lit("train")))
            .drop("_h"))


def stratified_split(df: DataFrame, label: str = "label", key: str = "id", test_size: float = 0.2,
                     seed: str = "42", min_rows: int = 20, out: str = "split") -> DataFrame:
    """Per class ``ceil(test_size * n_class)`` rows by hash order go to
    test; with fewer than ``min_rows`` labelled rows train = test = all
    (``split = 'both'``). Rows of one key stay together, so a class may exceed
    its share by the copies of one key; rows with a null key spread by their
    own hash."""
    lab = df.where(F.col(label).isNotNull())
    hashed = lab.withColumn("_h", seeded_hash(F.col(key), seed, lab.columns))
    total = lab.agg(F.count(F.lit(1))).scalar()
    test = hash_cut(hashed, "_h", test_size, label)
    return (hashed.withColumn(out, F.when(total < min_rows, F.lit("both"))
                              .when(test, F.lit("test")).otherwise(F.lit("train"))).drop("_h"))


# --------------------------------------------------------------------- features
@dataclass
class FeatureSpec:
    """How rows become model inputs (the reference has two variants)."""
    kind: str = "trainer"            # "trainer": title+desc, accents folded, + 6 numeric
    title: str = "title"             # "four_field": title/desc/location/category text
    desc: str = "description"
    start: str = "start"
    loc: str = "location"
    category: str = "category"
    vocab: str = "pruned"            # "pruned" (min_df/max_df) or "topk"
    k: int = 500
    min_df: int = 2
    max_df: float = 0.9
    # term counts as 1+ln(tf) (the trainer's variant) or as they are
    sublinear: bool | None = None

    def __post_init__(self):
        if self.sublinear is None:
            self.sublinear = self.kind == "trainer"

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add ``_text`` (and numeric features) with DataFrame expressions."""
        for c in (self.title, self.desc, self.start, self.loc, self.category):
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
        if self.kind == "trainer":
            df = df.withColumn("_text", prepared_text(title_desc_text(self.title, self.desc), fold_accents=True))
            df = with_venue_flags(time_features(df, self.start), self.loc)
        else:
            cat = F.col(self.category)
            if dict(df.dtypes)[self.category].startswith("array"):
                cat = F.array_join(cat, ";")
            df = df.withColumn("_text", prepared_text(four_field_text(self.title, self.desc, self.loc, cat)))
        return df

    @property
    def numeric(self) -> list:
        return NUMERIC_FEATURES if self.kind == "trainer" else []


@dataclass
class TextModel:
    """A linear model over TF-IDF and numeric features, with the column mapping
    and calibration: the table ``terms`` (term, idf, coef) of ``n_terms`` rows,
    and per numeric feature its scale and coefficient."""
    spec: FeatureSpec
    terms: DataFrame
    n_terms: int
    numeric: dict = field(default_factory=dict)
    intercept: float = 0.0
    columns: dict = field(default_factory=dict)
    platt: tuple | None = None
    fit: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus its features, the margin ``score`` and the 0/1 ``prediction``."""
        rows = self.spec.prepare(with_row_number(df))
        text = linear_scores(rows, "_rid", "_text", self.terms, self.n_terms, self.spec.sublinear)
        score = F.coalesce(F.col("text_score"), F.lit(0.0)) + F.lit(self.intercept)
        for name, (scale, coef) in self.numeric.items():
            score = score + F.col(name).cast("double") * F.lit(scale) * F.lit(coef)
        return (rows.drop("_text").join(text, "_rid", "left").withColumn("score", score)
                .withColumn("prediction", (F.col("score") > 0).cast("double")).drop("_rid", "text_score"))

    def save(self, path: str) -> None:
        """The coefficient table and one row of JSON beside it."""
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        meta = {"spec": self.spec.__dict__, "columns": self.columns, "platt": list(self.platt or []), "n_terms": self.n_terms,
                "numeric": self.numeric, "intercept": self.intercept, "fit": self.fit}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark, path: str, defaults: dict | None = None) -> "TextModel":
        """Load; missing mapping entries fall back to default names."""
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        cols = dict(defaults or {})
        cols.update(meta.get("columns") or {})
        meta["spec"].pop("max_train_rows", None)  # in models saved when fits were bounded
        return TextModel(FeatureSpec(**meta["spec"]), spark.read.parquet(f"{path}/terms"), meta["n_terms"],
                         {k: tuple(v) for k, v in meta["numeric"].items()}, meta["intercept"], cols,
                         tuple(meta["platt"]) if meta.get("platt") else None, meta.get("fit") or {})


def numbered(df: DataFrame, out: str = "idx") -> DataFrame:
    """A written table's rows numbered from 0 by file and place in the file; only
    the files' row counts are collected."""
    rows = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    sizes = sorted(tuple(r) for r in rows.groupBy("_file").agg(F.max("_at") + 1).collect())
    starts, total = [], 0
    for name, n in sizes:
        starts.append((name, total))
        total += n
    first = df.sparkSession.createDataFrame(starts, "_file string, _first long")  # one row per file
    return rows.join(F.broadcast(first), "_file").withColumn(out, (F.col("_first") + F.col("_at")).cast("int")).drop("_file", "_at", "_first")


@dataclass
class TrainingSet:
    """Written vectors (label, features, and _fold if given), and what belongs to their numbers."""
    vectors: DataFrame
    vocabulary: DataFrame
    n_terms: int
    scales: dict

    def model(self, svc, spec: FeatureSpec, **more) -> TextModel:
        """The fitted coefficients back with their terms."""
        w = svc.coefficients.toArray()
        coef = self.vocabulary.sparkSession.createDataFrame(
            pd.DataFrame({"idx": range(self.n_terms), "coef": w[: self.n_terms]}), "idx int, coef double")
        terms = written_table(self.vocabulary.join(coef, "idx").select("term", "idf", "coef"))
        numeric = {c: (scale, float(w[self.n_terms + i])) for i, (c, scale) in enumerate(self.scales.items())}
        return TextModel(spec, terms, self.n_terms, numeric, float(svc.intercept), **more)


def training_set(prepared: DataFrame, spec: FeatureSpec, label: str) -> TrainingSet:
    """Vocabulary (I4 or I5) and sparse vectors (I7: L2-normalised TF-IDF, then
    scaled numeric features) of prepared labelled rows."""
    more = [c for c in ("_fold",) if c in prepared.columns]
    rows = with_row_id(written_table(prepared.select(F.col(label).cast("double").alias("label"), "_text", *spec.numeric, *more)))
    n = rows.count()
    if spec.vocab == "topk":  # of the texts' counts only the k terms' are made
        vocab = most_frequent(corpus_terms(rows, "_rid", "_text"), spec.k).collect()
        counts = term_counts(rows, "_rid", "_text", only=[r.term for r in vocab])
        vocab = rows.sparkSession.createDataFrame(vocab, "term string, df long, cf long")
    else:
        counts = written_table(term_counts(rows, "_rid", "_text"))
        vocab = pruned(counts.groupBy("term").agg(F.count("_rid").alias("df")), F.lit(n), spec.min_df, spec.max_df)
    vocab = numbered(written_table(vocab.select("term", smooth_idf(F.lit(float(n))).alias("idf"))))
    n_terms = vocab.count()
    tf = F.lit(1.0) + F.log(F.col("tf").cast("double")) if spec.sublinear else F.col("tf").cast("double")
    weights = counts.join(vocab, "term").select("_rid", F.struct("idx", (tf * F.col("idf")).alias("w")).alias("e"))
    # the norm comes from the aggregate: taken from the array, it would be worked out anew for every element
    text = weights.groupBy("_rid").agg(F.sort_array(F.collect_list("e")).alias("e"),  # one text's terms
                                       F.sqrt(F.sum(F.col("e.w") * F.col("e.w"))).alias("norm"))
    text = text.select("_rid", F.transform("e", lambda x: x["idx"]).alias("at"), F.transform("e", lambda x: x["w"] / F.col("norm")).alias("w"))
    scales = {}
    if spec.numeric:
        sd = rows.agg(*[F.stddev_pop(c).alias(c) for c in spec.numeric]).first()
        scales = {c: 1.0 / (sd[c] if sd[c] else 1.0) for c in spec.numeric}
    at = F.array(*[F.lit(n_terms + i) for i in range(len(scales))]).cast("array<int>")
    w = F.array(*[F.col(c).cast("double") * F.lit(s) for c, s in scales.items()]).cast("array<double>")
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(n_terms + len(scales)).alias("size"),
                      F.concat(F.coalesce("at", F.array().cast("array<int>")), at).alias("indices"),
                      F.concat(F.coalesce("w", F.array().cast("array<double>")), w).alias("values"))
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())]
                          + [rows.schema[c] for c in more])
    # solvers run one job per iteration over these rows: one even deal, tasks of a few thousand
    parts = max(1, min(math.ceil(n / ROWS_PER_TASK), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    made = rows.join(text, "_rid", "left").select("label", vector.alias("features"), *more).repartition(parts)
    return TrainingSet(written_table(made, schema), vocab, n_terms, scales)


def _svc(train: DataFrame, balanced: bool, max_iter: int = MAX_ITER, tol: float = 1e-6):
    """LinearSVC with the reference's objective: C=1 -> regParam = 1/n,
    no standardisation; balanced class weights n/(k*n_class)."""
    counts = {r[0]: r[1] for r in train.groupBy("label").count().collect()}  # one row per class
    n = sum(counts.values())
    svc = LinearSVC(featuresCol="features", labelCol="label", regParam=1.0 / max(n, 1),
                    standardization=False, maxIter=max_iter, tol=tol)
    if balanced:
        w = F.lit(0.0)
        for c, nc in counts.items():
            w = F.when(F.col("label") == c, F.lit(n / (len(counts) * nc))).otherwise(w)
        train = train.withColumn("_w", w)
        svc.setWeightCol("_w")
    return svc.fit(train)


# Solver tolerances of the reference's estimators: libsvm SVC 1e-3, liblinear LinearSVC 1e-4.
TOL_SVC = 1e-3
TOL_LINEAR = 1e-4


def _fit_report(svc, max_iter: int) -> dict:
    """Iterations used, the objective after each, and whether the solver stopped by itself."""
    s = svc.summary()
    return {"iterations": s.totalIterations, "objective": [float(x) for x in s.objectiveHistory], "converged": s.totalIterations < max_iter}


def fit_svm_balanced(df: DataFrame, spec: FeatureSpec | None = None, label: str = "label", max_iter: int = MAX_ITER,
                     tol: float = TOL_LINEAR) -> TextModel:
    """Linear SVM (C=1) on title+description TF-IDF (pruned, accents folded,
    sublinear tf) and six scaled numeric features, class weights n/(2*n_class),
    fitted on all rows (``svm.solve``): the driver holds some numbers a row, none
    a term. ``fit`` of the result tells whether the solver converged, and its gap."""
    spec = spec or FeatureSpec(kind="trainer", vocab="pruned")
    prepared = spec.prepare(df).select(F.col(label).cast("double").alias("label"), "_text", *spec.numeric)
    rows = with_row_number(written_table(prepared))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("_text")).alias("chars"), F.count_if(F.coalesce(F.col("label").isin(0.0, 1.0), F.lit(False))).alias("known"),
                     *[F.stddev_pop(c).alias(c) for c in spec.numeric]).first()
    n = facts["n"]
    if not n or facts["known"] < n:
        raise ValueError(f"{n} rows to fit on, {facts['known']} of them labelled 0 or 1")
    if spec.vocab == "topk":
        only = [r.term for r in most_frequent(corpus_terms(rows, "_rid", "_text"), spec.k).collect()]  # k rows
        blocks = term_blocks(rows, "_rid", "_text", n, facts["chars"], spec.sublinear, only=only)
    else:
        blocks = term_blocks(rows, "_rid", "_text", n, facts["chars"], spec.sublinear, spec.min_df, spec.max_df)
    held = rows.select("_rid", "label", *spec.numeric).toPandas().sort_values("_rid")  # a few numbers a row
    y = np.where(held["label"].to_numpy() > 0, 1.0, -1.0)
    sd = [facts[c] for c in spec.numeric]
    numbers = held[spec.numeric].to_numpy(np.float32)
    numbers[:, [not s for s in sd]] = 0.0  # a constant takes no coefficient
    scales = np.array([1.0 / s if s else 1.0 for s in sd])
    del held
    norms = blocks.norms()

    def products(v):
        return blocks.products(v / norms) / norms + numbers @ (scales * scales * (numbers.T @ v))

    sizes = np.bincount((y > 0).astype(int), minlength=2)
    cost = n / (np.count_nonzero(sizes) * sizes[(y > 0).astype(int)])
    found = solve(products, y, cost, max_iter, tol)
    beta, intercept = found.pop("beta"), found.pop("intercept")
    coef = scales * (numbers.T @ beta)
    return TextModel(spec, blocks.coefficients(beta / norms), blocks.n_terms, {c: (float(s), float(w)) for c, s, w in zip(spec.numeric, scales, coef)},
                     intercept, fit=found)


def _platt_loss(s, pos, neg, hi, lo, a, b):
    """Loss, gradient and second derivatives at (a, b) of margins with their counts of either label."""
    z = a * s + b
    p = 1.0 / (1.0 + np.exp(-z))
    n, t = pos + neg, pos * hi + neg * lo
    soft = np.maximum(z, 0.0) + np.log1p(np.exp(-np.abs(z)))  # ln(1 + e^z)
    g, q = n * p - t, n * p * (1.0 - p)
    return tuple(float(x.sum()) for x in (n * soft - t * z, g * s, g, q * s * s, q * s, q))


def platt_newton(margins: DataFrame, score: str = "_s", label: str = "label", max_iter: int = 100,
                 tol: float = 1e-9, limit: int = MARGINS) -> dict:
    """Platt scaling with Platt's smoothed targets (positives aim at
    (N+ + 1)/(N+ + 2), negatives at 1/(N- + 2)) by Newton's method with step
    halving. The margins are first counted by value and label; up to ``limit``
    distinct ones are all that the fit needs and come to the driver as one table,
    more stay in Spark and every step is one aggregate of six sums. Returns
    a and b of ``p = 1/(1+exp(-(a*s+b)))``, the steps taken, the loss and
    whether it converged (largest gradient component, per margin, near ``tol``)."""
    y = F.col(label).cast("double")
    counts = written_table(margins.where(y.isin(0.0, 1.0) & F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("s"))
                           .agg(F.count_if(y == 1.0).alias("pos"), F.count_if(y == 0.0).alias("neg")))
    distinct, pos, neg = counts.agg(F.count(F.lit(1)), F.sum("pos"), F.sum("neg")).first()
    pos, neg = pos or 0, neg or 0
    hi, lo = (pos + 1.0) / (pos + 2.0), 1.0 / (neg + 2.0)
    if distinct <= limit:
        held = counts.toPandas()
        s, p1, p0 = (held[c].to_numpy(dtype=float) for c in ("s", "pos", "neg"))

        def sums(a, b):
            return _platt_loss(s, p1, p0, hi, lo, a, b)
    else:
        n, t = F.col("pos") + F.col("neg"), F.col("pos") * F.lit(hi) + F.col("neg") * F.lit(lo)

        def sums(a, b):
            z = F.lit(a) * F.col("s") + F.lit(b)
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
            soft = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
            g, q = n * p - t, n * p * (F.lit(1.0) - p)
            return tuple(counts.agg(*[F.sum(x) for x in (n * soft - t * z, g * F.col("s"), g, q * F.col("s") * F.col("s"), q * F.col("s"), q)]).first())

    a, b, total = 0.0, math.log((pos + 1.0) / (neg + 1.0)), pos + neg
    if not total:
        return {"a": a, "b": b, "steps": 0, "loss": 0.0, "converged": True}
    loss, ga, gb, haa, hab, hbb = sums(a, b)
    steps = 0
    while max(abs(ga), abs(gb)) > tol * total and steps < max_iter:
        haa, hbb = haa + 1e-12, hbb + 1e-12
        det = haa * hbb - hab * hab
        da, db = -(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det
        slope, size = ga * da + gb * db, 1.0
        now = sums(a + da, b + db)
        while now[0] > loss + 1e-4 * size * slope and size > 1e-10:
            size /= 2
            now = sums(a + size * da, b + size * db)
        if now[0] >= loss:  # no better point left in doubles
            break
        a, b, steps = a + size * da, b + size * db, steps + 1
        loss, ga, gb, haa, hab, hbb = now
    return {"a": a, "b": b, "steps": steps, "loss": loss, "converged": max(abs(ga), abs(gb)) <= 100 * tol * total}


def platt_fit(margins: DataFrame, score: str = "_s", label: str = "label") -> tuple[float, float]:
    """(a, b) of :func:`platt_newton`."""
    found = platt_newton(margins, score, label)
    return found["a"], found["b"]


def fit_svm_prob(df: DataFrame, spec: FeatureSpec | None = None, label: str = "label", key: str | None = None,
                 folds: int = 5, parallelism: int | None = None, max_iter: int = MAX_ITER, tol: float = TOL_SVC) -> TextModel:
    """J1 + J4: linear SVM (C=1) on four-field TF-IDF (top 500) with Platt
    calibration (smoothed targets, ``platt_newton``) fitted on out-of-fold
    margins (``folds`` hash folds over one shared set of vectors). Fold fits and
    the final fit run as concurrent Spark jobs, like ``CrossValidator(parallelism=...)``.
    ``fit`` of the result reports the solver and the calibration."""
    from concurrent.futures import ThreadPoolExecutor
    spec = spec or FeatureSpec(kind="four_field", vocab="topk", k=500)
    # without a key, the fold is a hash of the row: the same whatever the partitioning
    k = F.col(key) if key else F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    train = training_set(spec.prepare(df).withColumn("_fold", F.pmod(F.xxhash64(k), F.lit(folds))), spec, label)
    vectors = train.vectors

    def fold_margins(f):
        part = vectors.where(F.col("_fold") == f)
        rest = vectors.where(F.col("_fold") != f)
        if rest.select("label").distinct().count() < 2:
            return None
        m = _svc(rest, False, max_iter, tol)
        return m.transform(part).select("label", vector_to_array("rawPrediction")[1].alias("_s"))

    with ThreadPoolExecutor(max_workers=parallelism or folds + 1) as pool:
        final_f = pool.submit(_svc, vectors, False, max_iter, tol)
        parts = [p for p in pool.map(fold_margins, range(folds)) if p is not None]
        final = final_f.result()
    platt, report = (1.0, 0.0), _fit_report(final, max_iter)
    if parts:
        margins = parts[0]
        for p in parts[1:]:
            margins = margins.unionByName(p)
        margins = written_table(margins)
        if margins.select("label").distinct().count() > 1:
            report["calibration"] = platt_newton(margins)
            platt = (report["calibration"]["a"], report["calibration"]["b"])
    return train.model(final, spec, platt=platt, fit=report)


# --------------------------------------------------------------------- applying models
def predict(df: DataFrame, model: TextModel, out: str = "predicted_label") -> DataFrame:
    """0/1 class (plus the raw margin ``score``)."""
    out_df = model.transform(df).withColumn(out, F.col("prediction").cast("int"))
    return out_df if out == "prediction" else out_df.drop("prediction")


def classify(df: DataFrame, model: TextModel, threshold: float = REVIEW_PROB) -> DataFrame:
    """Class, calibrated confidence and review flag."""
    scored = predict(df, model, out="is_community_event")
    a, b = model.platt or (1.0, 0.0)
    return (scored.withColumn("confidence", calibrated_expr(F.col("score"), a, b))
            .withColumn("needs_review", F.col("confidence") < threshold).drop("score"))


def tag(df: DataFrame, model: TextModel, confidence: bool = False,
        conf_col: str = "prediction_confidence") -> DataFrame:
    """Predicted label, and optionally the margin confidence (J5) in
    ``prediction_confidence`` (the tagger's name for it)."""
    out = predict(df, model)
    if confidence:
        out = out.withColumn(conf_col, margin_confidence_expr(F.col("score")))
    return out.drop("score")


def smart_label(df: DataFrame, model: TextModel, threshold: float = REVIEW_MARGIN, auto: bool = False,
                existing: DataFrame | None = None, uid: str = "uid", order_col: str | None = None,
                columns: list | None = None) -> DataFrame:
    """Tag with margin confidence, flag (D7), optionally auto-accept
    (D8) and merge after existing rows, first per uid (G4). ``columns``: those of
    ``df`` that come out (all, and the model's features); a merge moves no others."""
    from .merge import merge_first_wins
    out = tag(df, model, confidence=True, conf_col="confidence").withColumn(
        "needs_review", F.col("confidence") < threshold)
    if auto:
        out = out.withColumn("label", F.when(~F.col("needs_review"), F.col("predicted_label")))
    if columns is not None:
        made = ["predicted_label", "confidence", "needs_review"] + ["label"] * auto
        out = out.select(*[c for c in columns if c not in made], *made)
    if existing is not None:
        out = merge_first_wins(existing, out, uid=uid, order_col=order_col)
    return out


class SelfTrained(NamedTuple):
    """Result of :func:`self_train`: the merged rows, the final model and its
    holdout report (None with fewer than 10 labelled rows), the first model and
    its accuracy on the rows it was fitted on (None if it was given)."""
    merged: DataFrame
    model: TextModel | None
    report: DataFrame | None
    first: TextModel
    first_accuracy: float | None


def self_train(existing: DataFrame, new: DataFrame, label: str = "label", uid: str = "uid",
               series: str = "series_id", key: str | None = None, order_col: str | None = None,
               spec: FeatureSpec | None = None, fit_final: bool = True, first: TextModel | None = None) -> SelfTrained:
    """Fit on labelled existing rows (or take the model ``first``), predict
    every new row (replacing its label), majority-propagate in the new set, merge
    by priority, propagate again, then fit the final model on the training side
    of a stratified 80/20 split and evaluate it on the holdout.

    The new rows are scored once, into a written table; relabelling reads that
    table. Fewer than five labelled rows (guard H7) are a ``ValueError``."""
    from .merge import merge_by_priority
    from .propagate import SOURCE_MODEL, SOURCE_SERIES, propagate_majority_overwrite
    from .report import accuracy, classification_report, train_guards
    labelled = existing.where(F.col(label).isNotNull())
    first_accuracy = None
    if first is None:
        guards = train_guards(labelled, series if series in labelled.columns else label, label).first()
        if not guards["can_first_model"]:
            raise ValueError(f"{guards['labeled']} labelled rows; the first model needs at least 5")
        first = fit_svm_prob(labelled, spec, label=label, key=key)
        fitted = predict(labelled, first, out="prediction").select(label, "prediction")
        first_accuracy = accuracy(fitted, truth=label, pred="prediction").first()[0]
    pred = classify(new.drop(label), first).withColumn(label, F.col("is_community_event")) \
        .withColumnRenamed("confidence", "prediction_confidence").drop("is_community_event", "needs_review")
    pred = propagate_majority_overwrite(written_table(pred), series, label)
    # the reference's new rows carry a source column only when some series
    # propagated; without one, all new rows count as model predictions
    any_series = pred.agg(F.coalesce(F.bool_or(F.col("label_source") == SOURCE_SERIES), F.lit(False))).scalar()
    pred = pred.withColumn("label_source", F.when(any_series, F.col("label_source")).otherwise(F.lit(SOURCE_MODEL)))
    merged = merge_by_priority(existing, pred, uid=uid, order_col=order_col)
    merged = written_table(propagate_majority_overwrite(merged, series, label))
    final, report = None, None
    lab = merged.where(F.col(label).isNotNull())
    if fit_final and lab.count() >= 10:
        # holdout as in the reference: per-class 80/20 when there are at least
        # 20 labelled rows (else train = test = all); the vectoriser is fitted
        # on the training side only (the reference fits it before splitting)
        s = stratified_split(lab, label, key=key or uid)
        train = s.where(F.col("split").isin("train", "both"))
        test = s.where(F.col("split").isin("test", "both"))
        final = fit_svm_prob(train, spec, label=label, key=key)
        scored = predict(test, final, out="prediction")
        report = classification_report(scored, truth=label, pred="prediction")
    return SelfTrained(merged, final, report, first, first_accuracy)
