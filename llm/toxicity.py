"""Toxicity by a factorization machine over hashed terms (operator 1).

A text's terms are its words and their first four and five letters, lower-cased,
each present or not. Terms are hashed into ``BUCKETS`` buckets; of these the
``features`` that tell most are kept, toxic, clean or neutral alone: by the log-likelihood
ratio (at least ``EVIDENCE``) of their toxic share against that of all rows, or against
that of the rows with the same strongest toxic-leaning bucket, so that a term which only
matters beside an insult is kept too. The machine adds weights of single terms and, through vectors of
``FACTORS`` numbers, of every pair of terms that occur together, so that an
insult and a mention of a group weigh more together than apart. Scoring needs
one pass over the texts and no shuffle.

Only rows that ``held_out`` does not mark are learned from, about ``max_train``
of them at most (chosen by hash of the id; this bounds what the fit takes in).
Cases: null and empty texts get the score of a text without known terms; rows
without labels are scored but not learned from; null labels or ids are not
learned from; of several labels of an id the largest holds; with no training
rows, or only one class, every score is the smoothed share of the toxic class;
an empty table gives an empty result; further columns of ``docs`` are kept by
:func:`reject_toxic` and ignored by :func:`score_toxicity`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize

BUCKETS = 1 << 20
FACTORS = 8
#: Labelled rows that the fit takes in, about, where there are more.
MAX_TRAIN = 20000
#: Buckets that the machine uses at most.
FEATURES = 4096
#: Log-likelihood ratio that a bucket needs.
EVIDENCE = 5.0
THRESHOLD = 0.3
#: Words whose terms a task remembers; forgotten all at once when there are more.
MEMORY = 200_000
EDGE = ".,;:!?\"'()[]{}<>«»“”„‘’*_-|"


def word_terms(word: str) -> tuple[int, ...]:
    """Buckets of a lower-cased word: itself, its first four and first five letters."""
    w = word.strip(EDGE)
    if not w:
        return ()
    names = {"=" + w}
    names |= {"^" + w[:n] for n in (4, 5) if len(w) >= n}
    return tuple({xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in names})


def text_terms(text: str | None, seen: dict, known: dict | None = None) -> set[int]:
    """Buckets of a whole text (places in ``known``, and only those, if given)."""
    out: set[int] = set()
    for w in set((text or "").lower().split()):
        ids = seen.get(w)
        if ids is None:
            ids = word_terms(w)
            if known is not None:
                ids = tuple(known[i] for i in ids if i in known)
            if len(seen) >= MEMORY:
                seen.clear()
            if len(w) < 100:
                seen[w] = ids
        if ids:
            out.update(ids)
    return out


def held_out(doc_id: str, mod: int = 4, rest: int = 2) -> Column:
    """True where crc32 of the id as text leaves ``rest``; false for a null id."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % mod == rest, F.lit(False))


class Machine:
    """Weights of a factorization machine; ``known`` maps a bucket to its place."""

    def __init__(self, known: dict[int, int], bias: float, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.known, self.bias = known, np.array([bias])
        self.w = np.zeros(max(1, len(known)))
        self.v = rng.normal(0, 0.02, (max(1, len(known)), FACTORS))

    def parts(self, rows: np.ndarray, ids: np.ndarray, n: int):
        s = np.zeros((n, FACTORS))
        q = np.zeros(n)
        if len(ids):
            vi = self.v[ids]  # rows come in order
            some, at = np.unique(rows, return_index=True)
            s[some] = np.add.reduceat(vi, at, axis=0)
            q = np.bincount(rows, (vi * vi).sum(1), n)
        lin = np.bincount(rows, self.w[ids], n) if len(ids) else np.zeros(n)
        return self.bias[0] + lin + 0.5 * ((s * s).sum(1) - q), s

    def score(self, rows, ids, n) -> np.ndarray:
        z, _ = self.parts(rows, ids, n)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, rows, ids, y, steps: int = 250, rate: float = 0.05, decay: float = 2e-4) -> list[float]:
        """Full-batch Adam on the regularised log loss; returns the loss of each step."""
        n, history = len(y), []
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.bias, self.w, self.v)]
        by_id = np.argsort(ids, kind="stable")
        used, at = np.unique(ids[by_id], return_index=True)
        for t in range(1, steps + 1):
            z, s = self.parts(rows, ids, n)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            history.append(float(-np.mean(np.where(y > 0, np.log(p + 1e-12), np.log(1 - p + 1e-12)))))
            g = (p - y) / n
            gi = g[rows]
            gv = np.zeros_like(self.v)
            if len(ids):
                gv[used] = np.add.reduceat((gi[:, None] * (s[rows] - self.v[ids]))[by_id], at, axis=0)
            grads = (np.array([g.sum()]), np.bincount(ids, gi, len(self.w)) + decay * self.w, gv + 5 * decay * self.v)
            for p_, g_, (m, q) in zip((self.bias, self.w, self.v), grads, state):
                m += 0.1 * (g_ - m)
                q += 0.01 * (g_ * g_ - q)
                p_ -= rate * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.99**t)) + 1e-8)
        return history


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    lens = np.array([len(x) for x in lists], dtype=np.int64)
    ids = np.fromiter((i for x in lists for i in x), np.int64, int(lens.sum()))
    return np.repeat(np.arange(len(lens)), lens), ids


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
          mod: int = 4, rest: int = 2, max_train: int = MAX_TRAIN, features: int = FEATURES) -> Machine:
    """Fit on labelled rows that are not held out; the driver sees ``features``
    bucket counts and, for the sampled rows, the places of their known terms."""
    known_labels = (labels.filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
                    .groupBy(F.col(f"`{doc_id}`").alias("_of")).agg((F.max(F.col(f"`{label}`")) > 0).cast("int").alias("_y")))
    usable = materialize(known_labels.filter(~held_out("_of", mod, rest)))
    cut = int(min(1.0, max_train / max(1, usable.count())) * (1 << 32))
    sample = usable.filter(F.pmod(F.xxhash64("_of"), F.lit(1 << 32)) < cut)
    # about max_train ids at most, so small enough to send to every task: no text is moved
    narrow = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    rows = narrow.join(F.broadcast(sample), F.col("_id") == F.col("_of")).select("_of", "_y", "_text")

    def terms(batches):
        seen: dict = {}
        for b in batches:
            ids = [sorted(text_terms(t.as_py(), seen)) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(ids, pa.list_(pa.int32()))], ["of", "y", "ids"])

    # a repeated id counts once, with the least of its term lists
    of = rows.schema["_of"].dataType.simpleString()
    sparse = materialize(rows.mapInArrow(terms, f"of {of}, y int, ids array<int>").groupBy("of", "y").agg(F.min("ids").alias("ids")).select("y", "ids"))
    n, pos = sparse.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    share = (pos + 0.5) / (n + 1)
    if not 0 < pos < n:
        return Machine({}, float(np.log(share / (1 - share))))

    def gain(k, n, pos, total):
        """Log-likelihood ratio of a bucket's toxic share against the share of all; two-sided."""
        m = n - k
        return (k * F.log(F.greatest(k, F.lit(1e-9)) * total / (n * F.greatest(pos, F.lit(1e-9))))
                + m * F.log(F.greatest(m, F.lit(1e-9)) * total / (n * F.greatest(total - pos, F.lit(1e-9)))))

    def counted(d, *by):
        return d.groupBy(*by, "id").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").cast("double").alias("k")).filter("n >= 2")

    per = materialize(counted(sparse.select("y", F.explode("ids").alias("id")))
                      .withColumn("gain", gain(F.col("k"), F.col("n"), F.lit(float(pos)), F.lit(float(n)))).filter(F.col("gain") >= EVIDENCE))
    lead = {r.id: p for p, r in enumerate(per.filter(F.col("k") * n > F.col("n") * pos).orderBy(F.col("gain").desc(), "id").limit(features).collect())}

    def strongest(batches):
        for b in batches:
            got = [min((lead[i] for i in x if i in lead), default=-1) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.int32())], ["y", "ids", "lead"])

    led = materialize(sparse.mapInArrow(strongest, "y int, ids array<int>, lead int"))
    among = led.groupBy("lead").agg(F.count(F.lit(1)).cast("double").alias("rows"), F.sum("y").cast("double").alias("toxic")).filter("toxic > 0 and toxic < rows")
    beside = (counted(led.select("y", "lead", F.explode("ids").alias("id")), "lead").join(F.broadcast(among), "lead")  # features + 1 rows at most
              .select("id", gain(F.col("k"), F.col("n"), F.col("toxic"), F.col("rows")).alias("gain")).filter(F.col("gain") >= EVIDENCE))
    best = [r.id for r in per.select("id", "gain").union(beside).groupBy("id").agg(F.max("gain").alias("gain"))
            .orderBy(F.col("gain").desc(), "id").limit(features).collect()]
    known = {i: p for p, i in enumerate(sorted(best))}

    def places(batches):
        for b in batches:
            got = [[known[i] for i in x if i in known] for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int32()))], ["y", "ids"])

    fitted = sparse.mapInArrow(places, "y int, ids array<int>").select(
        "y", F.array_sort("ids").alias("ids")).collect()  # about max_train rows of known terms
    fitted.sort(key=lambda r: (r.y, r.ids))
    machine = Machine(known, float(np.log(share / (1 - share))))
    at, ids = _flat([r.ids for r in fitted])
    machine.fit(at, ids, np.array([r.y for r in fitted], dtype=np.float64))
    return machine


def _scored(docs: DataFrame, machine: Machine, text: str, out: str) -> DataFrame:
    """``docs`` plus a score column; one pass, Arrow batches."""
    names = [*docs.columns, out]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{out}` double"])
    packed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"`{text}`").cast("string").alias(fresh(docs, f"{out}_text")[0]))

    def run(batches):
        seen: dict = {}
        for b in batches:
            at, ids = _flat([text_terms(t.as_py(), seen, machine.known) for t in b.column(b.num_columns - 1)])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(machine.score(at, ids, b.num_rows), pa.float64())], names)

    return packed.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
                   threshold: float = THRESHOLD, **fit) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    machine = train(docs, labels, text, doc_id, label, **fit)
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    kept = _scored(narrow, machine, "_text", "score")
    return kept.select("doc_id", held_out("doc_id", fit.get("mod", 4), fit.get("rest", 2)).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
                 threshold: float = THRESHOLD, **fit) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``."""
    machine = train(docs, labels, text, doc_id, label, **fit)
    (score,) = fresh(docs, "_toxicity")
    return _scored(docs, machine, text, score).filter(F.col(score) < threshold).drop(score)
