"""LM scoring with a hashed maximum-entropy model (operator 8).

Tokens are the lower-cased (A-Z) words and one end per text. Counts of every
token over all training texts give the base score (add 0.5 to each count). The
model factors a token by class: P(class | history) P(word | class, history),
both softmaxes over hashed n-gram and skip features of the three tokens before.

* The ``DICTIONARY`` most frequent tokens (a bound on what is sent to tasks) have
  a class each: the cluster of texts they are most typical of, and a frequency
  band in it. Every other token, seen or not, is in the tail class. The counts
  of tail tokens are joined by token, so no count is left out.
* Inside a class the ``SHORT`` most frequent words and one slot for the others
  have contextual weights; the others share their slot by count, tail tokens
  by count plus 0.5. All of it sums to one over the known tokens and one unknown.
* Weights are trained by ``ROUNDS`` of distributed gradient steps over all training
  texts, in shards of about ``max_train`` texts (``SHARDS`` at least): mini-batch
  Adagrad runs from the common weights over each shard, and the shards' changes are
  averaged per touched row, summed in Spark before they reach the driver. Anchors,
  clusters, counts, classes and base score cover all training texts too.
* Texts are cut into words twice, to count tokens and to write their ids; all later
  steps read the ids, a dictionary token's number or one number for all others.

Cases: null and empty texts are one end token; with no training text every
score is 0 (one unknown token is certain); null ids are learned from; equal
ids are separate rows; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import copy
from collections import Counter
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, materialize, with_row_key
from .toxicity import held_out

DICTIONARY = 1 << 18
SHORT = 31
BANDS = 4
CLUSTERS = 6
ANCHORS = 64
#: Training texts in a shard, about.
MAX_TRAIN = 4096
ROUNDS = 4
#: Shards at least.
SHARDS = 8
ROWS = 1 << 15
#: Texts that first centres are chosen from, and steps of the centres over all texts.
SEEDS, CENTRE_STEPS = 2048, 15
CHUNK = 16384
#: Distinct tokens that a counting task holds before it passes them on.
HELD = 500_000
#: Gradients of a row that are added one by one before they are added in parts.
STEPS = 8
#: Weight rows that are changed at a time; they stay in a core's cache.
BLOCK = 1024
#: The end of a text; words are never empty.
END = b""


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def _decoded(words) -> pa.Array:
    words = list(words)
    try:
        return pa.array(words, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # a lone surrogate
        return pa.array([w.decode("utf-8", "replace") for w in words], pa.string())


def _softmax(z: np.ndarray) -> np.ndarray:
    """Of each row, in place."""
    ones = np.ones(z.shape[1], dtype=z.dtype)
    with np.errstate(over="ignore"):
        e = np.exp(z)
        total = e @ ones
    if not (len(z) and 1e-20 < total.min() and total.max() < 1e30):  # out of range: from the largest of each row
        z -= z.max(1, keepdims=True, initial=-np.inf)
        e = np.exp(z, out=z)
        total = e @ ones
    return np.multiply(e, (1 / total)[:, None], out=z)


def _logits(table: np.ndarray, rows, z: np.ndarray) -> np.ndarray:
    """``z`` and the given rows of the table, in place."""
    more = np.empty_like(z)
    for r in rows:
        z += table.take(r, axis=0, out=more, mode="clip")
    return z


def _added(values: np.ndarray, at: np.ndarray, begins: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of ``values[at]`` over runs, the longest run first: the first ``STEPS``
    rows of all runs one by one, what is left of long runs by parts of that size."""
    out = values.take(at.take(begins), axis=0)
    least = len(size) - np.cumsum(np.bincount(np.minimum(size, STEPS + 1), minlength=STEPS + 2))  # [j]: runs of more than j
    for j in range(1, STEPS):
        if not (m := least[j]):
            return out
        out[:m] += values.take(at.take(begins[:m] + j), axis=0)
    if m := least[STEPS]:
        ends = begins[:m] + size[:m]
        parts = (size[:m] - 1) // STEPS  # without the first
        first = np.cumsum(parts) - parts
        start = np.arange(first[-1] + parts[-1]) * STEPS + np.repeat(begins[:m] + STEPS - first * STEPS, parts)
        length = np.minimum(STEPS, np.repeat(ends, parts) - start)
        order = np.argsort((STEPS - length).astype(np.uint8), kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        out[:m] += _added(_added(values, at, start[order], length[order]), place, first, parts)
    return out


class Weights:
    """A weight table for descent with each weight's sum of squares; a batch
    fetches and writes each row it touches once."""

    def __init__(self, table: np.ndarray):
        self.width = table.shape[1]
        self.table, self.squares = np.stack([table, np.full_like(table, 0.1)])
        # one item for each row, moved as a whole
        self.row = np.dtype((np.void, table.itemsize * self.width))
        self.hit = np.zeros(len(table), dtype=bool)

    @property
    def both(self) -> np.ndarray:
        return np.concatenate([self.table, self.squares], axis=1)

    @property
    def own(self) -> np.ndarray:
        """Of the rows fetched last."""
        return np.concatenate([self.own_table, self.squares.take(self.rows, axis=0)], axis=1)

    def fetch(self, rows, base: np.ndarray) -> np.ndarray:
        """Probabilities from the given rows (arrays by feature, of the same tokens)."""
        n = len(rows[0])
        bits = max(1, n - 1).bit_length()
        low = bits + len(rows).bit_length()
        kind = np.uint32 if low + len(self.table).bit_length() <= 32 else np.uint64
        # row, feature and token in one number: sorted without an index
        every = np.empty((len(rows), n), dtype=kind)
        for f, r in enumerate(rows):
            np.bitwise_or(r.astype(kind) << kind(low), np.arange(n, dtype=kind) | kind(f << bits), out=every[f])
        every = np.sort(every.ravel())
        row, entry = (every >> kind(low)).astype(np.int64), (every & kind((1 << low) - 1)).astype(np.int64)
        new = np.empty(len(row), dtype=bool)
        new[0] = True
        np.not_equal(row[1:], row[:-1], out=new[1:])
        begins = np.flatnonzero(new)
        size = np.diff(begins, append=len(row))
        order = np.argsort((len(row) - size).astype(np.uint16) if len(row) < 1 << 16 else -size, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.begins, self.size, self.token = begins[order], size[order], entry & ((1 << bits) - 1)
        self.rows = row[self.begins]
        self.own_table = self.table.take(self.rows, axis=0)
        at = np.empty(len(rows) << bits, dtype=np.int64)
        at[entry] = np.repeat(place, size)
        z = np.empty((n, self.width), dtype=self.table.dtype)
        z[:] = base
        return _softmax(_logits(self.own_table, at.reshape(len(rows), -1)[:, :n], z))

    def step(self, grad: np.ndarray, rate: float) -> None:
        """Adagrad on the rows fetched last."""
        g = _added(grad, self.token, self.begins, self.size)
        table, squares, own = (x.view(self.row)[:, 0] for x in (self.table, self.squares, self.own_table))
        for lo in range(0, len(g), BLOCK):
            part = slice(lo, lo + BLOCK)
            rows, d = self.rows[part], g[part]
            sums = self.squares.take(rows, axis=0)
            more = d * d
            sums += more
            squares[rows] = sums.view(self.row)[:, 0]
            d *= np.float32(rate)
            d /= np.sqrt(sums, out=sums)
            self.own_table[part] -= d
            table[rows] = own[part]
        self.hit[self.rows] = True


class Model:
    """Dictionary, classes and weights; ``score`` gives natural-log sums per text."""

    def __init__(self, words: list[bytes], counts: np.ndarray, cluster: np.ndarray, n_tokens: int, n_types: int):
        self.ids = {w: i for i, w in enumerate(words)}
        h = self.h = len(words)
        self.n, self.v = n_tokens, n_types
        self.logs = np.append(np.log10(counts + 0.5), 0.0)  # of the tail class: added by the join
        tail_mass = n_tokens - int(counts.sum())
        self.tail_total = tail_mass + 0.5 * (n_types - h + 1)
        end = self.ids.get(END, -1)
        classes: list[np.ndarray] = []
        for g in range(CLUSTERS):
            own = np.flatnonzero((cluster == g) & (np.arange(h) != end))
            own = own[np.argsort(-counts[own], kind="stable")]
            if len(own):
                share = (np.cumsum(counts[own]) - counts[own] / 2) / counts[own].sum()
                band = np.minimum((share * BANDS).astype(int), BANDS - 1)
                classes += [own[band == b] for b in range(BANDS) if (band == b).any()]
        self.cls = np.zeros(h + 2, dtype=np.int64)  # h: tail, h + 1: before the text
        self.slot = np.zeros(h + 2, dtype=np.int64)
        self.inside = np.zeros(h + 2)  # log share of a word in its class's slot for others
        k = len(classes)
        self.inner = k  # classes with words to choose from
        self.b2 = np.full((k + 2, SHORT + 1), -1e9, dtype=np.float32)
        mass = []
        for c, own in enumerate(classes):
            self.cls[own] = c
            first = own[:SHORT]
            self.slot[first] = np.arange(len(first))
            self.b2[c, : len(first)] = np.log(counts[first])
            rest = own[SHORT:]
            if len(rest):
                self.slot[rest] = SHORT
                self.inside[rest] = np.log(counts[rest] / counts[rest].sum())
                self.b2[c, SHORT] = np.log(counts[rest].sum())
            mass.append(counts[own].sum())
        if end >= 0:
            self.cls[end] = k
            mass.append(counts[end])
            k += 1
        self.cls[h:] = k
        mass.append(self.tail_total)
        self.k = k + 1
        self.b1 = np.log(np.maximum(np.array(mass, dtype=np.float64), 1e-9)).astype(np.float32)
        self.t1 = np.zeros((ROWS, self.k), dtype=np.float32)
        self.t2 = np.zeros((ROWS, SHORT + 1), dtype=np.float32)

    def encode(self, words: list[bytes]) -> np.ndarray:
        get, h = self.ids.get, self.h
        out = np.fromiter(map(get, words, repeat(h)), np.int64, len(words))
        return np.append(out, get(END, h))

    def history(self, ids: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
        """The three tokens before each; ``begins`` marks the first token of a text."""
        since = np.arange(len(ids)) - np.maximum.accumulate(np.where(begins, np.arange(len(ids)), 0))
        return [np.where(since >= d, np.concatenate([np.full(d, self.h + 1), ids])[: len(ids)], self.h + 1) for d in (1, 2, 3)]

    def rows(self, before: list[np.ndarray], cls: np.ndarray):
        p1, p2, p3 = (x.astype(np.uint64) for x in before)
        c1, c2, c3 = (self.cls[x].astype(np.uint64) for x in before)
        cl = cls.astype(np.uint64)

        def h(salt, *xs):
            v = np.full(len(p1), salt, dtype=np.uint64)
            for x in xs:
                v = (v ^ x) * np.uint64(0x9E3779B97F4A7C15)
                v ^= v >> np.uint64(29)
            return (v * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(65 - ROWS.bit_length())).astype(np.int64)

        trio = c1 << np.uint64(20) | c2 << np.uint64(10) | c3
        one = [h(1, p1), h(2, p1, p2), h(3, p2), h(4, p3), h(5, trio)]
        two = [h(6, p1, cl), h(7, p2, cl), h(8, trio, cl)]
        return one, two

    def forward(self, ids, before):
        cls, slot = self.cls[ids], self.slot[ids]
        one, two = self.rows(before, cls)
        sub = np.flatnonzero(cls < self.inner)
        z = _softmax(_logits(self.t1, one, np.tile(self.b1, (len(ids), 1))))
        y = _softmax(_logits(self.t2, [r[sub] for r in two], self.b2.take(cls[sub], axis=0)))
        return cls, slot, z, sub, y

    def score(self, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Natural-log probability of each token; of a tail token, that of its class."""
        before = self.history(ids, begins)
        out = np.empty(len(ids))
        for at in range(0, len(ids), CHUNK):
            part = slice(at, at + CHUNK)
            x = ids[part]
            cls, slot, z, sub, y = self.forward(x, [b[part] for b in before])
            lp = np.log(z[np.arange(len(x)), cls].astype(np.float64) + 1e-30)
            lp[sub] += np.log(y[np.arange(len(sub)), slot[sub]].astype(np.float64) + 1e-30)
            out[part] = lp + self.inside[x]
        return out

    def descend(self, ids: np.ndarray, begins: np.ndarray, rate: float, batch: int = 2048):
        """Mini-batch Adagrad over the tokens, in place; the weights are copied first."""
        one, two = Weights(self.t1), Weights(self.t2)
        before = self.history(ids, begins)
        for at in range(0, len(ids), batch):
            part = slice(at, at + batch)
            x = ids[part]
            cls, slot = self.cls[x], self.slot[x]
            rows1, rows2 = self.rows([b[part] for b in before], cls)
            z = one.fetch(rows1, self.b1)
            z[np.arange(len(x)), cls] -= 1
            one.step(z, rate)
            sub = np.flatnonzero(cls < self.inner)
            if len(sub):
                y = two.fetch([r[sub] for r in rows2], self.b2.take(cls[sub], axis=0))
                y[np.arange(len(sub)), slot[sub]] -= 1
                two.step(y, rate)
        self.t1, self.t2 = one.table, two.table
        return one.hit, two.hit


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Square roots of the anchor counts, of length one; texts without anchors are left out."""
    x = np.sqrt(vectors)
    x = x[x.sum(1) > 0]
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _stacked(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _clusters(vectors: DataFrame, size: int, share: float) -> np.ndarray:
    """Spherical k-means centres of all rows (v: a text's anchor counts; _h); first
    centres come from about a ``share`` of them, the steps cover every row."""
    def stacked(column):
        return _stacked(column, size)

    some = vectors.filter(F.pmod("_h", F.lit(1 << 32)) < int(share * (1 << 32))).orderBy("_h").select("v").toArrow().column("v").combine_chunks()
    x = _unit(stacked(some)) if len(some) else np.zeros((0, size))
    if not len(x):
        return np.zeros((CLUSTERS, size))
    centres = [x[0]]
    for _ in range(CLUSTERS - 1):  # farthest first
        centres.append(x[np.argmin(np.max(x @ np.array(centres).T, axis=1))])
    c = np.array(centres)

    def sums(batches):
        total = np.zeros((CLUSTERS, size), dtype=np.int64)  # whole numbers: the order of adding does not matter
        for b in batches:
            y = _unit(stacked(b.column(0)))
            near = (y @ c.T).argmax(1)
            whole = np.rint(y * (1 << 30)).astype(np.int64)
            for g in range(CLUSTERS):
                total[g] += whole[near == g].sum(0)
        g, d = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(d, pa.int32()), pa.array(total[g, d], pa.int64())], ["g", "d", "s"])

    for _ in range(CENTRE_STEPS):
        got = vectors.select("v").mapInArrow(sums, "g int, d int, s long").groupBy("g", "d").agg(F.sum("s").alias("s")).collect()
        m = np.zeros((CLUSTERS, size))
        for r in got:
            m[r.g, r.d] = r.s
        some = m.any(1)
        new = c.copy()
        new[some] = m[some] / np.linalg.norm(m[some], axis=1, keepdims=True)
        if (new == c).all():
            break
        c[:] = new
    return c


def _texts(docs: DataFrame, text: str, doc_id: str, mod: int, rest: int):
    keyed, keys = with_row_key(docs)
    return keyed.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), held_out(doc_id, mod, rest).alias("held_out"),
                        F.col(f"`{text}`").cast("string").alias("text"), F.xxhash64(F.col(f"`{doc_id}`"), F.col(keys[1])).alias("_h"))


def train(rows: DataFrame, max_train: int = MAX_TRAIN) -> tuple[Model, DataFrame]:
    """(model, table of all training counts: token, n)."""
    return _learn(rows, max_train)[:2]


def _learn(rows: DataFrame, max_train: int) -> tuple[Model, DataFrame, DataFrame]:
    """(model, training counts, all texts as token ids). A text is cut into words
    twice: to count its tokens and to write their ids; all else reads the ids."""
    learn = rows.filter(~F.col("held_out"))

    def local(batches):
        c: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([_decoded(c), pa.array(list(c.values()), pa.int64())], ["token", "n"])

        for b in batches:
            for t in b.column(0):
                c.update(tokens(t.as_py()))
                c[END] += 1
                if len(c) > HELD:
                    yield out()
                    c.clear()
        if c:
            yield out()

    counts = materialize(learn.select("text").mapInArrow(local, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")))
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    order = [F.col("n").desc(), "token"]
    anchors = [r.token.encode() for r in counts.filter(F.col("token") != END.decode()).orderBy(*order).limit(ANCHORS).collect()]
    # the most frequent tokens, cut at a step of the counts' logarithm: few numbers reach the driver
    step = F.floor(F.log2("n") * 8).cast("int")
    least, room = 0, DICTIONARY
    for s, m in sorted(((r.s, r["count"]) for r in counts.groupBy(step.alias("s")).count().collect()), reverse=True):
        if m > room:
            least = s + 1
            break
        room -= m
    best = counts.filter(step >= least).orderBy(*order).toArrow()
    words = [w.as_py().encode() for w in best.column("token")]
    size = max(1, len(anchors))
    coded = _coded(rows, words, anchors)
    own = coded.filter(~F.col("held_out"))
    total = own.count()
    near = _cluster_counts(own, _clusters(own.select("v", "_h"), size, min(1.0, SEEDS / max(1, total))), len(words))
    model = Model(words, best.column("n").to_numpy().astype(np.float64), near, int(n), int(v))
    del best
    if n:
        shards = _shards(own, max(SHARDS, -(-total // max_train)))
        for r in range(ROUNDS):
            _round(shards, model, 0.3 / (1 + r))
    return model, counts, coded


def _coded(rows: DataFrame, words: list[bytes], anchors: list[bytes]) -> DataFrame:
    """All texts: row (a number of its own), doc_id, held_out, _h, ids (of the
    dictionary ``words``, others their number), v (counts of the anchors) and tail
    (the other tokens and how often they occur)."""
    size = max(1, len(anchors))
    ids = {w: i for i, w in enumerate(words)}
    known = len(ids)
    for w in anchors:
        ids.setdefault(w, len(ids) + 1)  # an anchor outside the dictionary
    anchor = np.full(len(ids) + 2, -1)
    anchor[[ids[w] for w in anchors]] = np.arange(len(anchors))
    pair = pa.struct([("token", pa.string()), ("n", pa.int64())])

    def run(batches):
        at = TaskContext.get().partitionId() << 40
        get = ids.get
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                n = part.num_rows
                lists = [tokens(t) for t in part.column(3).to_pylist()]
                for own in lists:
                    own.append(END)
                flat = list(chain.from_iterable(lists))
                lens = np.fromiter(map(len, lists), np.int64, n)
                x = np.fromiter(map(get, flat, repeat(known)), np.int32, len(flat))
                text = np.repeat(np.arange(n), lens)
                a = anchor[x]
                some = np.flatnonzero(a >= 0)
                v = np.bincount(text[some] * size + a[some], minlength=n * size)
                rare = np.flatnonzero(x >= known)
                c = Counter(zip(text[rare].tolist(), map(flat.__getitem__, rare.tolist())))
                held = np.bincount(np.fromiter((k for k, _ in c), np.int64, len(c)), minlength=n)
                tail = pa.StructArray.from_arrays([_decoded(w for _, w in c), pa.array(list(c.values()), pa.int64())], fields=list(pair))
                whole = np.minimum(x, known).tobytes()
                ends = np.cumsum(lens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at + np.arange(n)), *part.columns[:3], pa.array([whole[4 * (e - k): 4 * e] for e, k in zip(ends.tolist(), lens.tolist())], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(v, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(held)), pa.int32()), tail)],
                    ["row", "doc_id", "held_out", "_h", "ids", "v", "tail"])
                at += n

    return materialize(rows.select("doc_id", "held_out", "_h", "text").mapInArrow(
        run, "row long, doc_id long, held_out boolean, _h long, ids binary, v array<int>, tail array<struct<token:string,n:bigint>>"))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, and the number of each."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1] // 4
    return np.frombuffer(column.buffers()[2], np.int32, ends[-1])[ends[0]:], np.diff(ends).astype(np.int64)


def _cluster_counts(own: DataFrame, centres: np.ndarray, h: int) -> np.ndarray:
    """The cluster of texts that each dictionary token is most typical of."""

    def counted(batches):
        total = np.zeros((CLUSTERS, h + 1), dtype=np.int64)
        for b in batches:
            near = (np.sqrt(_stacked(b.column(1), centres.shape[1])) @ centres.T).argmax(1)
            ids, lens = _flat(b.column(0))
            where = np.repeat(near * (h + 1), lens)
            where += ids
            at, n = np.unique(where, return_counts=True)
            total.ravel()[at] += n
        at = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *map(pa.array, total[:, at])], ["id", *names])

    names = [f"g{g}" for g in range(CLUSTERS)]
    counts = materialize(own.select("ids", "v").mapInArrow(counted, ", ".join(["id int", *[f"{g} long" for g in names]]))
                         .groupBy("id").agg(*[F.sum(g).alias(g) for g in names]))
    mass = counts.agg(*[F.coalesce(F.sum(g), F.lit(0)) for g in names]).first()
    typical = F.array(*[F.col(g) / max(1, m) for g, m in zip(names, mass)])
    got = counts.filter(F.col("id") < h).select("id", (F.array_position(typical, F.array_max(typical)) - 1).alias("g")).toArrow()
    out = np.zeros(h, dtype=np.int64)
    out[got.column("id").to_numpy()] = got.column("g").to_numpy()
    return out


def _shards(own: DataFrame, n: int) -> DataFrame:
    """(shard, _h, ids): all training texts, the rows of a shard together."""
    # the low bits of the hash choose the seeds of the clusters, so the high ones choose the shard
    shard = F.pmod(F.shiftright("_h", 32), F.lit(n)).cast("int")
    return materialize(own.select(shard.alias("shard"), "_h", "ids").repartition(n, "shard").sortWithinPartitions("shard", "_h"))


def _round(shards: DataFrame, model: Model, rate: float) -> None:
    """Descent over every shard from the common weights; changes are averaged per
    touched row, summed by row in Spark: the driver gets each weight row once."""
    widths = [model.t1.shape[1], model.t2.shape[1]]
    spark = shards.sparkSession
    light = copy.copy(model)
    light.ids, light.logs, light.inside = {}, None, None  # not needed to descend
    sent = spark.sparkContext.broadcast(light)

    def run(batches):
        model = copy.copy(sent.value)
        old = model.t1, model.t2
        parts: list = []

        def out():
            begins = np.zeros(sum(map(len, parts)), dtype=bool)
            begins[np.cumsum([0, *map(len, parts[:-1])])] = True
            hits = model.descend(np.concatenate(parts).astype(np.int64), begins, rate)
            for k, (new, was, hit) in enumerate(zip((model.t1, model.t2), old, hits)):
                at = np.flatnonzero(hit)
                change = (new[at] - was[at]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array(at * 2 + k, pa.int32()), pa.array([x.tobytes() for x in change], pa.binary())], ["row", "change"])
            model.t1, model.t2 = old
            parts.clear()

        now = None
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1)):
                if k != now and parts:
                    yield from out()
                now = k
                parts.append(np.frombuffer(x.as_buffer(), np.int32))
        if parts:
            yield from out()

    def added(batches):
        total = [np.zeros((ROWS, w)) for w in widths]  # sums of 16-bit floats are exact in any order
        times = [np.zeros(ROWS, dtype=np.int64) for _ in widths]
        for b in batches:
            row = b.column(0).to_numpy()
            for k, w in enumerate(widths):
                own = np.flatnonzero(row % 2 == k)
                if len(own):
                    x = np.frombuffer(b"".join(b.column(1).take(pa.array(own)).to_pylist()), np.float16).reshape(-1, w)
                    np.add.at(total[k], row[own] >> 1, x.astype(np.float64))
                    np.add.at(times[k], row[own] >> 1, 1)
        for k in range(len(widths)):
            at = np.flatnonzero(times[k])
            mean = (total[k][at] / times[k][at, None]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(at * 2 + k, pa.int32()), pa.array([x.tobytes() for x in mean], pa.binary())], ["row", "change"])

    got = (shards.select("shard", "ids").mapInArrow(run, "row int, change binary").repartition("row")
           .mapInArrow(added, "row int, change binary").toArrow())
    sent.destroy()
    spark.sparkContext._jvm.System.gc()  # lets Spark remove the round's shuffle files
    row = got.column("row").to_numpy()
    tables = [model.t1.copy(), model.t2.copy()]
    for k, w in enumerate(widths):
        own = np.flatnonzero(row % 2 == k)
        if len(own):
            tables[k][row[own] >> 1] += np.frombuffer(b"".join(got.column("change").take(pa.array(own)).to_pylist()), np.float32).reshape(-1, w)
    model.t1, model.t2 = tables


def score_lm(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mod: int = 5, rest: int = 1,
             max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = _texts(docs, text, doc_id, mod, rest)
    model, counts, coded = _learn(rows, max_train)
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "known_log", "model_log"]
    light = copy.copy(model)
    light.ids = {}  # not needed to score

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids, lens = _flat(part.column(3))
                starts = np.cumsum(lens) - lens
                begins = np.zeros(len(ids), dtype=bool)
                begins[starts] = True
                lp = np.add.reduceat(light.score(ids, begins), starts) / np.log(10)
                known = np.add.reduceat((ids < light.h).astype(np.int64), starts)
                base = np.add.reduceat(light.logs[ids], starts)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(lens), pa.array(known), pa.array(base), pa.array(lp)], names)

    scored = coded.select("row", "doc_id", "held_out", "ids").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, model_log double")
    tail = coded.select("row", F.explode("tail").alias("t")).select("row", "t.token", F.col("t.n").alias("m"))
    c = F.coalesce(F.col("n"), F.lit(0))
    found = (tail.join(counts, "token", "left").groupBy("row")
             .agg(F.sum(F.col("m") * F.log10(c + 0.5)).alias("tail_log"), F.sum(F.when(c > 0, F.col("m")).otherwise(0)).alias("tail_known"),
                  F.sum("m").alias("tail_n")))
    base_total = float(np.log10(model.n + 0.5 * (model.v + 1)))
    z = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("tail_log", "tail_known", "tail_n")}
    return (scored.join(found, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + z["tail_known"]).alias("n_known"),
                    F.lit(model.n).cast("long").alias("train_tokens"),
                    (F.col("known_log") + z["tail_log"] - F.col("n_tokens") * base_total).alias("base_score"),
                    (F.col("model_log") + z["tail_log"] - z["tail_n"] * float(np.log10(model.tail_total))).alias("score")))
