"""Linear SVM over term counts dealt by term.

With ``n`` rows and many more terms, the coefficients are ``w = X' beta`` of one
number a row. A solver step needs the products ``X X' v`` only: a task holds some
terms' counts of all rows, works out their coefficients and what these add to
every row's margin. So the driver and what moves hold ``n`` numbers, never one a
term, and the counts move once, by term.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written_table
from .features import term_counts

#: Characters of text whose counts make up one dealt part, about (600,000 counts: what a task holds at a time).
PART_CHARS = 2_500_000
#: Counts in one row of the table, about (a term's counts stay together).
ROW_COUNTS = 1 << 19
#: Numbers in a piece of a vector; partial vectors up to SUM_BYTES in all are summed by the driver, larger ones by piece in tasks.
PIECE, SUM_BYTES = 1 << 16, 32 << 20


def _counts(rows, tf, df, n: int, sublinear: bool):
    """One table row as arrays: place of each count, its tf weight, its term's df, start and idf."""
    rows = np.frombuffer(rows, np.int32)
    tf = np.frombuffer(tf, f"u{len(tf) // len(rows)}")  # the narrowest type that held them
    df = np.frombuffer(df, np.int32)
    if not sublinear:
        g = tf.astype(float)
    elif tf.itemsize == 1:
        g = np.append(0.0, 1.0 + np.log(np.arange(1.0, 256.0)))[tf]
    else:
        g = 1.0 + np.log(tf.astype(float))
    return rows, g, df, np.cumsum(df) - df, np.log((1.0 + n) / (1.0 + df)) + 1.0


@dataclass
class TermBlocks:
    """The written counts of ``n`` rows numbered from 0: per row of the table the
    terms, their ``df``, and for each count its row's number and ``tf``."""
    table: DataFrame
    n: int
    sublinear: bool

    @property
    def n_terms(self) -> int:
        return self.table.agg(F.sum(F.octet_length("df"))).first()[0] // 4 if self.n and not self.table.isEmpty() else 0

    def _sum(self, vector: np.ndarray | None) -> np.ndarray:
        n, sublinear, piece = self.n, self.sublinear, PIECE
        sc = self.table.sparkSession.sparkContext
        shared = sc.broadcast(vector)

        def batch(sums):
            pieces = [(i // piece, sums[i:i + piece].tobytes()) for i in range(0, len(sums), piece)]
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pieces], pa.int32()), pa.array([p[1] for p in pieces], pa.binary())], ["piece", "sums"])

        def run(batches):
            v, out = shared.value, np.zeros(n)
            for b in batches:
                for rows, tf, df in zip(*(b.column(i) for i in range(3))):
                    at, g, df, start, idf = _counts(rows.as_buffer(), tf.as_buffer(), df.as_buffer(), n, sublinear)
                    if v is None:
                        out += np.bincount(at, np.square(g * np.repeat(idf, df)), n)
                    else:
                        coef = np.add.reduceat(g * v[at], start) * idf
                        out += np.bincount(at, g * np.repeat(coef * idf, df), n)
            yield batch(out)

        def add(batches):
            total = {}
            for b in batches:
                for k, s in zip(b.column(0).to_pylist(), b.column(1)):
                    s = np.frombuffer(s.as_buffer())
                    total[k] = total[k] + s if k in total else s
            yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([s.tobytes() for s in total.values()], pa.binary())], ["piece", "sums"])

        tasks = sc.defaultParallelism
        sums = self.table.select("rows", "tf", "df").coalesce(tasks).mapInArrow(run, "piece int, sums binary")
        if tasks * n * 8 > SUM_BYTES:
            sums = sums.repartition("piece").mapInArrow(add, "piece int, sums binary")
        out = np.zeros(n)
        for b in sums.toArrow().to_batches():
            for k, s in zip(b.column(0).to_pylist(), b.column(1)):
                out[k * piece:(k + 1) * piece] += np.frombuffer(s.as_buffer())
        shared.destroy()
        return out

    def norms(self) -> np.ndarray:
        """L2 norm of each row's TF-IDF weights (1 where it has none)."""
        norm = np.sqrt(self._sum(None))
        return np.where(norm > 0, norm, 1.0)

    def products(self, v: np.ndarray) -> np.ndarray:
        """``R R' v`` of the weights R that are not normalised."""
        return self._sum(v)

    def coefficients(self, v: np.ndarray) -> DataFrame:
        """``(term, idf, coef)`` with ``coef = R' v``."""
        n, sublinear = self.n, self.sublinear
        shared = self.table.sparkSession.sparkContext.broadcast(v)

        def run(batches):
            v = shared.value
            for b in batches:
                for rows, tf, df, terms in zip(*(b.column(i) for i in range(4))):
                    at, g, df, start, idf = _counts(rows.as_buffer(), tf.as_buffer(), df.as_buffer(), n, sublinear)
                    coef = np.add.reduceat(g * v[at], start) * idf
                    yield pa.RecordBatch.from_arrays([terms.values, pa.array(idf), pa.array(coef)], ["term", "idf", "coef"])

        return written_table(self.table.select("rows", "tf", "df", "terms").mapInArrow(run, "term string, idf double, coef double"))


def term_blocks(rows: DataFrame, id_col: str, text_col: str, n: int, chars: int, sublinear: bool,
                min_df: int = 1, max_df=None, only=None) -> TermBlocks:
    """Counts of the terms in ``min_df`` to ``max_df`` of ``n`` rows, whose ids are the numbers below ``n``."""
    hi = n if max_df is None else max_df * n if isinstance(max_df, float) else max_df
    per_row = ROW_COUNTS

    def run(batches):
        ids, terms, tfs = [], [], []
        for b in batches:
            ids.append(b.column(0).to_numpy().astype(np.int32))
            terms.append(b.column(1))
            tfs.append(b.column(2).to_numpy())
        if not ids:
            return
        held = pa.concat_arrays([t.cast(pa.large_string()) for t in terms]).dictionary_encode()
        at, tf, code = np.concatenate(ids), np.concatenate(tfs), held.indices.to_numpy()
        del ids, terms, tfs
        df = np.bincount(code, minlength=len(held.dictionary))
        kept = np.flatnonzero((df >= min_df) & (df <= hi))
        place = np.full(len(df), -1, np.int64)
        place[kept] = np.arange(len(kept))
        code = place[code]
        own = np.flatnonzero(code >= 0)
        own = own[np.lexsort((at[own], code[own]))]
        at, tf, df, words = at[own], tf[own], df[kept].astype(np.int32), held.dictionary.take(pa.array(kept))
        del held, code, own, place
        pa.default_memory_pool().release_unused()  # the worker stays for later stages
        end = np.cumsum(df)
        lo = 0
        while lo < len(df):
            first = end[lo] - df[lo]
            to = max(lo + 1, int(np.searchsorted(end, first + per_row, "right")))
            part = slice(first, end[to - 1])
            small = tf[part].astype(np.min_scalar_type(int(tf[part].max())))
            texts = words.slice(lo, to - lo).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([at[part].tobytes()], pa.binary()), pa.array([small.tobytes()], pa.binary()), pa.array([df[lo:to].tobytes()], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, to - lo], pa.int32()), texts)], ["rows", "tf", "df", "terms"])
            lo = to

    parts = max(2 * rows.sparkSession.sparkContext.defaultParallelism, math.ceil(chars / PART_CHARS))
    counts = term_counts(rows, id_col, text_col, only=only).repartition(parts, "term").select(id_col, "term", "tf")
    return TermBlocks(written_table(counts.mapInArrow(run, "rows binary, tf binary, df binary, terms array<string>")), n, sublinear)


# --------------------------------------------------------------------- solver
def _projected(v, lo, hi):
    """The point of the box whose sum is 0 nearest to ``v``."""
    a, b = float((v - hi).min()), float((v - lo).max())
    t, enough = min(max(0.0, a), b), 1e-13 * float((hi - lo).sum())
    for _ in range(200):
        z = np.clip(v - t, lo, hi)
        s = float(z.sum())
        if abs(s) <= enough:
            break
        a, b = (t, b) if s > 0 else (a, t)
        free = np.count_nonzero((z > lo) & (z < hi))
        t = t + s / free if free else a
        if not a < t < b:
            t = (a + b) / 2
    return z


def _intercept(margins, y, cost):
    """The intercept with the least hinge loss: the slope, by its breakpoints, passes 0."""
    at = y - margins
    order = np.argsort(at)
    slope = np.cumsum(cost[order]) - cost[y > 0].sum()
    return float(at[order[min(int(np.searchsorted(slope, -1e-12 * cost.sum())), len(at) - 1)]])


def solve(products, y: np.ndarray, cost: np.ndarray, max_iter: int, tol: float) -> dict:
    """Minimises ``(|w|^2 / 2 + sum cost_i max(0, 1 - y_i (w x_i + b))) / n`` with
    ``w = X' beta``, ``products(v) = X X' v``, by accelerated projected gradient steps
    (with restarts) on the dual: ``beta_i y_i`` in 0 to ``cost_i``, sum of beta 0.
    One product a step. It has converged when ten steps better the dual by no more
    than ``tol`` of it and it lies within ``100 tol`` of the objective, which
    bounds the distance to the optimum. ``objective`` is the best so far."""
    n = len(y)
    lo, hi = np.where(y > 0, 0.0, -cost), np.where(y > 0, cost, 0.0)
    beta = at = margins = at_margins = np.zeros(n)
    best = (beta, _intercept(margins, y, cost))
    momentum, bound, duals, steps = 1.0, 1.0, [], 0
    objective = [float(cost @ np.maximum(0.0, 1.0 - y * best[1])) / n]
    found = {"converged": False, "gap": math.inf}
    while steps < max_iter:
        steps += 1
        new = _projected(at - (at_margins - y) / bound, lo, hi)
        move = new - at
        moved = products(move)
        size, curve = float(move @ move), float(move @ moved)
        if curve > bound * size * (1 + 1e-9):  # too long a step
            bound = max(2 * bound, curve / size) if steps > 1 else 1.5 * curve / size
            continue
        new_margins = at_margins + moved
        if (at - new) @ (new - beta) > 0:
            momentum, along = 1.0, 0.0
        else:
            later = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
            momentum, along = later, (momentum - 1) / later
        at, at_margins = new + along * (new - beta), new_margins + along * (new_margins - margins)
        beta, margins, bound = new, new_margins, 0.95 * bound
        square = float(beta @ margins)
        b = _intercept(margins, y, cost)
        loss = (square / 2 + float(cost @ np.maximum(0.0, 1.0 - y * (margins + b)))) / n
        if loss < objective[-1]:
            best = (beta, b)
        objective.append(min(loss, objective[-1]))
        duals.append((float(y @ beta) - square / 2) / n)
        gap = (objective[-1] - max(duals)) / max(objective[-1], 1e-300)
        found["gap"] = gap
        if gap <= tol or (gap <= 100 * tol and len(duals) > 10 and max(duals) - max(duals[:-10]) <= tol * max(duals)):
            found["converged"] = True
            break
    return found | {"iterations": steps, "objective": objective, "beta": best[0], "intercept": best[1]}
