"""Vector code compression with norm-of-sum bounds (operator 11).

A vector is quantised to integers and cut into equal parts; each part position
has a codebook, trained by rounds of assignment and averaging in integers. A
part remembers its entry, an upper bound of the distance to it and a lower
bound of the distance to every other entry, each with the stamp of the round in
which it was measured. All codebooks so far are kept, so a bound of round t is
brought to round r by the entries' net displacement ||c_r - c_t||, the norm of
the summed moves, which is never more than the sum of the single moves. Only
where the bounds cross is the own entry measured again, and only where they
still cross are all entries scanned.

Bounds are stored as 32-bit floats rounded away from each other, distances are
exact integers, and a tie always leads to a scan: the codes equal those of a
full search.

Each round is one Spark job over a table in the shared folder: tasks write
their rows' new state and, per entry, the sums of the parts that changed sides.
Only these sums, one number per codebook component, reach the driver.

Cases. Vectors that are null or hold null or non-finite components are dropped.
The length is that of the smallest id whose length is a positive multiple of
``parts``; kept rows of any other length have null code and error. Fewer kept
rows than ``entries`` give as many entries. Equal or null ids are separate rows
(null last; equal ids by components where the first entries are chosen). Null
labels form one group; a group without codes has a null sum. Integers saturate
where the squared distances of a vector would leave 64 bits (|x| of 32,768 at
64 components and a scale of 4,096). An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows that a task works on at once.
CHUNK = 8192


class Codes(NamedTuple):
    """What training gives: rows (vec_id, label, code binary, error long), the
    final codebooks (parts, entries, components) and, per round, how many parts
    were compared, measured again and scanned."""

    rows: DataFrame
    codebooks: np.ndarray
    work: list[dict]


def limit(length: int) -> int:
    """Largest absolute integer whose squared distances sum to below 2^62 over a vector."""
    return math.isqrt((1 << 62) // max(length, 1)) // 2


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as integers, saturated at :func:`limit`."""
    top = limit(x.shape[-1])
    return np.clip(np.floor(x.astype(np.float64) * scale), -top, top).astype(np.int64)


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to the rows of c."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * top * top < 1 << 53:  # every intermediate is a whole double
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in c], axis=1)


class Bounds:
    """Displacements between the codebooks of all rounds so far."""

    def __init__(self, history: list[np.ndarray]):
        now = history[-1].astype(np.float64)
        #: net[t, part, entry]: how far the entry is from where it was in round t
        self.net = np.stack([np.sqrt(((now - c) ** 2).sum(-1)) for c in history]) * (1 + 1e-9)
        n = self.net.shape[-1]
        others = np.where(np.eye(n, dtype=bool), -np.inf, self.net[..., None, :])
        #: far[t, part, entry]: the largest net displacement of any other entry
        self.far = np.maximum(others.max(-1), 0.0)


def drifts(history: list[np.ndarray], since: int) -> np.ndarray:
    """The sum of the single moves since a round: what the net displacement is never above."""
    h = [c.astype(np.float64) for c in history[since:]]
    return sum((np.sqrt(((b - a) ** 2).sum(-1)) for a, b in zip(h, h[1:])), np.zeros(history[0].shape[:2]))


class State(NamedTuple):
    """Per row and part: entry, bounds and the rounds in which they were measured."""

    code: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    upper_round: np.ndarray
    lower_round: np.ndarray


def fresh(n: int, parts: int) -> State:
    return State(np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.float32), np.zeros((n, parts), np.float32),
                 np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.uint8))


def assign(x: np.ndarray, old: State | None, history: list[np.ndarray], bounds: Bounds) -> tuple[State, int, int]:
    """The state of rows x (n, parts, components) under the newest codebooks, and
    how many parts were measured again and scanned. Ties go to the lower entry."""
    n, parts, _ = x.shape
    new = fresh(n, parts) if old is None else State(*(a.copy() for a in old))
    now, again, scanned = len(history) - 1, 0, 0
    for p in range(parts):
        book = history[-1][p]
        if old is None:
            look = np.arange(n)
        else:
            a = old.code[:, p]
            up = old.upper[:, p].astype(np.float64) + bounds.net[old.upper_round[:, p], p, a]
            low = old.lower[:, p].astype(np.float64) - bounds.far[old.lower_round[:, p], p, a]
            cross = np.flatnonzero(up * (1 + 1e-9) >= low)
            own = np.sqrt(((x[cross, p] - book[a[cross]]) ** 2).sum(1).astype(np.float64))
            new.upper[cross, p] = np.nextafter(own.astype(np.float32), np.float32(np.inf))
            new.upper_round[cross, p] = now
            look = cross[own * (1 + 1e-9) >= low[cross]]
            again += len(cross)
        if len(look):
            d = squares(x[look, p], book)
            best = d.argmin(1)
            near = np.sqrt(d[np.arange(len(look)), best].astype(np.float64))
            if d.shape[1] > 1:
                rest = np.sqrt(np.partition(d, 1, axis=1)[:, 1].astype(np.float64))
            else:
                rest = np.full(len(look), np.inf)
            new.code[look, p] = best
            new.upper[look, p] = np.nextafter(near.astype(np.float32), np.float32(np.inf))
            new.lower[look, p] = np.nextafter(rest.astype(np.float32), np.float32(-np.inf))
            new.upper_round[look, p] = new.lower_round[look, p] = now
            scanned += len(look)
    return new, again, scanned


def averages(sums: np.ndarray, counts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count); entries without parts stay."""
    used = counts > 0
    return np.where(used[..., None], sums // np.maximum(counts, 1)[..., None], book)


_STATE = "_q binary, _code binary, _upper binary, _lower binary, _rounds binary"
_SUMS = "_part int, _entry int, _at int, _sum long"


def _stack(col: pa.Array, dtype, *shape) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=dtype).reshape(-1, *shape)


def _binary(a: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(a).reshape(len(a), -1)
    width = flat.shape[1] * flat.itemsize
    offsets = np.arange(len(a) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])


def _read(batch: pa.RecordBatch, parts: int, scale: int) -> tuple[np.ndarray, State | None]:
    """Rows as integers (n, parts, components), and their state if they have one."""
    if "_q" in batch.schema.names:
        get = {n: batch.column(n) for n in batch.schema.names}
        q = _stack(get["_q"], np.int32, parts, len(get["_q"][0].as_py()) // 4 // parts).astype(np.int64)
        rounds = _stack(get["_rounds"], np.uint8, 2, parts)
        return q, State(_stack(get["_code"], np.uint8, parts), _stack(get["_upper"], np.float32, parts),
                        _stack(get["_lower"], np.float32, parts), rounds[:, 0], rounds[:, 1])
    vectors = batch.column("embedding")
    x = np.asarray(vectors.flatten()).reshape(batch.num_rows, -1)
    return quantise(x, scale).reshape(batch.num_rows, parts, -1), None


def _chunks(batches):
    for b in batches:
        for at in range(0, b.num_rows, CHUNK):
            yield b.slice(at, CHUNK)


def _round(history: list[np.ndarray], parts: int, scale: int):
    """Rows to rows with state, then the task's sums per entry: of the parts that
    came to it less those that left, and three counts under part -1."""

    def run(batches):
        _, entries, width = history[0].shape
        bounds = Bounds(history)
        sums = np.zeros((parts, entries, width + 1), dtype=np.int64)  # the last place counts
        counts, types = np.zeros(3, dtype=np.int64), None
        names = ["vec_id", "label", *[f.split()[0] for f in f"{_STATE}, {_SUMS}".split(", ")]]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        for b in _chunks(batches):
            types = [b.schema.field(n).type for n in names[:2]]
            x, old = _read(b, parts, scale)
            new, again, scanned = assign(x, old, history, bounds)
            counts += [x.shape[0] * parts, again, scanned]
            one = np.ones((len(x), 1), dtype=np.int64)
            for p in range(parts):
                moved = np.arange(len(x)) if old is None else np.flatnonzero(old.code[:, p] != new.code[:, p])
                row = np.concatenate([x[moved, p], one[moved]], axis=1)
                np.add.at(sums[p], new.code[moved, p], row)
                if old is not None:
                    np.subtract.at(sums[p], old.code[moved, p], row)
            rounds = np.stack([new.upper_round, new.lower_round], axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), _binary(x.astype(np.int32)), _binary(new.code), _binary(new.upper),
                 _binary(new.lower), _binary(rounds), *[pa.nulls(len(x), k) for k in kinds]], names)
        if types is None:
            return
        at = np.argwhere(sums != 0)
        out = [np.concatenate([at[:, i], more]) for i, more in enumerate(([-1] * 3, [0] * 3, [0, 1, 2]))]
        out.append(np.concatenate([sums[tuple(at.T)], counts]))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(out[0]), t) for t in types] + [pa.nulls(len(out[0]), pa.binary()) for _ in range(5)]
            + [pa.array(o, k) for o, k in zip(out, kinds)], names)

    return run


def _final(history: list[np.ndarray], parts: int, scale: int):
    def run(batches):
        bounds = Bounds(history)
        for b in _chunks(batches):
            x, old = _read(b, parts, scale)
            code = assign(x, old, history, bounds)[0].code
            error = sum(((x[:, p] - history[-1][p][code[:, p]]) ** 2).sum(1) for p in range(parts))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), _binary(code), pa.array(error, pa.int64())],
                                             ["vec_id", "label", "code", "error"])

    return run


def train_codes(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codebooks, and every kept row of ``df`` (vec_id, embedding, label) with its code.

    ``entries`` is at most 256 and ``rounds`` at most 255: both fit a byte.
    """
    if not (1 <= entries <= 256 and 0 <= rounds <= 255 and parts >= 1):
        raise ValueError("entries must be 1 to 256, rounds 0 to 255, parts 1 or more")
    e = F.col("embedding").cast("array<double>")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = df.select("vec_id", "label", e.alias("embedding")).filter(F.col("embedding").isNotNull() & fine)
    whole = (F.size("embedding") > 0) & (F.size("embedding") % parts == 0)
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    lead = kept.filter(whole).orderBy(*order).limit(1).collect()
    kind = {f.name: f.dataType.simpleString() for f in kept.schema}
    keys = f"vec_id {kind['vec_id']}, label {kind['label']}"
    if not lead:
        return Codes(_uncoded(kept), np.zeros((parts, 0, 0), dtype=np.int64), [])
    length = len(lead[0].embedding)
    fit = kept.filter(F.size("embedding") == length)
    first = fit.orderBy(*order).limit(entries).collect()  # bounded by the size of a codebook
    start = quantise(np.array([r.embedding for r in first]), scale).reshape(len(first), parts, -1).transpose(1, 0, 2)
    history, work, state = [start], [], fit
    sums = np.zeros((parts, len(first), length // parts + 1), dtype=np.int64)
    for _ in range(rounds):
        table = materialize(state.mapInArrow(_round(history, parts, scale), f"{keys}, {_STATE}, {_SUMS}"))
        found = (table.filter("_part is not null").groupBy("_part", "_entry", "_at").agg(F.sum("_sum").alias("n")).collect())
        for r in found:
            if r._part >= 0:
                sums[r._part, r._entry, r._at] += r.n
        spent = {r._at: r.n for r in found if r._part < 0}
        work.append({"parts": spent.get(0, 0), "measured": spent.get(1, 0), "scanned": spent.get(2, 0)})
        history = [*history, averages(sums[..., :-1], sums[..., -1], history[-1])]
        state = table.filter("_part is null").select("vec_id", "label", *[f.split()[0] for f in _STATE.split(", ")])
    coded = state.mapInArrow(_final(history, parts, scale), f"{keys}, code binary, error long")
    return Codes(coded.union(_uncoded(kept.filter(F.size("embedding") != length))), history[-1], work)


def _uncoded(rows: DataFrame) -> DataFrame:
    """Kept rows whose length no codebook fits."""
    return rows.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))


def digest(codes: Codes) -> DataFrame:
    """Rows as (vec_id, code hex, error, label_error, codebooks_sha256)."""
    rows = materialize(codes.rows)
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    text = ",".join(map(str, codes.codebooks.ravel().tolist()))
    return (rows.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                    F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256")))
