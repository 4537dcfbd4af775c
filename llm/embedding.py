"""Embedding near-dedup with a pivot-permutation index (operator 4).

``PIVOTS_PER_ROOT`` times the square root of n of the distinct vectors are
pivots (chosen by hash, no two close to each other; their number, and so what
tasks are sent, grows with the root of the input only). A vector is described by its nearest pivots:
``NEAREST`` of them up to ``BASE_PIVOTS`` pivots and ``MORE`` for each doubling of these, since
two linked vectors share fewer of a fixed number the denser the pivots are. Two vectors are candidates when they share at least ``SHARED`` of
them, so they meet in an inverted list of one of all but their SHARED - 1
most frequent pivots; in the first such list pairs are verified by cosine in
double precision (after a product in single precision with room for its
rounding) and their shared pivots counted. The list of a pivot with more than
``LONGEST`` holders is dealt by the second shared pivot too, so lists do not
grow with the input; those still longer are cut into blocks that meet pair by
pair in tasks of their own. A list gives each vector's number of links and a
spanning forest of the links, never the pairs.

Equal vectors are one node with a count. Recall is measured in the tests; links
found are exact.

Cases: a vector that is null, empty, zero, or holds null or non-finite numbers
links with nothing and is kept; vectors of different lengths never link; equal
ids are separate rows; a null id's own component is null where no other id is
reachable; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_join, connected_components, local_components, materialize

PIVOTS_PER_ROOT = 2.0
NEAREST = 8
SHARED = 3
BASE_PIVOTS = 128
MORE = 1.5
#: Times as many vectors are offered as pivots; those near another pivot are passed over.
SPARE = 4
#: Holders of a pivot from which on its list is dealt by a second pivot too, and rows of a block.
LONGEST = 4096
#: Rows compared with a list at a time, and pairs verified at a time.
STRIPE, PAIRS = 256, 16384


def _vectors(column: pa.Array) -> list[bytes | None]:
    """Each usable vector's doubles as bytes (negative zero as zero), else None."""
    out = []
    lists = column if isinstance(column, pa.ListArray) else column.cast(pa.list_(column.type.value_type))
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes nan
    offs = lists.offsets.to_numpy()
    for i, ok in enumerate(lists.is_valid().to_numpy(zero_copy_only=False)):
        x = flat[offs[i]: offs[i + 1]] + 0.0
        out.append(x.tobytes() if ok and len(x) and np.isfinite(x).all() and x.any() else None)
    return out


def nearest_pivots(pivots: int, nearest: int = NEAREST) -> int:
    """How many pivots describe a vector, so that recall holds as the pivots grow."""
    return nearest + int(np.ceil(MORE * np.log2(max(1.0, pivots / BASE_PIVOTS))))


def _unit(raw, kind=np.float64) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _apart(x: np.ndarray, most: int, limit: float) -> np.ndarray:
    """The first ``most`` rows of which no two have a cosine above ``limit``: pivots
    that crowd in one group of near copies would be ordered by chance."""
    kept, n = np.empty((min(most, len(x)), x.shape[1])), 0
    for v in x:
        if not n or (kept[:n] @ v).max() <= limit:
            kept[n] = v
            n += 1
            if n >= most:
                break
    return kept[:n]


def link_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9,
                 nearest: int = NEAREST, shared: int = SHARED, pivots_per_root: float = PIVOTS_PER_ROOT, longest: int = LONGEST) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    kind = vectors.schema[embedding].dataType.simpleString()
    if not kind.startswith("array"):
        raise ValueError("embedding must be an array of numbers")
    sent = np.float32 if kind == "array<float>" else np.float64  # what lists hold of a vector; nothing is rounded

    def clean(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_vectors(b.column(1)), pa.binary())], ["vec_id", "raw"])

    rows = materialize(vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e"))
                       .mapInArrow(clean, "vec_id long, raw binary"))
    nodes = materialize(rows.filter("raw is not null").groupBy("raw").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
                        .withColumn("node", F.monotonically_increasing_id()))
    total = nodes.count()
    chosen = int(np.ceil(pivots_per_root * np.sqrt(total)))
    nearest = nearest_pivots(chosen, nearest)
    # by hash, so a rerun chooses the same; each length of vector has pivots of its own
    share = min(1.0, SPARE * chosen / max(1, total))
    offered = [r.raw for r in nodes.filter(F.pmod(F.xxhash64("raw"), F.lit(1 << 32)) < int(share * (1 << 32)))
               .select("raw").orderBy(F.xxhash64("raw"), "raw").collect()]
    by_size: dict[int, np.ndarray] = {}
    for size in {len(r) for r in offered}:
        by_size[size] = _apart(_unit([r for r in offered if len(r) == size]), chosen, threshold - 0.1)

    def sign(batches):
        for b in batches:
            raw = b.column(b.schema.get_field_index("raw")).to_pylist()
            got: list = [None] * len(raw)
            for size in {len(r) for r in raw}:
                at = [i for i, r in enumerate(raw) if len(r) == size]
                piv = by_size.get(size)
                if piv is None:
                    sig = np.zeros((len(at), 1), dtype=np.int32)  # no pivot of this length: one list for all
                else:
                    far = -(_unit([raw[i] for i in at]) @ piv.T)
                    k = min(nearest, len(piv))
                    sig = np.argpartition(far, k - 1, axis=1)[:, :k].astype(np.int32)
                for i, s in zip(at, sig):
                    got[i] = s.tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.list_(pa.int32()))], ["node", "n", "raw", "near"])

    signed = materialize(nodes.select("node", "n", "raw").mapInArrow(sign, "node long, n long, raw binary, near array<int>"))
    sizes = {(r.size, r.p): r["count"] for r in signed.select(F.length("raw").alias("size"), F.explode("near").alias("p")).groupBy("size", "p").count().collect()}
    rank = {}  # rarest list first; one number for each length and pivot
    for i, k in enumerate(sorted(sizes, key=lambda k: (sizes[k], k))):
        rank[k] = i
    long_from = next((i for i, k in enumerate(sorted(sizes, key=lambda k: (sizes[k], k))) if sizes[k] > longest), len(rank))

    def keys(rs: list[int]) -> list[int]:
        """Lists of a vector with these ranks: its first pivot shared with another is
        one of all but the last ``shared`` - 1, the second of all but ``shared`` - 2."""
        need = min(shared, len(rs))
        one, two = rs[: max(1, len(rs) - need + 1)], rs[: len(rs) - need + 2]
        if need < 2:
            return one
        return [k for i, p in enumerate(one) for k in ([p] if p < long_from else [(p + 1 << 32) + q for q in two[i + 1:]])]

    def lists(batches):
        for b in batches:
            raw, near = b.column(2).to_pylist(), b.column(3).to_pylist()
            ranks = [sorted(rank[(len(r), p)] for p in ps) for r, ps in zip(raw, near)]
            own = [keys(rs) for rs in ranks]
            take = pa.array(np.repeat(np.arange(len(own)), [len(k) for k in own]))
            sig = pa.array([np.array(rs, np.int32).tobytes() for rs in ranks], pa.binary())
            raw = pa.array([np.frombuffer(r, np.float64).astype(sent).tobytes() for r in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x for k in own for x in k], pa.int64()), *[c.take(take) for c in (b.column(0), b.column(1), raw, sig)]],
                                             ["list", "node", "n", "raw", "sig"])

    def load(cols):
        x = _unit(cols["raw"].to_pylist(), sent)
        sig = np.frombuffer(b"".join(cols["sig"].to_pylist()), np.int32).reshape(len(x), -1)  # all of a list have as many pivots
        return cols["node"].to_numpy(), cols["n"].to_numpy(), x, x.astype(np.float32), sig

    def compare(key, left, right, same):
        """(left row, right row) of verified pairs that meet in this list first."""
        _, _, x, small_x, sig_x = left
        _, _, y, small_y, sig_y = right
        p, q = (key >> 32) - 1 if key >> 32 else key, key & 0xFFFFFFFF
        need = min(shared, sig_x.shape[1])
        low = np.float32(threshold - 1e-5 - x.shape[1] * 2.0 ** -22)  # no link is lost by rounding
        ii, jj = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(x), STRIPE):
            begin = at if same else 0  # pairs of a stripe with earlier rows were met there
            i, j = np.nonzero(small_x[at: at + STRIPE] @ small_y[begin:].T >= low)
            i, j = i + at, j + begin
            if same:
                i, j = i[i < j], j[i < j]
            for c in range(0, len(i), PAIRS):
                a, b = i[c: c + PAIRS], j[c: c + PAIRS]
                ok = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
                a, b = a[ok], b[ok]
                if not len(a):
                    continue
                hit = np.zeros((len(a), sig_x.shape[1]), dtype=bool)
                of_a, of_b = sig_x[a], sig_y[b]
                for k in range(sig_y.shape[1]):
                    hit |= of_a == of_b[:, k, None]
                ok = hit.sum(1) >= need
                row, first = np.arange(len(a)), hit.argmax(1)
                ok &= of_a[row, first] == p
                if key >> 32:
                    hit[row, first] = False
                    ok &= of_a[row, hit.argmax(1)] == q
                ii.append(a[ok])
                jj.append(b[ok])
        return np.concatenate(ii), np.concatenate(jj)

    def result(us, vs, ws):
        """Number of links per node (v is -1) and forest edges (w is 0)."""
        u, v, (mu, mw) = np.concatenate(us), np.concatenate(vs), (np.concatenate(ws[0]), np.concatenate(ws[1]))
        nodes_, inv = np.unique(mu, return_inverse=True)
        links = np.bincount(inv, mw, len(nodes_)).astype(np.int64) if len(mu) else np.zeros(0, np.int64)
        a, b = local_components(u, v)
        return [pa.array(np.concatenate([nodes_, a]), pa.int64()), pa.array(np.concatenate([np.full(len(nodes_), -1), b]), pa.int64()),
                pa.array(np.concatenate([links, np.zeros(len(a), np.int64)]), pa.int64())]

    def match(cols, starts):
        us, vs, wu, wn = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        keys = cols["list"].to_numpy()
        for s, e in zip(starts[:-1], starts[1:]):
            own = load({k: c.slice(int(s), int(e - s)) for k, c in cols.items()})
            i, j = compare(int(keys[s]), own, own, True)
            a, b = own[0][i], own[0][j]
            us.append(a), vs.append(b), wu.extend([a, b]), wn.extend([own[1][j], own[1][i]])
        return result(us, vs, (wu, wn))

    def cross(left, right, same):
        a_, b_ = load(left), load(right)
        i, j = compare(int(left["list"][0].as_py()) if len(left["list"]) else 0, a_, b_, same)
        a, b = a_[0][i], b_[0][j]
        return result([a], [b], ([a, b], [b_[1][j], a_[1][i]]))

    entries = signed.mapInArrow(lists, "list long, node long, n long, raw binary, sig binary")
    found = materialize(bucket_join(entries, "list", ["node", "n", "raw", "sig"], match, cross, "u long, v long, w long", block=longest))
    links = found.filter("v = -1").groupBy(F.col("u").alias("node")).agg(F.sum("w").alias("more"))
    comp = connected_components(found.filter("v <> -1")).withColumnRenamed("component", "root")
    named = (nodes.join(links, "node", "left").join(comp, "node", "left")
             .select("raw", "least", F.coalesce("root", "node").alias("root"), (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    node = named.join(least, "root").select(F.col("raw").alias("_raw"), "n_links", "component_id")
    joined = rows.filter("raw is not null").join(node, F.col("raw") == F.col("_raw")).select("vec_id", "n_links", "component_id")
    alone = rows.filter("raw is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
