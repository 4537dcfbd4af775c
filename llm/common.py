"""Shared helpers of the corpus operators: stable row keys, tables in the
shared folder, distributed components and bucket joins that never expand a
whole bucket.
"""

from __future__ import annotations

import logging
import uuid

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.session import checkpoint_dir

#: ASCII letters A-Z to a-z in UTF-8 bytes; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back:
    lineage is cut, and a lost executor only costs a reread of the table."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def with_row_key(df: DataFrame, prefix: str = "_row") -> tuple[DataFrame, list[str]]:
    """``df`` plus two columns that name each row for good: the hash of its
    file's path and its position in that file.

    Equal rows get different keys, and a task that runs again gives the same
    ones. A frame that is not read from Parquet is written to the shared
    folder first.
    """
    names = fresh(df, f"{prefix}_file", f"{prefix}_pos")

    def keyed(d):
        return d.select(*[F.col(f"`{c}`") for c in d.columns],
                        F.xxhash64(F.col("_metadata.file_path")).alias(names[0]),
                        F.col("_metadata.row_index").alias(names[1]))

    loud = logging.getLogger("DataFrameQueryContextLogger")
    was, loud.disabled = loud.disabled, True  # the question below is allowed to fail
    try:
        out = keyed(df)
        out.schema  # noqa: B018  analysis raises when there is no file metadata
    except AnalysisException:
        out = keyed(materialize(df))
    finally:
        loud.disabled = was
    return out, names


def local_components(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the nodes that are not their
    own smallest: a spanning forest of the given edges."""
    if not len(u):
        return u[:0], v[:0]
    nodes, inv = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inv[: len(u)], inv[len(u):]
    lab = np.arange(len(nodes))
    while True:
        m = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, lab[a], m)
        np.minimum.at(new, lab[b], m)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        if (new == lab).all():
            break
        lab = new
    keep = lab != np.arange(len(nodes))
    return nodes[keep], nodes[lab[keep]]


def _local_forest(batches):
    us, vs, n = [], [], 0
    for b in batches:
        us.append(b.column(0).to_numpy())
        vs.append(b.column(1).to_numpy())
        n += b.num_rows
        if n > 1_000_000:
            f = local_components(np.concatenate(us), np.concatenate(vs))
            us, vs, n = [f[0]], [f[1]], len(f[0])
    if us:
        x, y = local_components(np.concatenate(us), np.concatenate(vs))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["u", "v"])


def forest(edges: DataFrame) -> DataFrame:
    """Per-partition spanning forest of edges (u, v): fewer edges, same components."""
    return edges.select("u", "v").mapInArrow(_local_forest, "u long, v long")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges``
    (columns u, v, long).

    Large-star and small-star rounds over reliable tables; each partition first
    cuts its edges down to a spanning forest. Only two counters reach the driver
    per round.
    """
    cur = materialize(forest(edges).filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    def mark(d):
        return tuple(d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    state = mark(cur)
    while True:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour points to the smallest known node
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours point to the smallest of them
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(near, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        cur = materialize(small)
        now = mark(cur)
        if now == state:
            break
        state = now
    return (cur.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            .union(cur.select("v", "v").distinct().toDF("node", "component")))


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Start positions of runs of equal values in a sorted array, and its end."""
    if not len(keys):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def bucket_join(rows: DataFrame, key: str, columns: list[str], match, cross, schema: str, block: int = 1024) -> DataFrame:
    """Compare rows that share ``key`` without ever expanding a bucket.

    ``rows`` is dealt by key and sorted. ``match(cols, starts)`` gets whole
    small buckets, many at a time, as a dict of arrow arrays with the runs'
    start positions, and returns arrow arrays for ``schema``. A bucket of more
    than ``block`` rows is cut into blocks that a second step compares block
    against block, each pair of blocks in a task of its own, with
    ``cross(left, right, same)``. No row is left out at either step.
    """
    kinds = [f.strip().split(" ", 1) for f in schema.split(",")]
    kept = rows.select(key, *columns)
    plain = kept.schema
    hot = ", ".join(f"`_h_{f.name}` {f.dataType.simpleString()}" for f in plain)
    tagged = f"{schema}, {hot}, _h_block long"

    def typed(batches):
        outs = [_arrow(k) for _, k in kinds]
        names = [n for n, _ in kinds] + [f"_h_{f.name}" for f in plain] + ["_h_block"]
        ins, held, size = None, [], 0
        open_key, open_rows = None, 0  # a large bucket whose first rows are out already

        def found_rows(found):
            n = len(found[0])
            return pa.RecordBatch.from_arrays([_as(a, t) for a, t in zip(found, outs)]
                                              + [pa.nulls(n, t) for t in ins] + [pa.nulls(n, pa.int64())], names)

        def late_rows(t, first):
            n = t.num_rows
            return pa.RecordBatch.from_arrays([pa.nulls(n, k) for k in outs] + [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in t.columns]
                                              + [pa.array((np.arange(n) + first) // block)], names)

        def work(table, last):
            """Deal with whole buckets; the last one stays open unless ``last``."""
            nonlocal held, size, open_key, open_rows
            table = table.combine_chunks()
            keys = table.column(0).to_numpy()
            starts = run_starts(keys)
            small = np.zeros(len(keys), dtype=bool)
            held, size = [], 0
            for r in np.flatnonzero(np.diff(starts) > 1) if open_key is None else range(len(starts) - 1):
                s, e = int(starts[r]), int(starts[r + 1])
                going = r == 0 and open_key is not None and keys[0] == open_key
                if r == 0 and not going:
                    open_key, open_rows = None, 0
                ends = e < len(keys) or last
                if going or e - s > block:
                    yield late_rows(table.slice(s, e - s), open_rows if going else 0)
                    open_key, open_rows = (None, 0) if ends else (int(keys[s]), (open_rows if going else 0) + e - s)
                elif ends:
                    small[s:e] = e - s > 1
            if not last and open_key is None and len(keys):
                held, size = [table.slice(int(starts[-2]))], len(keys) - int(starts[-2])
            if small.any():
                sel = table.filter(pa.array(small)).combine_chunks()
                cols = {n: sel.column(n).chunk(0) for n in sel.column_names}
                got = match(cols, run_starts(cols[key].to_numpy()))
                if got and len(got[0]):
                    yield found_rows(got)

        for b in batches:
            ins = [f.type for f in b.schema] if ins is None else ins
            held.append(pa.Table.from_batches([b]))
            size += b.num_rows
            if size >= 131072:
                yield from work(pa.concat_tables(held), False)
        if held:
            yield from work(pa.concat_tables(held), True)

    done = materialize(kept.repartition(key).sortWithinPartitions(key, *columns[:1]).mapInArrow(typed, tagged))
    first = done.filter("_h_block is null").select(*[n for n, _ in kinds])
    late = done.filter("_h_block is not null")
    sizes = late.groupBy(F.col(f"_h_{key}").alias("_h_of")).agg(F.max("_h_block").alias("_h_last"))
    i, j = F.least("_h_block", "_h_other"), F.greatest("_h_block", "_h_other")
    cells = (late.join(sizes, late[f"_h_{key}"] == sizes["_h_of"])
             .withColumn("_h_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_h_last"))))
             .select(F.xxhash64(f"_h_{key}", i, j).alias("_h_cell"), i.alias("_h_i"), j.alias("_h_j"), "_h_block",
                     *[F.col(f"_h_{c}").alias(c) for c in (key, *columns)]))

    def cell(batches):
        outs = [_arrow(k) for _, k in kinds]
        names = [n for n, _ in kinds]
        held: list = []

        def flush(table):
            table = table.combine_chunks()
            cols = {n: (table.column(n).chunk(0)) for n in table.column_names}
            i, side = cols["_h_i"].to_numpy(), cols["_h_block"].to_numpy()
            j = cols["_h_j"].to_numpy()
            k = cols[key].to_numpy()
            # rows of one cell share the hash; a hash shared by two cells is told apart here
            for kk, ii, jj in sorted({*zip(k.tolist(), i.tolist(), j.tolist())}):
                own = (k == kk) & (i == ii) & (j == jj)
                left = np.flatnonzero(own & (side == ii))
                right = np.flatnonzero(own & (side == jj))
                got = cross({n: a.take(pa.array(left)) for n, a in cols.items()},
                            {n: a.take(pa.array(right)) for n, a in cols.items()}, ii == jj)
                if got and len(got[0]):
                    yield pa.RecordBatch.from_arrays([_as(a, t) for a, t in zip(got, outs)], names)

        for b in batches:
            held.append(pa.Table.from_batches([b]))
            t = pa.concat_tables(held).combine_chunks()
            starts = run_starts(t.column(0).to_numpy())
            if len(starts) > 2:
                for s, e in zip(starts[:-2], starts[1:-1]):
                    yield from flush(t.slice(int(s), int(e - s)))
                t = t.slice(int(starts[-2]))
            held = [t]
        if held and held[0].num_rows:
            t = held[0].combine_chunks()
            starts = run_starts(t.column(0).to_numpy())
            for s, e in zip(starts[:-1], starts[1:]):
                yield from flush(t.slice(int(s), int(e - s)))

    second = (cells.repartition("_h_cell").sortWithinPartitions("_h_cell").mapInArrow(cell, schema))
    return first.union(second)


def _as(a, kind: pa.DataType) -> pa.Array:
    return a.cast(kind) if isinstance(a, pa.Array) else pa.array(a, kind)


def _arrow(kind: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
            "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}[kind.strip()]
