"""SimHash near-dedup by Golay-code fuzzy keys (operator 6).

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each
read as a word of the perfect binary Golay code [23, 12, 7]. Every 23-bit word
lies within 3 errors of one codeword; a word 3 errors away also lies 4 errors
away from five others. The indices of those one or six codewords are the
segment's keys, and two words that differ in at most 2 bits always share one.
When two fingerprints differ in at most 5 bits, at most one segment holds 3 or
more of them, so some pair of segments shares a key on both sides: fingerprints
are joined on pairs of segment keys and verified bit by bit.

Cases: null or word-free texts have fingerprint zero and link like any other;
fewer words than the shingle length make one shingle; equal fingerprints
collapse to one node before the join, so copies are never paired; null ids
never become a component's name unless all ids of it are null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bucket_join, connected_components, local_components, materialize, with_row_key

#: Fixed value: generator polynomial of the binary Golay code [23, 12, 7].
GOLAY = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Largest bit distance that the segment keys cover.
MAX_BITS = 5
#: Shingles hashed at a time, so that a very long text needs bounded memory.
CHUNK = 65536


def _remainders() -> np.ndarray:
    """Remainder of x**i modulo the generator, for the 23 bits of a word."""
    out, r = [], 1
    for _ in range(23):
        out.append(r)
        r <<= 1
        if r >> 11:
            r ^= GOLAY
    return np.array(out, dtype=np.uint32)


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of each byte at each of three byte places, six error patterns
    of each syndrome; the same pattern six times where one codeword is near)."""
    rem = _remainders()
    syndrome = np.zeros((3, 256), dtype=np.uint32)
    for place in range(3):
        for bit in range(8):
            i = 8 * place + bit
            if i < 23:
                syndrome[place] ^= np.where(np.arange(256) >> bit & 1, rem[i], 0).astype(np.uint32)
    errors = np.zeros((2048, 6), dtype=np.uint32)
    filled = np.zeros(2048, dtype=np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = 0
            for b in bits:
                s ^= int(rem[b])
            pattern = sum(1 << b for b in bits)
            if weight <= 3:
                errors[s] = pattern
                filled[s] = 1 if weight == 3 else 6
            elif filled[s] < 6:
                errors[s, filled[s]] = pattern
                filled[s] += 1
    return syndrome, errors


_TABLES: list = []


def segment_keys(words: np.ndarray) -> np.ndarray:
    """Codeword indices (12 bits) near each 23-bit word: six columns, equal ones repeated."""
    if not _TABLES:
        _TABLES.append(golay_tables())
    syndrome, errors = _TABLES[0]
    w = words.astype(np.uint32)
    s = syndrome[0][w & 255] ^ syndrome[1][w >> 8 & 255] ^ syndrome[2][w >> 16 & 255]
    return (w[:, None] ^ errors[s]) >> 11


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of a whole text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        h = np.array([digest(joined[s:e], 42) for s, e in zip(starts[at: at + CHUNK], ends[at: at + CHUNK])], dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.flatnonzero(2 * ones > len(starts))
    return int(sum(1 << int(b) for b in bits))


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, keep: list[str] = ()) -> DataFrame:
    """``keep`` columns and ``_fp`` (the fingerprint's 64 bits as a signed long)."""
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text"))
    names = [*keep, "_fp"]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "_fp long"])

    def run(batches):
        for b in batches:
            t = b.column(b.num_columns - 1)
            fp = np.array([fingerprint(x.as_py(), shingle) for x in t], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp, pa.int64())], names)

    return source.mapInArrow(run, schema)


def _explode_keys(batches):
    for b in batches:
        for at in range(0, b.num_rows, 20000):
            fp = b.column(0).slice(at, 20000).to_numpy()
            u = fp.view(np.uint64)
            keys = [segment_keys((u >> np.uint64(lo)) & np.uint64((1 << n) - 1)) for lo, n in SEGMENTS]
            for p, (i, j) in enumerate(combinations(range(3), 2)):
                k = (keys[i][:, :, None].astype(np.int64) << 12 | keys[j][:, None, :]).reshape(len(fp), 36) | p << 24
                k.sort(axis=1)
                new = np.ones(k.shape, dtype=bool)
                new[:, 1:] = k[:, 1:] != k[:, :-1]
                row = np.broadcast_to(np.arange(len(fp))[:, None], k.shape)[new]
                yield pa.RecordBatch.from_arrays([pa.array(k[new], pa.int64()), pa.array(fp[row], pa.int64())], ["k", "fp"])


def _star(a, b):
    n, r = local_components(a, b)
    return [pa.array(n, pa.int64()), pa.array(r, pa.int64())]


def simhash_edges(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges (u, v) that connect all fingerprints of column ``_fp`` (distinct)
    within ``max_bits`` bits; per bucket only a spanning forest comes out."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")

    def match(cols, starts):
        fp = cols["fp"].to_numpy()
        run = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        u = fp.view(np.uint64)
        at, step, a, b = np.arange(len(fp)), 1, [], []
        while True:
            at = at[at + step < len(fp)]
            at = at[run[at + step] == run[at]]
            if not len(at):
                break
            near = at[np.bitwise_count(u[at] ^ u[at + step]) <= max_bits]
            a.append(fp[near])
            b.append(fp[near + step])
            step += 1
        return _star(np.concatenate(a), np.concatenate(b)) if a else None

    def cross(left, right, same):
        x, y = left["fp"].to_numpy(), right["fp"].to_numpy()
        i, j = np.nonzero(np.bitwise_count(x.view(np.uint64)[:, None] ^ y.view(np.uint64)[None, :]) <= max_bits)
        return _star(x[i], y[j])

    keyed = prints.select("_fp").mapInArrow(_explode_keys, "k long, fp long")
    return bucket_join(keyed, "k", ["fp"], match, cross, "u long, v long")


def simhash_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4,
                    max_bits: int = 4, keep: list[str] = ()) -> DataFrame:
    """Per row: ``doc_id``, ``keep`` columns, ``_fp``, ``component_id`` (the smallest
    id reachable through fingerprints within ``max_bits`` bits) and ``_root``
    (the component, also where all its ids are null)."""
    names = list(dict.fromkeys([doc_id, *keep]))
    rows = materialize(fingerprints(docs, text, shingle, names))
    prints = materialize(rows.groupBy("_fp").agg(F.min(F.col(f"`{doc_id}`")).alias("_least")))
    comp = connected_components(simhash_edges(prints, max_bits))
    named = prints.join(comp, prints["_fp"] == comp["node"], "left").select(
        "_fp", "_least", F.coalesce("component", "_fp").alias("_root"))
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    ids = named.join(least, "_root").select(F.col("_fp").alias("_of"), "_root", "component_id")
    return rows.join(ids, rows["_fp"] == ids["_of"]).drop("_of")


def simhash_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id
    (of rows that share it, the first by place in the input)."""
    keyed, keys = with_row_key(docs)
    rows = simhash_classes(keyed, text, doc_id, shingle, max_bits, keys)
    first = F.struct(F.col(f"`{doc_id}`").isNull(), F.col(f"`{doc_id}`"), *keys)
    best = rows.groupBy("_root").agg(F.min(first).alias("_b"))
    return keyed.join(best.select(*[F.col(f"_b.{k}") for k in keys]), keys, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
