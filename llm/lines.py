"""Line dedup by a segment-partition edit join (operator 10).

A line (between line feeds, white space at its ends ignored) of at least
``min_words`` words is dropped when the same line, or one within ``max_edits``
edits and with 1 - edits / length of at least ``similarity``, occurs earlier in
the table (by id, null last, then place in the input, then line number). All
other lines, short ones among them, stay as they are.

Equal lines meet by a 128-bit hash. For the edit join every line is cut into
``max_edits`` + 1 segments: whoever is within ``max_edits`` edits of it holds one
of them unchanged, near the same place. Lines are dealt by (length, segment
number, segment) and probed with the substrings that the multi-match-aware
windows allow for each length that is in reach. Only buckets of several lines
go on, and only their lines' texts are moved (a bitmap of fixed size tells
tasks which may be needed; the join that follows is exact). In a bucket, lines
are verified in order with an edit automaton of 2 * max_edits + 1 bits a row,
until one earlier line is near; long buckets are cut into blocks.

Cases: null text stays null, with no lines; a text may lose all its lines and
becomes empty, its row stays; equal ids are separate rows; an empty table gives
an empty result; further columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_join, fresh, materialize, run_starts, with_row_key

#: Edits at any length; from 10 characters on this binds and SIMILARITY does not (README: what that leaves).
MAX_EDITS = 2
SIMILARITY = 0.8
MIN_WORDS = 5
#: Lines of so many characters count whatever their words: text without spaces, long addresses.
MIN_CHARS = 20
#: Bits of the bitmap that tells which lines' texts are needed (8 MB).
BITMAP = 1 << 26
#: Lines that a task remembers so as not to pass their segments on twice.
MEMORY = 1_000_000
SPACE = " \t\n\x0b\x0c\r"


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of near-equal parts, the longer ones last."""
    small, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        n = small + (i >= parts - longer)
        out.append((at, n))
        at += n
    return out


def windows(length: int, max_edits: int) -> list[tuple[int, int, int, int]]:
    """(other length, segment number, start, segment length) of the substrings of a
    line of ``length`` that can equal a segment of a line no longer than it."""
    out = []
    for other in range(max(max_edits + 1, length - max_edits), length + 1):
        shift = length - other
        for i, (p, n) in enumerate(segments(other, max_edits + 1)):
            lo = max(p - i, p + shift - (max_edits - i), 0)
            hi = min(p + i, p + shift + (max_edits - i), length - n)
            out += [(other, i, s, n) for s in range(lo, hi + 1) if shift or s != p]
    return out


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def edits_within(a: str, b: str, most: int) -> int | None:
    """Edit distance if at most ``most``, else None: an automaton with a row of bits
    per number of errors, one bit for each diagonal of the band."""
    if abs(len(a) - len(b)) > most:
        return None
    n = common(a, b)
    a, b = a[n:], b[n:]
    n = common(a[::-1], b[::-1])
    a, b = a[: len(a) - n], b[: len(b) - n]
    if not a or not b:
        d = max(len(a), len(b))
        return d if d <= most else None
    band = (1 << (2 * most + 1)) - 1
    rows = [0] * (most + 1)
    rows[0] = 1 << most  # diagonal 0 at bit `most`
    for d in range(1, most + 1):
        rows[d] = rows[d - 1] | (rows[d - 1] << 1 & band)
    for i, c in enumerate(a):
        same, inside = 0, 0
        for k in range(2 * most + 1):
            j = i + k - most
            if 0 <= j < len(b):
                inside |= 1 << k
                if b[j] == c:
                    same |= 1 << k
        old, rows = rows, [0] * (most + 1)
        rows[0] = old[0] & same
        for d in range(1, most + 1):
            # match, replace, drop a letter of a, take a letter of b
            rows[d] = (old[d] & same) | (old[d - 1] & inside) | (old[d - 1] >> 1) | (rows[d - 1] << 1 & band)
        if not any(rows):
            return None
    end = len(b) - len(a) + most
    return next((d for d in range(most + 1) if rows[d] >> end & 1), None)


def near(a: str, b: str, max_edits: int, similarity: float) -> bool:
    most = min(max_edits, int((1 - similarity) * max(len(a), len(b)) + 1e-9))
    return edits_within(a, b, most) is not None


def _lines(text: str | None, min_words: int, min_chars: int = MIN_CHARS):
    """(number, line without white space at its ends) of the lines that count: those
    of ``min_words`` words, and those of ``min_chars`` characters in any script."""
    for i, line in enumerate((text or "").split("\n")):
        line = line.strip(SPACE)
        if line and (len(line) >= min_chars or len(line.encode("utf-8", "surrogatepass").split(None, min_words - 1)) >= min_words):
            yield i, line


def _name(line: str) -> tuple[int, int]:
    """128-bit hash as two signed longs; the lowest bit of the first is free."""
    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    a, b = h >> 64, h & (1 << 64) - 1
    return (a - (1 << 64) if a >> 63 else a) & ~1, b - (1 << 64) if b >> 63 else b


ORDER = ["o_null", "o_id", "o_file", "o_pos"]


def duplicate_lines(keyed: DataFrame, keys: list[str], text: str, doc_id: str, max_edits: int = MAX_EDITS,
                    similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """(keys, line): the lines to drop, for rows with a row key."""
    source = keyed.select(F.col(f"`{doc_id}`").isNull().cast("int").alias("o_null"), F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(0)).alias("o_id"),
                          F.col(keys[0]).alias("o_file"), F.col(keys[1]).alias("o_pos"), F.col(f"`{text}`").cast("string").alias("text"))

    def named(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                row, line, h1, h2 = [], [], [], []
                for r, t in enumerate(part.column(4)):
                    for i, x in _lines(t.as_py(), min_words):
                        a, c = _name(x)
                        row.append(r), line.append(i), h1.append(a), h2.append(c)
                if row:
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays([*[c.take(at) for c in part.columns[:4]], pa.array(line, pa.int32()), pa.array(h1, pa.int64()),
                                                      pa.array(h2, pa.int64())], [*ORDER, "line", "h1", "h2"])

    occur = materialize(source.mapInArrow(named, "o_null int, o_id long, o_file long, o_pos long, line int, h1 long, h2 long"))
    place = F.struct(*ORDER, "line")
    firsts = materialize(occur.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")))

    def dealt(batches):
        seen: set = set()
        cache: dict = {}
        for b in batches:
            key, ids = [], []

            def out():
                got = pa.RecordBatch.from_arrays([pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(ids, pa.int64())], ["key", "id"])
                key.clear(), ids.clear()
                return got

            for t in b.column(4):
                for _, x in _lines(t.as_py(), min_words):
                    a, c = _name(x)
                    n = len(x)
                    if (a, c) in seen or n <= max_edits:
                        continue
                    if len(seen) >= MEMORY:
                        seen.clear()
                    seen.add((a, c))
                    plan = cache.get(n)
                    if plan is None:
                        own = [(n, i, s, k) for i, (s, k) in enumerate(segments(n, max_edits + 1))]
                        plan = cache[n] = (own, windows(n, max_edits))
                    for kind, spots in enumerate(plan):
                        for other, i, s, k in spots:
                            key.append(xxhash.xxh64_intdigest(x[s: s + k].encode("utf-8", "surrogatepass"), other << 8 | i))
                        ids.extend([a | kind] * len(spots))
                if len(key) > 200_000:
                    yield out()
            if key:
                yield out()

    def crowded(batches):
        """Rows of buckets with a segment (even id) and more than one line."""
        held: list = []

        def work(t, last):
            t = t.combine_chunks()
            k, i = t.column(0).to_numpy(), t.column(1).to_numpy()
            starts = run_starts(k)
            end = len(k) if last else int(starts[-2])
            at = starts[:-1][starts[:-1] < end]
            if len(at):
                line = i[:end] & ~1
                keep = (np.minimum.reduceat(line, at) < np.maximum.reduceat(line, at)) & (np.minimum.reduceat(i[:end] & 1, at) == 0)
                sel = np.repeat(keep, np.diff(np.append(at, end)))
                kk, ll = k[:end][sel], line[sel]
                if len(kk):
                    new = np.ones(len(kk), dtype=bool)
                    new[1:] = (kk[1:] != kk[:-1]) | (ll[1:] != ll[:-1])  # sorted by key, then id
                    yield pa.RecordBatch.from_arrays([pa.array(kk[new]), pa.array(ll[new])], ["key", "id"])
            held[:] = [t.slice(end)]

        size = 0
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            size += b.num_rows
            if size >= 262144:
                yield from work(pa.concat_tables(held), False)
                size = 0  # an open bucket is looked at again only after as many new rows
        if held:
            yield from work(pa.concat_tables(held), True)

    wanted = materialize(source.mapInArrow(dealt, "key long, id long").repartition("key").sortWithinPartitions("key", "id")
                         .mapInArrow(crowded, "key long, id long"))
    bit = F.shiftright("id", 20).bitwiseAND(F.lit(BITMAP - 1))  # the id is a hash already
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("b", F.lit(64)).cast("int"))
    words = wanted.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(one).alias("bits")).toArrow()
    bitmap = np.zeros(BITMAP // 64, dtype=np.int64)
    bitmap[words.column("w").to_numpy()] = words.column("bits").to_numpy()

    # the lines that are needed, with the places of their first occurrences
    need = materialize(wanted.select("id").distinct().join(firsts.select("h1", "h2", "first.*"), F.col("id") == F.col("h1")).drop("id"))

    def texts(batches):
        seen: set = set()
        for b in batches:
            names, got = [], []
            for t in b.column(0):
                own = [(*_name(x), x) for _, x in _lines(t.as_py(), min_words)]
                if own:
                    at = np.array([h for h, _, _ in own], np.int64) >> 20 & (BITMAP - 1)
                    for hit in np.flatnonzero(bitmap[at >> 6] >> (at & 63) & 1):
                        a, c, x = own[hit]
                        if (a, c) not in seen:
                            if len(seen) >= MEMORY:
                                seen.clear()
                            seen.add((a, c))
                            names.append((a, c)), got.append(x)
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in names], pa.int64()), pa.array([c for _, c in names], pa.int64()),
                                                  pa.array(got, pa.string())], ["h1", "h2", "text"])

    # a line that several tasks hold comes once from each
    fetched = source.select("text").mapInArrow(texts, "h1 long, h2 long, text string").dropDuplicates(["h1", "h2"])
    full = need.join(fetched, ["h1", "h2"])
    bucket = wanted.join(full, F.col("id") == F.col("h1")).select("key", *ORDER, "line", "h1", "h2", "text")
    names = [*ORDER, "line"]

    def load(cols):
        got = list(zip(*[cols[n].to_pylist() for n in names], cols["text"].to_pylist(), cols["h1"].to_pylist(), cols["h2"].to_pylist()))
        got.sort()
        return got

    def drop(found):
        return [pa.array([x[6] for x in found], pa.int64()), pa.array([x[7] for x in found], pa.int64())]

    def match(cols, starts):
        found = []
        for s, e in zip(starts[:-1], starts[1:]):
            own = load({n: c.slice(int(s), int(e - s)) for n, c in cols.items()})
            found += [x for i, x in enumerate(own) if any(near(x[5], y[5], max_edits, similarity) for y in own[:i])]
        return drop(found)

    def cross(left, right, same):
        a, b = load(left), load(right)
        both = sorted([*((x, 0) for x in a), *((x, 1) for x in b)]) if not same else [(x, 0) for x in a]
        found, before = [], ([], [])
        for x, side in both:
            if any(near(x[5], y[5], max_edits, similarity) for y in (before[0] if same else before[1 - side])):
                found.append(x)
            before[side].append(x)
        return drop(found)

    late = bucket_join(bucket, "key", [*ORDER, "line", "h1", "h2", "text"], match, cross, "h1 long, h2 long").distinct()
    bad = materialize(firsts.join(late.withColumn("late", F.lit(True)), ["h1", "h2"], "left").filter("n > 1 or late")
           .select("h1", "h2", F.col("first"), F.coalesce("late", F.lit(False)).alias("late")))  # a table, so that a hot line's join can be split
    return (occur.join(bad, ["h1", "h2"]).filter(F.col("late") | (place != F.col("first")))
            .select(F.col("o_file").alias(keys[0]), F.col("o_pos").alias(keys[1]), "line"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_edits: int = MAX_EDITS,
                similarity: float = SIMILARITY, min_words: int = MIN_WORDS, report: bool = False) -> DataFrame:
    """``docs`` with ``text`` less its duplicate lines; with ``report`` also
    ``n_lines`` and ``dropped_lines`` (numbers from 0, ascending) after the columns."""
    keyed, keys = with_row_key(docs)
    gone = duplicate_lines(keyed, keys, text, doc_id, max_edits, similarity, min_words)
    (lost,) = fresh(keyed, "_gone")
    per = gone.groupBy(*keys).agg(F.sort_array(F.collect_list("line")).alias(lost))
    both = keyed.join(per, keys, "left")
    parts = F.split(F.col(f"`{text}`").cast("string"), "\n", -1)
    kept = F.when(F.col(lost).isNull(), F.col(f"`{text}`")).otherwise(
        F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col(lost), i)), "\n"))
    out = [kept.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if report:
        out += [F.coalesce(F.size(parts), F.lit(0)).alias("n_lines"), F.coalesce(lost, F.array().cast("array<int>")).alias("dropped_lines")]
    return both.select(*out)
