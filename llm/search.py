"""Ranked lexical search over bit-sliced Bloom signatures (operator 13).

A document's signature is a Bloom filter of its terms, each with the steps that
its number of occurrences reaches (1, 2, 3, 4, 6, 8, 12, ...). Documents with
about as many entries share a block, and a block is kept by slices: for every
bit of the filter one bitmap with a bit per document. The bitmaps of a term's
bits, anded, say which documents may hold the term that often. They err on one
side only, so the sum of the terms' largest possible shares of the score at the
highest step that a document may have reached is never below the true score.

A search takes three passes. The blocks give each item's documents of highest
bound, and their exact scores a threshold: the item's k-th best score is not
below it. The blocks then give every document whose bound reaches the threshold;
all others are provably outside the ranking. These documents are read again and
scored exactly. Nothing else is left out, and a low threshold only means more
exact scores.

Score: n counts a document's terms, N the documents with a term, L all their
terms, df a term's documents. w = floor(1000 ln((2N + 2) / (2df + 1))); m =
100 - 75 + (75 n N) div L; a term that occurs tf times gives
w ((10^9 tf) div (1000 tf + 8 m)), added for every repeat of it in the item.

The items are taken in blocks of bounded size, and only these blocks, the
thresholds and three corpus counts reach the driver.

Cases. Null or empty texts have no terms: such documents are never ranked, such
items have no rows. Equal or null ids are separate documents and items; equal
scores go by id (null last), then by the row's place. Very long texts get a
block of few documents. Empty tables give an empty result; further columns are
ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, with_row_key

#: Bits of an entry, and the least filter bits per entry.
HASHES, PER_ENTRY = 4, 8
#: Bits of a block (filter bits times documents), and documents of a block.
BLOCK, DOCUMENTS = 1 << 22, 4096
#: Terms that a task counts before it sends its counts on.
COUNTED = 1 << 17
#: Documents of highest bound, per item, whose exact scores set the threshold.
FIRST = 32
#: Items, and terms of items, that one search pass takes.
ITEMS, ITEM_TERMS = 512, 1 << 17
#: Terms times documents looked at together.
CELLS = 1 << 19

#: Bytes to lower-case terms and spaces: ASCII letters and digits and every other character from U+0080 on stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Index(NamedTuple):
    """Blocks of slices, (term, df) counts, the documents with their row keys,
    and how many documents have a term and how many terms these have."""

    blocks: DataFrame
    terms: DataFrame
    docs: DataFrame
    n_docs: int
    n_terms: int


def terms_of(text: str | None) -> Counter:
    """The terms of a text, as bytes, with how often each occurs."""
    return Counter((text or "").encode().translate(FOLD).split())


def step(at: int) -> int:
    """The least number of occurrences of a step: 1, 2, 3, 4, 6, 8, 12, 16, ..."""
    if at == 0:
        return 1
    return 2 << (at // 2) if at % 2 else 3 << (at // 2 - 1)


def steps_below(n: int) -> int:
    """How many steps n occurrences reach."""
    at = 0
    while step(at) <= n:
        at += 1
    return at


def hashed(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term)


def bits(terms: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """(HASHES, n) filter bits of terms (hashes) with steps, for a power-of-two width."""
    with np.errstate(over="ignore"):
        x = terms + (at.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        out = []
        for _ in range(HASHES):
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            out.append((x ^ (x >> np.uint64(32))) & np.uint64(width - 1))
    return np.array(out).astype(np.int32)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 75 + 75 * n * n_docs // n_terms


def share(tf, m):
    """A term's share of the score, before its weight; never falls as tf grows."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


_INDEX = "width int, steps int, slices binary, files array<long>, places array<long>, sizes array<long>, term binary, df long"


class _Block:
    """Documents of about as many entries, until they fill a block."""

    def __init__(self, width: int):
        self.width, self.room = width, max(1, min(DOCUMENTS, BLOCK // width))
        self.rows, self.entries, self.steps = [], [], 1

    def add(self, row: tuple, terms: np.ndarray, at: np.ndarray) -> None:
        self.rows.append(row)
        self.entries.append(bits(terms, at, self.width).ravel())
        self.steps = max(self.steps, int(at.max()) + 1)

    def row(self) -> tuple:
        grid = np.zeros((self.width, len(self.rows)), dtype=bool)
        for i, e in enumerate(self.entries):
            grid[e, i] = True
        files, places, sizes = zip(*self.rows)
        return self.width, self.steps, np.packbits(grid, axis=1).tobytes(), files, places, sizes, None, None


def _index(batches):
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int64()]
    names = [f.strip().split()[0] for f in _INDEX.split(", ")]
    open_blocks: dict[int, _Block] = {}
    known: dict[bytes, int] = {}
    df: Counter = Counter()

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    def counts():
        n = len(df)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, k) for k in kinds[:6]] + [pa.array(list(df.keys()), kinds[6]), pa.array(list(df.values()), kinds[7])], names)
        df.clear()

    for b in batches:
        for text, file, place in zip(*(b.column(i).to_pylist() for i in range(3))):
            found = terms_of(text)
            if not found:
                continue
            df.update(found.keys())
            if len(known) > COUNTED:
                known.clear()
            hashes = [known.get(t) or known.setdefault(t, hashed(t)) for t in found]
            often = [(h, c) for h, c in zip(hashes, found.values()) if c > 1]
            more = [(h, s) for h, c in often for s in range(1, steps_below(c))]
            terms = np.array(hashes + [h for h, _ in more], dtype=np.uint64)
            at = np.array([0] * len(hashes) + [s for _, s in more], dtype=np.int64)
            width = 1 << max(6, (len(terms) * PER_ENTRY - 1).bit_length())
            block = open_blocks.setdefault(width, _Block(width))
            block.add((file, place, found.total()), terms, at)
            if len(block.rows) == block.room:
                yield rows([open_blocks.pop(width).row()])
            if len(df) > COUNTED:
                yield from counts()
    for block in open_blocks.values():
        yield rows([block.row()])
    if df:
        yield from counts()


def build_index(docs: DataFrame) -> Index:
    """Signatures and counts of every whole text of ``docs`` (doc_id, text)."""
    keyed, (file, place) = with_row_key(docs.select("doc_id", "text"))
    table = materialize(keyed.select("text", file, place).mapInArrow(_index, _INDEX))
    blocks = table.filter("width is not null").select("width", "steps", "slices", "files", "places", "sizes")
    total = blocks.agg(F.sum(F.size("sizes").cast("long")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    counts = table.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    return Index(blocks, counts, keyed, total[0] or 0, total[1] or 0)


class Item(NamedTuple):
    number: int
    #: (term, hash, weight times repeats) of the terms that some document holds
    terms: list[tuple[bytes, int, int]]


def _item_terms(batches):
    for b in batches:
        for number, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found = terms_of(text)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(found), pa.int64()), pa.array(list(found.keys()), pa.binary()),
                                                  pa.array(list(found.values()), pa.int64())], ["number", "term", "repeats"])


def _item_blocks(items: DataFrame, index: Index):
    """Items with their weighted terms, in blocks of bounded size.

    A document's terms number at most its characters, so one item is bounded by
    its text; items come one at a time and are never all on the driver."""
    terms = items.select("number", "text").mapInArrow(_item_terms, "number long, term binary, repeats long")
    rows = (terms.join(index.terms, "term").groupBy("number")
            .agg(F.collect_list(F.struct("term", "repeats", "df")).alias("terms")))
    block, held = [], 0
    for r in materialize(rows).toLocalIterator():
        weighed = [(bytes(t.term), hashed(bytes(t.term)), t.repeats * weight(index.n_docs, t.df)) for t in r.terms]
        item = Item(r.number, sorted((t for t in weighed if t[2] > 0), key=lambda t: (-t[2], t[0])))
        if not item.terms:
            continue
        if block and (len(block) >= ITEMS or held + len(item.terms) > ITEM_TERMS):
            yield block
            block, held = [], 0
        block.append(item)
        held += len(item.terms)
    if block:
        yield block


class Query:
    """A block of items by their distinct terms: term i has the uses ``ends[i]`` to ``ends[i + 1]``, each an item and a weight."""

    def __init__(self, items: list[Item]):
        self.items = items
        uses = sorted((h, i, w) for i, item in enumerate(items) for _, h, w in item.terms)
        hashes = np.array([u[0] for u in uses], dtype=np.uint64)
        self.terms, first = np.unique(hashes, return_index=True)
        self.ends = np.append(first, len(uses))
        self.item = np.array([u[1] for u in uses], dtype=np.int64)
        self.weight = np.array([u[2] for u in uses], dtype=np.int64)


class Slices:
    """One block's slices: bounds of the documents' scores."""

    def __init__(self, width: int, steps: int, slices: bytes, sizes: list[int], n_docs: int, n_terms: int):
        self.width, self.steps, self.n = width, steps, len(sizes)
        self.bitmaps = np.frombuffer(slices, dtype=np.uint8).reshape(width, -1)
        m = np.array([length_norm(n, n_docs, n_terms) for n in sizes], dtype=np.int64)
        size = np.array(sizes, dtype=np.int64)
        #: the largest share at each step: one occurrence less than the next step, or all terms of the document
        tops = [np.minimum(step(s + 1) - 1, size) if s + 1 < steps else size for s in range(steps)]
        self.shares = [share(t, m) for t in tops]

    def reached(self, terms: np.ndarray):
        """(term, document, share) of every term that a document may hold, as three
        arrays; a document that reaches a step reaches all steps before it."""
        maps = np.bitwise_and.reduce(self.bitmaps[bits(terms, np.zeros(len(terms)), self.width)], axis=0)
        t, doc = np.nonzero(np.unpackbits(maps, axis=1, count=self.n))
        value = self.shares[0][doc]
        on = np.arange(len(t))
        for s in range(1, self.steps):
            if not len(on):
                break
            places = bits(terms, np.full(len(terms), s), self.width)[:, t[on]]
            byte = np.bitwise_and.reduce(self.bitmaps[places, doc[on] >> 3], axis=0)
            on = on[(byte >> (7 - (doc[on] & 7)).astype(np.uint8)) & 1 == 1]
            value[on] = self.shares[s][doc[on]]
        return t, doc, value

    def bounds(self, query: Query) -> np.ndarray:
        """(items, documents): a score that the document's true score is not above."""
        total = np.zeros(len(query.items) * self.n, dtype=np.int64)
        some = max(1, CELLS // max(self.n, 1))
        for first in range(0, len(query.terms), some):
            t, doc, value = self.reached(query.terms[first: first + some])
            uses = query.ends[t + first + 1] - query.ends[t + first]
            at = np.repeat(query.ends[t + first] - np.cumsum(uses) + uses, uses) + np.arange(int(uses.sum()))
            np.add.at(total, query.item[at] * self.n + np.repeat(doc, uses), query.weight[at] * np.repeat(value, uses))
        return total.reshape(len(query.items), self.n)


_FOUND = "number long, file long, place long, bound long"
_FOUND_NAMES = ["number", "file", "place", "bound"]


def _found(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], _FOUND_NAMES)


def _blocks(batches, n_docs, n_terms):
    for b in batches:
        for r in range(b.num_rows):
            width, steps, slices, files, places, sizes = (b.column(i)[r].as_py() for i in range(6))
            yield Slices(width, steps, slices, sizes, n_docs, n_terms), np.array(files), np.array(places)


def _highest(items: list[Item], n_docs: int, n_terms: int, first: int):
    """Per task and item, the documents of highest bound."""

    def run(batches):
        best: dict[int, list] = {item.number: [] for item in items}
        query = Query(items)
        for block, files, places in _blocks(batches, n_docs, n_terms):
            for item, bound in zip(items, block.bounds(query)):
                top = np.argpartition(-bound, first - 1)[:first] if len(bound) > first else np.arange(len(bound))
                heap = best[item.number]
                for i in top[bound[top] > 0].tolist():
                    row = (int(bound[i]), int(files[i]), int(places[i]))
                    if len(heap) < first:
                        heapq.heappush(heap, row)
                    else:
                        heapq.heappushpop(heap, row)
        rows = [(n, f, p, u) for n, heap in best.items() for u, f, p in heap]
        if rows:
            yield _found(zip(*rows))

    return run


def _reaching(items: list[Item], thresholds: dict[int, int], n_docs: int, n_terms: int):
    """Every document whose bound reaches its item's threshold."""

    def run(batches):
        query = Query(items)
        for block, files, places in _blocks(batches, n_docs, n_terms):
            for item, bound in zip(items, block.bounds(query)):
                i = np.flatnonzero(bound >= thresholds.get(item.number, 1))
                if len(i):
                    yield _found((np.full(len(i), item.number), files[i], places[i], bound[i]))

    return run


_SCORED = "number long, {id}, score long, file long, place long"


def _scorer(items: list[Item], n_docs: int, n_terms: int, k: int):
    """Rows (doc_id, text, file, place, numbers) to the task's k best per item."""
    wanted = {item.number: item.terms for item in items}

    def run(batches):
        best: dict[int, list] = {}
        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            for doc_id, text, file, place, numbers in zip(*(b.column(i).to_pylist() for i in range(5))):
                found = terms_of(text)
                m = length_norm(found.total(), n_docs, n_terms)
                for number in numbers:
                    score = sum(w * share(found[t], m) for t, _, w in wanted[number] if t in found)
                    if score <= 0:
                        continue
                    rows = best.setdefault(number, [])
                    rows.append((-score, doc_id is None, doc_id if doc_id is not None else 0, file, place))
                    if len(rows) >= 4 * k + 64:
                        rows.sort()
                        del rows[k:]
        out = [(number, None if no_id else doc_id, -score, file, place)
               for number, rows in best.items() for score, no_id, doc_id, file, place in sorted(rows)[:k]]
        if out:
            kinds = [pa.int64(), kind, pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["number", "doc_id", "score", "file", "place"])

    return run


def _exact(index: Index, items: list[Item], found: DataFrame, k: int) -> DataFrame:
    """Exact scores of the documents that ``found`` names: per item the k best of each task."""
    wanted = found.groupBy("file", "place").agg(F.collect_set("number").alias("numbers"))
    file, place = index.docs.columns[-2:]
    docs = index.docs.select("doc_id", "text", F.col(file).alias("file"), F.col(place).alias("place"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.join(wanted, ["file", "place"]).select("doc_id", "text", "file", "place", "numbers")
            .mapInArrow(_scorer(items, index.n_docs, index.n_terms, k), _SCORED.format(id=f"doc_id {kind}")))


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "file", "place")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of each row of ``items`` (item_id, text): item_id, rank,
    doc_id, score."""
    keyed, (file, place) = with_row_key(items.select("item_id", "text"), "_item")
    numbered = materialize(keyed.select("item_id", "text", F.xxhash64(file, place).alias("number")))
    kind = index.docs.schema["doc_id"].dataType.simpleString()
    out = items.sparkSession.createDataFrame([], f"number long, doc_id {kind}, score long, rank int")
    for block in _item_blocks(numbered, index) if index.n_docs else ():
        n = (index.n_docs, index.n_terms)
        high = index.blocks.mapInArrow(_highest(block, *n, max(FIRST, k)), _FOUND)
        order = Window.partitionBy("number").orderBy(F.desc("bound"), "file", "place")
        high = materialize(high.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= max(FIRST, k)).drop("at"))
        scored = _best(_exact(index, block, high, k), k).groupBy("number").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        thresholds = {r.number: r.least for r in scored.collect() if r.n == k}  # one row per item of the block
        reach = materialize(index.blocks.mapInArrow(_reaching(block, thresholds, *n), _FOUND))
        out = out.unionByName(materialize(_best(_exact(index, block, reach, k), k)).select("number", "doc_id", "score", "rank"))
    return out.join(numbered.select("item_id", "number"), "number").select("item_id", "rank", "doc_id", "score")
