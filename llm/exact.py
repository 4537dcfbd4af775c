"""Exact dedup with Patricia-trie owners (operator 3).

Texts are equal when their bytes are equal after white space is deleted. A key
is the length and a 64-bit hash of those bytes, followed by the bytes. Each
task puts its rows' keys into a compressed radix trie whose terminal nodes hold
the best row so far, so a text leaves a task once however often it occurs there.
These owners are dealt by length and hash and inserted, full bytes, into tries
again; rows then look up the class of their task's owner.

Spill is by subtree. In the first step the largest subtrees below the root
are written out and forgotten when the trie outgrows ``max_bytes`` (a text that
occurs again gets a second owner, and the owners meet in the second step). In
the second step owners arrive sorted by length and hash, so a subtree is
complete, and released, when the next one starts.

Of equal texts the row with the most code points in the original text stays,
then the smallest id (null last), then the first by place in the input. Cases:
null texts count as empty and equal each other; equal ids are separate rows, of
which one is kept; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Bytes of text that a task's trie may hold before it spills subtrees.
MAX_BYTES = 48 << 20
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


class Node:
    __slots__ = ("label", "next", "owner")

    def __init__(self, label: bytes):
        self.label, self.next, self.owner = label, {}, None


def insert(root: Node, key: bytes) -> Node:
    """The node where ``key`` ends, made if need be."""
    node, at = root, 0
    while at < len(key):
        child = node.next.get(key[at])
        if child is None:
            child = node.next[key[at]] = Node(key[at:])
            return child
        label = child.label
        if key.startswith(label, at):
            node, at = child, at + len(label)
            continue
        lo, hi = 1, min(len(label), len(key) - at)  # the first byte agrees
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if key.startswith(label[:mid], at):
                lo = mid
            else:
                hi = mid - 1
        fork = Node(label[:lo])
        fork.next[label[lo]] = child
        child.label = label[lo:]
        node.next[key[at]] = fork
        node, at = fork, at + lo
    return node


def terminals(node: Node, prefix: bytes = b""):
    """(key, owner) of every key below ``node``; the trie may be as deep as a text is long."""
    stack = [(node, prefix + node.label)]
    while stack:
        n, key = stack.pop()
        if n.owner is not None:
            yield key, n.owner
        stack.extend((c, key + c.label) for c in n.next.values())


def weight(node: Node) -> int:
    """Bytes that the trie below ``node`` holds, about."""
    total, stack = 0, [node]
    while stack:
        n = stack.pop()
        total += len(n.label) + 200
        stack.extend(n.next.values())
    return total


def largest(root: Node, least: int) -> list[tuple[bytes, Node]]:
    """Cut the heaviest branches off the trie's first fork until ``least`` bytes
    are gone: (key before the branch, branch)."""
    node, prefix = root, root.label
    while len(node.next) == 1 and node.owner is None:
        node = next(iter(node.next.values()))
        prefix += node.label
    if not node.next:  # a single key
        node, prefix = root, root.label
    cut, gone = [], 0
    for size, first in sorted(((weight(c), k) for k, c in node.next.items()), reverse=True):
        if gone >= least:
            break
        cut.append((prefix, node.next.pop(first)))
        gone += size
    return cut


def best(a: tuple, b: tuple) -> tuple:
    """Of (code points, id, row): most code points, smallest id (null last), first row."""
    return min(a, b, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0, x[2]))


_ROWS = "id long, points long, row long, ref long, sha string, len long, hash long, body binary, n long"
_NAMES = [x.split()[0] for x in _ROWS.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)], _NAMES)


def _owners(max_bytes: int):
    def run(batches):
        base = TaskContext.get().partitionId() << 40
        root, held, refs, rows = Node(b""), 0, 0, 0

        def out(branch, prefix=b""):
            pack, size = [], 0
            for key, (ref, top, n) in terminals(branch, prefix):
                body = key[16:]
                pack.append((top[1], top[0], top[2], ref, None, len(body), int.from_bytes(key[8:16], "little", signed=True), body, n))
                size += len(body)
                if size > 8 << 20 or len(pack) >= 5000:
                    yield _batch(pack)
                    pack, size = [], 0
            if pack:
                yield _batch(pack)

        for b in batches:
            pack = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py() or ""
                body = text.encode("utf-8", "surrogatepass").translate(None, SPACE)
                h = xxhash.xxh64_intdigest(body)
                node = insert(root, len(body).to_bytes(8, "big") + h.to_bytes(8, "little") + body)
                top = (len(text), doc, base + rows)
                if node.owner is None:
                    node.owner = [base + refs, top, 1]
                    refs += 1
                    held += len(body) + 400
                else:
                    node.owner[1] = best(node.owner[1], top)
                    node.owner[2] += 1
                pack.append((doc, len(text), base + rows, node.owner[0], hashlib.sha256(body).hexdigest(), None, None, None, None))
                rows += 1
                if held > max_bytes:
                    for prefix, branch in largest(root, held // 2):
                        yield from out(branch, prefix)
                    held = weight(root)
            if pack:
                yield _batch(pack)
        yield from out(root)

    return run


def _classes(batches):
    """Rows by (length, hash): a subtree for each, out as soon as the next starts."""
    root, now, pack = Node(b""), None, []

    def out():
        for _, (refs, top, n) in terminals(root):
            for r in refs:
                pack.append((r, top[1], top[2], n))

    def batch():
        cols = list(zip(*pack))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["ref", "keep_id", "keep_row", "group_size"])

    for b in batches:
        n_, h_, i_, p_, r_, f_, c_ = (b.column(i).to_pylist() for i in range(7))
        for k, (size, h) in enumerate(zip(n_, h_)):
            if (size, h) != now:
                out()
                root, now = Node(b""), (size, h)
                if len(pack) >= 20000:
                    yield batch()
                    pack = []
            node = insert(root, b.column(7)[k].as_py())
            top = (p_[k], i_[k], r_[k])
            if node.owner is None:
                node.owner = [[f_[k]], top, c_[k]]
            else:
                node.owner[0].append(f_[k])
                node.owner[1] = best(node.owner[1], top)
                node.owner[2] += c_[k]
    out()
    if pack:
        yield batch()


def exact_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    both = materialize(source.mapInArrow(_owners(max_bytes), _ROWS))
    owners = (both.filter("body is not null").select("len", "hash", "id", "points", "row", "ref", "n", "body")
              .repartition("len", "hash").sortWithinPartitions("len", "hash"))
    classes = owners.mapInArrow(_classes, "ref long, keep_id long, keep_row long, group_size long")
    return (both.filter("body is null").select("id", "row", "ref", "sha").join(classes, "ref")
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The ids that stay, one row per distinct text: doc_id, group_size, text_sha256."""
    return exact_classes(docs, text, doc_id).filter("kept").select("doc_id", "group_size", "text_sha256")
