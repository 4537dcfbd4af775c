"""SentencePiece encoding by Gumbel top-k sampling, and decoding (operator 2).

A text's segmentations into the pieces of a public model are the paths of a
lattice. A piece weighs 1 / (rank + 1) ** theta by its place in the model; a
segmentation's probability is its pieces' product over the sum of all. The
operator emits the ``k`` segmentations with the largest Gumbel-perturbed log
probabilities: ``k`` distinct samples without replacement, in order.

The search is A* over sets of paths, with exact perturbed maxima as bounds. The
best path of a set is drawn piece by piece; the set's rest falls apart into one
set for every step, of the paths that leave the drawn one there, whose maxima
are Gumbels cut off at the set's own. The set with the largest maximum is next.
Its value after the last sample, kappa, gives each sample's inclusion score
1 - exp(-exp(log_prob - kappa)), kept as its logarithm: a long text's is too
small for a double.

No piece crosses from a non-space to a space or holds a line feed, so the lattice
is a chain of short ones, which are built once per distinct chunk and walked
side by side for a batch of texts. Random numbers are hashes of the row's key,
the round and the place, so a row's samples depend on its key and text only.

Encoding is exact: spaces are the model's space sign, a character without a
piece (line feeds and the space sign itself among them) becomes its bytes, and
one space is put before the text and taken off again. Cases: null and empty
texts have the one segmentation without pieces; a text with fewer than k
segmentations gives them all, with inclusion 1 (logarithm 0); null keys count as a key of
their own, and equal keys with equal texts sample alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: Default place of the model; any SentencePiece model with byte fallback will do.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
THETA = 1.0
#: Chunks that a task remembers; forgotten all at once when there are more.
MEMORY = 140_000
#: Longest chunk that is built side by side with others.
LONGEST = 64
SCALE = 20.0
#: Multiplier of the hashes of beginnings.
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Characters of text walked side by side.
BATCH = 1 << 18
CHUNK = re.compile(r"\n| *[^ \n]+| +")
SIGN = "▁"
#: A Gumbel made of 53 random bits exceeds its place by less than this.
REACH = 38.0


def load_pieces(path: str = MODEL) -> list[tuple[str, bool, bool]]:
    """(piece, is a byte, is usable text) of every id of a SentencePiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.is_byte(i), not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)))
            for i in range(model.get_piece_size())]


class Vocabulary:
    """Pieces with their weights, and hashes of all their beginnings by length, made
    once on the driver."""

    def __init__(self, pieces, theta: float):
        self.ids: dict[str, int] = {}
        self.weight: dict[str, float] = {}
        self.byte_id = [0] * 256
        rank = 0
        for i, (p, is_byte, usable) in enumerate(pieces):
            if is_byte:
                self.byte_id[int(p[1:-1], 16)] = i
            elif usable:
                text = p.replace(SIGN, " ")
                self.ids[text] = i
                # SCALE per letter, so that products of long chunks stay in range
                self.weight[text] = (rank + 2.0) ** -theta * SCALE ** len(text)
                rank += 1
        self.byte_weight = (rank + 2.0) ** -theta
        self.letters = {t for t in self.ids if len(t) == 1}
        self.heads = {t[:n] for t in self.ids for n in range(1, len(t) + 1)}
        self.levels = []  # by length: sorted hashes of beginnings, id or -1, weight; where each hash's leading bits start, bits left
        for n in range(1, max(map(len, self.ids), default=0) + 1):
            own = [h for h in self.heads if len(h) == n]
            codes = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
            hashes = np.zeros(len(own), np.uint64)
            for c in range(n):
                hashes = (hashes + codes[:, c] + np.uint64(1)) * STEP
            order = np.argsort(hashes)
            bits = max(1, (4 * len(own)).bit_length())
            tops = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
            starts = np.searchsorted(hashes[order], tops).astype(np.int32)
            self.levels.append((np.append(hashes[order], ~np.uint64(0)), np.array([self.ids.get(own[i], -1) for i in order] + [-1], np.int32),
                                np.array([self.weight.get(own[i], 0.0) for i in order] + [0.0]), starts, np.uint64(64 - bits)))


class Lattices:
    """Edges of the lattices of all chunks seen: for each node its first edge and
    their number, for each edge its end, piece and probability."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.store = {k: np.zeros(1 << 16, np.int32) for k in ("first", "count")}
        self.edge = {k: np.zeros(1 << 16, t) for k, t in (("end", np.int32), ("piece", np.int32), ("p", np.float64))}
        self.clear()

    def clear(self):
        """Forget all chunks; the arrays are written over."""
        self.known: dict[str, int] = {}
        self.nodes = 0
        self.edges = 0

    def add(self, chunks) -> None:
        """Build the lattices of new chunks: most of them side by side, those that
        are very long or hold a character without a piece one by one."""
        letters = self.v.letters
        plain = [c for c in chunks if len(c) <= LONGEST and letters.issuperset(c)]
        for at in range(0, len(plain), 10_000):
            self._many(plain[at: at + 10_000])
        self._each(c for c in chunks if c not in self.known)

    def _many(self, chunks) -> None:
        chunks = sorted(chunks, key=len, reverse=True)
        size = np.array([len(c) for c in chunks])
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        n, stop = len(codes), np.cumsum(size)
        start = stop - size
        row = np.repeat(np.arange(len(chunks)), size)
        left = stop[row] - np.arange(n)  # letters to the chunk's end
        depth = min(len(self.v.levels), int(size[0]))
        weight, found, degree = np.zeros((n, depth)), [], np.zeros(n, np.int32)
        h, live, rest = np.zeros(n, np.uint64), np.arange(n), left
        for k, (hashes, ids, worth, starts, shift) in enumerate(self.v.levels[:depth]):
            if k:
                more = rest > k
                h, live, rest = h[more], live[more], rest[more]
                if not len(live):
                    break
            h = (h + codes[live + k] + np.uint64(1)) * STEP
            at = starts[h >> shift]
            later = np.flatnonzero(hashes[at] < h)
            while len(later):
                at[later] += 1
                later = later[hashes[at[later]] < h[later]]
            ok = np.flatnonzero(hashes[at] == h)
            h, live, rest, at = h[ok], live[ok], rest[ok], at[ok]
            whole = np.flatnonzero(ids[at] >= 0)
            letter, at = live[whole], at[whole]
            weight[letter, k] = worth[at]
            degree[letter] += 1
            found.append((letter, ids[at]))
        weight = weight[:, : len(found)]
        # paths from a letter to the chunk's end, by letters left; longest chunks first
        total = np.zeros((len(chunks), int(size[0]) + 1))
        total[:, 0] = 1.0
        for d in range(1, int(size[0]) + 1):
            m = int(np.searchsorted(-size, -d, side="right"))
            w = min(d, weight.shape[1])
            total[:m, d] = np.einsum("ij,ij->i", weight[stop[:m] - d, :w], total[:m, d - w: d][:, ::-1])
        # a letter's edges lie together, longest first: mostly the likeliest
        put = np.cumsum(degree) - degree
        at, size_of, piece = (np.empty(int(degree.sum()), t) for t in (np.int64, np.int64, np.int32))
        for k in range(len(found) - 1, -1, -1):
            letter, ids = found[k]
            to = put[letter]
            put[letter] += 1
            at[to], size_of[to], piece[to] = letter, k + 1, ids
        flat, cell = total.ravel(), (row * total.shape[1] + left)[at]
        p = weight[at, size_of - 1] * flat[cell - size_of] / flat[cell]
        # a node for every letter and one for each chunk's end
        node = self.nodes + np.arange(n) + row
        count = np.zeros(n + len(chunks), np.int32)
        count[node - self.nodes] = degree
        first = self.edges + np.cumsum(count) - count
        self._put(self.store, self.nodes, {"first": first, "count": count})
        self._put(self.edge, self.edges, {"end": node[at] + size_of, "piece": piece, "p": p})
        self.known.update(zip(chunks, (self.nodes + start + np.arange(len(chunks))).tolist()))
        self.nodes += n + len(chunks)
        self.edges += len(at)

    def _each(self, chunks) -> None:
        first, count, end, piece, prob = [], [], [], [], []
        node, edge = self.nodes, self.edges
        ids, weight, heads, v = self.v.ids, self.v.weight, self.v.heads, self.v
        for chunk in chunks:
            self.known[chunk] = node
            size = len(chunk)
            out: list = [None] * size
            total = [0.0] * (size + 1)
            total[size] = 1.0
            for i in range(size - 1, -1, -1):
                found, s = [], 0.0
                for j in range(i + 1, size + 1):
                    part = chunk[i:j]
                    if part not in heads:
                        break
                    w = weight.get(part)
                    if w is not None:
                        w *= total[j]
                        found.append((j, ids[part], w))
                        s += w
                if chunk[i] not in ids:  # no piece for the letter: its bytes
                    raw = chunk[i].encode("utf-8", "surrogatepass")
                    w = v.byte_weight ** len(raw) * SCALE * total[i + 1]
                    found.append((i + 1, raw, w))
                    s += w
                if not 1e-140 < s < 1e140:  # scale what is still needed
                    found = [(j, p, w / s) for j, p, w in found]
                    for j in range(i + 1, min(size, i + len(v.levels) + 1) + 1):
                        total[j] /= s
                    s = 1.0
                total[i] = s
                out[i] = (found, s)
            places, at = [], node
            for i in range(size):
                places.append(at)
                at += 1 + sum(len(p) - 1 for _, p, _ in out[i][0] if type(p) is bytes)
            places.append(at)
            for i, (found, s) in enumerate(out):
                found.reverse()  # longest first
                first.append(edge)
                count.append(len(found))
                spare = []
                for j, p, w in found:
                    prob.append(w / s)
                    if type(p) is bytes:
                        spare.append((p, places[j]))
                        piece.append(v.byte_id[p[0]])
                        end.append(places[j] if len(p) == 1 else places[i] + 1)
                    else:
                        piece.append(p)
                        end.append(places[j])
                    edge += 1
                for raw, stop in spare:  # further bytes are nodes of one edge
                    for n in range(1, len(raw)):
                        first.append(edge)
                        count.append(1)
                        prob.append(1.0), piece.append(v.byte_id[raw[n]])
                        end.append(stop if n == len(raw) - 1 else places[i] + n + 1)
                        edge += 1
            first.append(edge)
            count.append(0)
            node = at + 1
        self._put(self.store, self.nodes, {"first": first, "count": count})
        self._put(self.edge, self.edges, {"end": end, "piece": piece, "p": prob})
        self.nodes, self.edges = node, edge

    @staticmethod
    def _put(store, at, new):
        for k, values in new.items():
            need = at + len(values)
            if need > len(store[k]):
                store[k] = np.concatenate([store[k][:at], np.zeros(max(need, 2 * len(store[k])) - at, store[k].dtype)])
            store[k][at:need] = values


def chunks_of(text: str) -> list[str]:
    """``CHUNK.findall(" " + text)``; lines with single spaces only are split, which is faster."""
    out = []
    for i, line in enumerate((" " + text).split("\n")):
        if i:
            out.append("\n")
        if "  " in line or line[-1:] == " ":
            out += CHUNK.findall(line)
        elif line:
            first, *words = line.split(" ")
            if first:
                out.append(first)
            out += [" " + w for w in words]
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit counters."""
    x = np.atleast_1d(x) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seed, place) -> np.ndarray:
    return ((_mix(_mix(np.asarray(seed, np.uint64)) ^ np.asarray(place, np.uint64)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _seed(key: int, round_: int, salt: int) -> int:
    return (key * 0x9E3779B97F4A7C15 + round_ * 1000003 + salt) & (1 << 64) - 1


class Walk:
    """Samples of one text: its paths (edges), where each chunk's pieces end, and
    the sets of paths not yet drawn."""

    __slots__ = ("key", "begins", "paths", "ends", "values", "logs", "queue")

    def __init__(self, key: int, begins: np.ndarray):
        self.key, self.begins = key, begins
        self.paths, self.ends, self.values, self.logs, self.queue = [], [], [], [], []


def _fresh(lat: Lattices, walks, froms, round_: int):
    """Draw the chunks from ``froms`` on, for all walks side by side: per walk
    (edges, pieces per chunk)."""
    with np.errstate(over="ignore"):
        sizes = [len(w.begins) - f for w, f in zip(walks, froms)]
        n = sum(sizes)
        node = np.concatenate([w.begins[f:] for w, f in zip(walks, froms)]) if n else np.zeros(0, np.int64)
        seed = np.repeat(np.array([_seed(w.key, round_, 1) for w in walks], np.uint64), sizes)
        place = (np.concatenate([np.arange(f, len(w.begins)) for w, f in zip(walks, froms)]) if n else node).astype(np.uint64) << np.uint64(24)
        seed = _mix(seed)
        first, count, end, prob = lat.store["first"], lat.store["count"], lat.edge["end"], lat.edge["p"]
        live = np.arange(n)
        steps, who = [], []
        length = np.zeros(n, np.int64)
        step = 0
        left = count[node]
        while len(live):
            e = first[node]
            many = np.flatnonzero(left > 1)
            if len(many):
                u = ((_mix(seed[many] ^ (place[many] + np.uint64(step))) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
                pick, options = e[many], left[many]
                p = prob[pick]
                over = np.flatnonzero(u > p)
                u, p, tries = u[over], p[over], 1
                while len(over):  # on to the next edge; the last takes what is left
                    pick[over] += 1
                    u = u - p
                    tries += 1
                    p = prob[pick[over]]
                    go = (u > p) & (options[over] > tries)
                    over, u, p = over[go], u[go], p[go]
                e[many] = pick
            steps.append(e)
            who.append(live)
            length[live] += 1
            node = end[e]
            left = count[node]
            go = left > 0
            if not go.all():
                node, live, seed, place, left = node[go], live[go], seed[go], place[go], left[go]
            step += 1
    at = np.cumsum(length) - length
    flat = np.empty(int(length.sum()), np.int64)
    for s, (e, w) in enumerate(zip(steps, who)):
        flat[at[w] + s] = e
    out, lo, c = [], 0, 0
    for size in sizes:
        hi = lo + int(length[c: c + size].sum())
        out.append((flat[lo:hi], length[c: c + size]))
        lo, c = hi, c + size
    return out


def _branch(lat: Lattices, w: Walk, parent: int, t: int, without: tuple, round_: int):
    """The parent's pieces before step ``t``, another edge there, and on to the
    chunk's end: (edges, number of the next chunk, pieces of this chunk)."""
    path, ends = w.paths[parent], w.ends[parent]
    chunk = int(np.searchsorted(ends, t, side="right"))
    start = int(ends[chunk - 1]) if chunk else 0
    own = list(path[start:t])
    first, count, edge = lat.store["first"], lat.store["count"], lat.edge
    node = int(w.begins[chunk]) if t == start else int(edge["end"][path[t - 1]])
    draws = _uniform(_seed(w.key, round_, 2), np.arange(64, dtype=np.uint64))
    n = 0
    while count[node] > 0:
        lo, m = int(first[node]), int(count[node])
        options = [e for e in range(lo, lo + m) if n or e not in without]
        if len(options) > 1:
            if n >= len(draws):
                draws = _uniform(_seed(w.key, round_, 2), np.arange(4 * len(draws), dtype=np.uint64))
            p = edge["p"][options]
            u = draws[n] * p.sum()
            e = options[min(int(np.searchsorted(np.cumsum(p), u)), len(options) - 1)]
        else:
            e = options[0]
        own.append(e)
        node = int(edge["end"][e])
        n += 1
    return start, own, chunk


def _siblings(lat: Lattices, walks, t0s, withouts, befores, values, want: int, round_: int) -> None:
    """Put the sets that each walk's last path leaves behind from its step ``t0``
    on into the walk's queue; only those that can still be among the next ``want``.
    ``befores`` are the log probabilities of the paths before ``t0``."""
    todo, width = list(range(len(walks))), 48
    prob = lat.edge["p"]
    while todo:
        n = len(todo)
        edges = np.full((n, width), -1, np.int64)
        for r, i in enumerate(todo):
            part = walks[i].paths[-1][t0s[i]: t0s[i] + width]
            edges[r, : len(part)] = part
        p = np.where(edges >= 0, prob[edges], 1.0)
        logs = np.log(p)
        ends = np.array([befores[i] for i in todo])[:, None] + np.cumsum(logs, axis=1)
        rest = 1.0 - p
        for r, i in enumerate(todo):
            without = withouts[i]
            if without:
                left = _degree(lat, walks[i], len(walks[i].paths) - 1, t0s[i]) - len(without) - 1
                rest[r, 0] = max(rest[r, 0] - prob[list(without)].sum(), 1e-300) if left > 0 else 0.0
        t = np.array([t0s[i] for i in todo], np.uint64)[:, None] + np.arange(width, dtype=np.uint64)
        u = _uniform(np.array([_seed(walks[i].key, round_, 3) for i in todo], np.uint64)[:, None], t)
        start = ends - logs
        with np.errstate(divide="ignore"):
            phi = start + np.log(np.maximum(rest, 0.0))
        g = phi - np.log(np.exp(np.minimum(phi - np.array([values[i] for i in todo])[:, None], 700.0)) - np.log(u))
        top = np.argsort(-g, axis=1)[:, :want]
        best = np.take_along_axis(g, top, axis=1)
        again = []
        for r, i in enumerate(todo):
            w, t0 = walks[i], t0s[i]
            path, which = w.paths[-1], len(w.paths) - 1
            floor = w.queue[want - 1][0] if len(w.queue) >= want else -math.inf
            if t0 + width < len(path) and not ends[r, -1] < max(floor, float(best[r, -1]) if best.shape[1] == want else -math.inf) - REACH:
                again.append(i)
                continue
            for c, v in zip(top[r].tolist(), best[r].tolist()):
                if v > -math.inf:
                    w.queue.append((v, which, t0 + c, (*(() if c else withouts[i]), int(path[t0 + c])), float(start[r, c])))
            w.queue.sort(key=lambda x: -x[0])
            del w.queue[want:]
        todo, width = again, width * 4


def _degree(lat: Lattices, w: Walk, which: int, t: int) -> int:
    path, ends = w.paths[which], w.ends[which]
    chunk = int(np.searchsorted(ends, t, side="right"))
    start = int(ends[chunk - 1]) if chunk else 0
    node = int(w.begins[chunk]) if t == start else int(lat.edge["end"][path[t - 1]])
    return int(lat.store["count"][node])


@np.errstate(over="ignore")
def sample_batch(lat: Lattices, texts: list[str | None], keys: list[int], k: int):
    """For each text (paths as arrays of piece ids, log probabilities, perturbed
    values, kappa)."""
    cut = [chunks_of(t) if t else [] for t in texts]
    at = [list(map(lat.known.get, chunks)) for chunks in cut]
    missing = [r for r, places in enumerate(at) if None in places]
    if missing:
        new = {c for r in missing for c, place in zip(cut[r], at[r]) if place is None}
        if len(lat.known) + len(new) > MEMORY and lat.known:
            lat.clear()
            missing = range(len(cut))
            new = {c for chunks in cut for c in chunks}
        lat.add(new)
        for r in missing:
            at[r] = list(map(lat.known.__getitem__, cut[r]))
    walks = [Walk(key, np.array(places, np.int64)) for key, places in zip(keys, at)]
    edge = lat.edge
    for w, (path, lens) in zip(walks, _fresh(lat, walks, [0] * len(walks), 0)):
        u = float(_uniform(_seed(w.key, 0, 4), 0)[0])
        w.paths.append(path)
        w.ends.append(np.cumsum(lens))
        w.values.append(-math.log(-math.log(u)))
        w.logs.append(float(np.log(edge["p"][path]).sum()))
    live = [w for w in walks if len(w.paths[0])]
    none = [0] * len(live)
    _siblings(lat, live, none, [()] * len(live), none, [w.values[0] for w in live], k, 0)
    for r in range(1, k):
        live = [w for w in walks if w.queue]
        taken = []
        for w in live:
            value, parent, t, without, before = w.queue.pop(0)
            start, own, chunk = _branch(lat, w, parent, t, without, r)
            taken.append((value, parent, t, without, start, own, chunk, before))
        for w, (value, parent, t, without, start, own, chunk, before), (path, lens) in zip(
                live, taken, _fresh(lat, live, [x[6] + 1 for x in taken], r)):
            w.paths.append(np.concatenate([w.paths[parent][:start], np.array(own, np.int64), path]))
            ends = w.ends[parent][:chunk]
            w.ends.append(np.concatenate([ends, start + len(own) + np.concatenate([[0], np.cumsum(lens)])]).astype(np.int64))
            w.values.append(value)
            w.logs.append(float(np.log(edge["p"][w.paths[-1]]).sum()))
        _siblings(lat, live, [x[2] for x in taken], [x[3] for x in taken], [x[7] for x in taken], [x[0] for x in taken], k - r, r)
    return [([edge["piece"][p] for p in w.paths], w.logs, w.values, w.queue[0][0] if w.queue else -math.inf) for w in walks]


def _joined(ids: np.ndarray, table: np.ndarray) -> str:
    """Text of a list of ids; ``table`` holds their bytes."""
    t = b"".join(table[ids].tolist()).decode("utf-8", "replace")
    return t[1:] if t[:1] == " " else t


def _bytes(pieces) -> np.ndarray:
    return np.array([bytes([int(p[1:-1], 16)]) if is_byte else p.replace(SIGN, " ").encode() if usable else b"" for p, is_byte, usable in pieces], dtype=object)


def encode(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = SAMPLES, theta: float = THETA, seed: int = 2,
           model: str = MODEL, verify: bool = False) -> DataFrame:
    """``docs`` plus ``pieces`` (k lists of ids, best first), ``log_prob``,
    ``perturbed`` and ``log_inclusion`` (one number per list); with ``verify`` also
    ``decodes``: whether every list decodes to the text. Columns of ``docs`` that
    have one of these names are replaced."""
    loaded = load_pieces(model)
    table = _bytes(loaded)
    vocabulary = Vocabulary(loaded, theta)
    added = ["pieces", "log_prob", "perturbed", "log_inclusion"]
    shown = [*added, *["decodes"] * verify]
    clash = [c for c in docs.columns if c in shown]
    base = docs.drop(*clash)
    names = [*base.columns, *shown]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema), "pieces array<array<int>>", *(f"{c} array<double>" for c in added[1:]),
                        *["decodes boolean"] * verify])
    names_in = fresh(base, "_key", "_text")
    packed = docs.select(*[F.col(f"`{c}`") for c in base.columns], F.xxhash64(F.lit(seed), F.col(f"`{key}`")).alias(names_in[0]),
                         F.col(f"`{text}`").cast("string").alias(names_in[1]))

    def lists(values, lens):
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), values)

    def run(batches):
        lat = Lattices(vocabulary)
        for b in batches:
            lo = 0
            texts = b.column(b.num_columns - 1)
            while lo < b.num_rows:
                hi, size = lo, 0
                while hi < b.num_rows and (size < BATCH or hi == lo):
                    size += len(texts[hi].as_py() or "")
                    hi += 1
                part = b.slice(lo, hi - lo)
                lo = hi
                got = sample_batch(lat, part.column(part.num_columns - 1).to_pylist(), part.column(part.num_columns - 2).to_pylist(), k)
                paths = [p for ps, *_ in got for p in ps]
                flat = pa.array(np.concatenate(paths) if paths else np.zeros(0, np.int32), pa.int32())
                per = [len(ps) for ps, *_ in got]
                ids = lists(lists(flat, [len(p) for p in paths]), per)
                logs = np.array([x for _, ls, _, _ in got for x in ls])
                values = np.array([x for _, _, vs, _ in got for x in vs])
                gap = logs - np.repeat([g[3] for g in got], per)
                share = np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(np.clip(gap, -30, 700)))))
                out = [*part.columns[:-2], ids, lists(pa.array(logs), per), lists(pa.array(values), per), lists(pa.array(share), per)]
                if verify:
                    own = part.column(part.num_columns - 1).to_pylist()
                    out.append(pa.array([all(_joined(p, table) == (t or "") for p in ps) for t, (ps, *_) in zip(own, got)]))
                yield pa.RecordBatch.from_arrays(out, names)

    return packed.mapInArrow(run, schema)


def decode(rows: DataFrame, pieces: str = "pieces", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` plus ``out``: the texts of the lists of ids in ``pieces``."""
    table = _bytes(load_pieces(model))
    names = [*rows.columns, out]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{out}` array<string>"])
    at = rows.columns.index(pieces)

    def run(batches):
        for b in batches:
            outer = b.column(at)
            inner = outer.values
            flat, offs, tops = inner.values.to_numpy(), inner.offsets.to_numpy(), outer.offsets.to_numpy()
            got = []
            for r in range(b.num_rows):
                got.append([_joined(flat[offs[i]: offs[i + 1]], table) for i in range(tops[r], tops[r + 1])])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.list_(pa.string()))], names)

    return rows.mapInArrow(run, schema)
