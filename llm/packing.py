"""Packing documents into token windows by the sum-of-squares rule (operator 12).

A text becomes its ids and an end id. While a document has a whole window's
ids, they fill a window of their own; what is left (shorter than a window) is
placed whole, online, into a partially filled window or a new one. A level array
counts the open windows at each fill level, and the piece goes to the level
after which the sum of squares of these counts is smallest: no level then grows
common without a partner that completes it. Equal sums take the fuller window.

Open windows are held until they are full. Their number is bounded: when a task
holds ``max_open`` of them, and at its end, the fullest windows are completed
from the emptiest ones, whose pieces are cut where a window is full. The last
ids of a task form sequences of a power of two, so nothing is padded at all.

A task packs the rows of its own split, so no text is shuffled, memory holds
``max_open`` windows, and a lost task gives the same pieces again. Sequence ids
are the task's number times 2^33 plus a counter.

Cases. Null texts count as empty: one piece that holds the end id. Equal or null
ids are separate documents, told apart by ``document``. A long text is cut into
many windows. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, END = 2048, 1
#: Open windows that a task holds at most.
MAX_OPEN = 4096
#: Characters tokenised at once, and bytes of ids sent on at once.
CHARACTERS, BYTES = 1 << 21, 4 << 20
#: Words whose ids a task remembers, and the longest of them; forgotten all at once, never dropped.
WORDS, WORD = 1 << 19, 64
#: Unknown words encoded in one run.
RUN = 1 << 13
#: Before a single space between two characters that are not white space (Python's
#: white space includes Unicode's, so a doubtful place is not cut).
SPACE = re.compile(r"(?<=\S)(?= \S)")
#: White space beside a space or a space at an end: a text without one has only such spaces.
_WHITE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DOUBTFUL = rf"{_WHITE} | {_WHITE}|\A | \z"


class Tokens:
    """Ids of whole texts by a ``tokenizers`` file, words remembered.

    A byte-level model without a normaliser that splits by its own pattern never
    joins characters across :data:`SPACE`: its words are runs of letters, of
    digits or of other characters, each after at most one space, or of white
    space alone. So the ids of a text are those of its words, one after another,
    and a word is encoded once. Other models get whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task: Spark uses the cores
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            text = f.read()
        self.model, said = Tokenizer.from_str(text), json.loads(text)
        split = said.get("pre_tokenizer") or {}
        whole = any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in said.get("added_tokens", []))
        self.by_word = (said.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                        and not split.get("add_prefix_space") and not whole)
        added = {t["content"]: len(t["content"].encode()) for t in said.get("added_tokens", [])}
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        #: bytes of text that an id stands for: a byte-level token has one letter a byte
        self.width = np.zeros(1 + max(vocabulary.values(), default=0), dtype=np.int64)
        for token, i in vocabulary.items():
            self.width[i] = added.get(token, len(token))
        self.known: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        got = [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(got), dtype="<u4").tobytes()
        ends = [0, *accumulate(4 * len(x) for x in got)]
        return [flat[i:j] for i, j in zip(ends, ends[1:])]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, of many words in one run: words that start with a space
        and end without white space form a text that is cut between any two."""
        runs = [i for i, w in enumerate(words) if len(w) > 1 and w[0] == " " and not w[-1].isspace()]
        out: list = [None] * len(words)
        for first in range(0, len(runs), RUN):
            some = runs[first: first + RUN]
            names = [words[i] for i in some]
            ids = np.frombuffer(self._encode(["".join(names)])[0], dtype="<u4")
            ends = np.cumsum(self.width[ids])
            want = np.cumsum(pc.binary_length(pa.array(names, pa.large_string())).to_numpy())
            stops = np.searchsorted(ends, want) + 1
            if len(ids) and ends[-1] == want[-1] and (ends[stops - 1] == want).all():
                flat, stops = ids.tobytes(), (4 * stops).tolist()
                for i, x, y in zip(some, [0, *stops], stops):
                    out[i] = flat[x:y]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self._encode([words[i] for i in rest])):
            out[i] = x
        return out

    def _words(self, words: pa.Array, ends: np.ndarray) -> list[np.ndarray]:
        """Ids of texts whose words stand one after another and end at ``ends``."""
        coded = words.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, names))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            if len(self.known) > WORDS:
                self.known = {}
            for i, x in zip(new, self._encode_words([names[i] for i in new])):
                ids[i] = x
                if len(names[i]) <= WORD:
                    self.known[names[i]] = x
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        at = coded.indices.to_numpy()
        sizes, starts = size[at], (np.cumsum(size) - size)[at]
        stops = np.cumsum(sizes)
        out = flat[np.repeat(starts - stops + sizes, sizes) + np.arange(int(sizes.sum()))]
        return np.split(out, np.concatenate([[0], stops])[ends[:-1]])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if not texts or not self.by_word:
            return [np.frombuffer(x, dtype="<u4") for x in self._encode(texts)]
        rows = pa.array(texts, pa.large_string())
        doubt = pc.match_substring_regex(rows, DOUBTFUL).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        plain = np.flatnonzero(~doubt)
        if len(plain):
            lists = pc.split_pattern(rows.take(pa.array(plain)), " ")
            ends = lists.offsets.to_numpy()
            spaces = np.ones(int(ends[-1]), dtype=bool)
            spaces[ends[:-1]] = False  # a text's first word has none before it
            before = pc.if_else(pa.array(spaces), pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
            words = pc.binary_join_element_wise(before, lists.values, pa.scalar("", pa.large_string()))
            for i, x in zip(plain, self._words(words, ends[1:])):
                out[i] = x
        if doubt.any():
            split = [SPACE.split(texts[i]) for i in np.flatnonzero(doubt)]
            words = pa.array(list(chain.from_iterable(split)), pa.large_string())
            for i, x in zip(np.flatnonzero(doubt), self._words(words, np.cumsum([len(x) for x in split]))):
                out[i] = x
        return out


class Levels:
    """The level array: how many open windows are filled to each level."""

    def __init__(self, window: int):
        self.window = window
        # twice the counts, with the ends set so that a new window (level 0)
        # and a completed one (level ``window``) weigh what they add
        self.twice = np.zeros(window + 1, dtype=np.int64)
        self.twice[0], self.twice[window] = 1, -1
        #: the same where a window is open, else far below all counts
        self.open = np.full(window + 1, -(1 << 60), dtype=np.int64)
        self.open[0] = 1

    def add(self, level: int, n: int) -> None:
        self.twice[level] += 2 * n
        self.open[level] = self.twice[level] if self.twice[level] else -(1 << 60)

    def best(self, size: int) -> int:
        """The level for a piece of ``size`` ids: moving a window from h to h + size
        changes the sum of squares by twice n[h + size] - n[h] + 1."""
        change = self.twice[size:][::-1] - self.open[: self.window - size + 1][::-1]
        return self.window - size - int(change.argmin())


class Packer:
    """Windows of one task. A piece is (document, start, ids, ids of the whole document)."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels, self.at, self.held = Levels(window), {}, 0

    def put(self, document, ids: np.ndarray):
        """Place a document; yields the windows that are full, as lists of pieces."""
        n, start = len(ids), 0
        while n - start >= self.window:
            yield [(document, start, ids[start: start + self.window], n)]
            start += self.window
        if start < n:
            piece = (document, start, ids[start:], n)
            level = self.levels.best(n - start)
            pieces = self._take(level) if level else []
            pieces.append(piece)
            level += n - start
            if level == self.window:
                yield pieces
            else:
                self._open(level, pieces)
                if self.held > self.max_open:
                    yield from self.close(self.max_open // 2)

    def _open(self, level: int, pieces: list) -> None:
        self.at.setdefault(level, []).append(pieces)
        self.levels.add(level, 1)
        self.held += 1

    def _take(self, level: int) -> list:
        pieces = self.at[level].pop()
        if not self.at[level]:
            del self.at[level]
        self.levels.add(level, -1)
        self.held -= 1
        return pieces

    def close(self, left: int):
        """Complete the fullest windows from the emptiest until ``left`` are open."""
        while self.held > max(left, 1):
            level = max(self.at)
            pieces = self._take(level)
            while level < self.window and self.held:
                low = min(self.at)
                rest = self._take(low)
                room = self.window - level
                while rest and room:
                    document, start, ids, n = rest.pop()
                    pieces.append((document, start, ids[:room], n))
                    if len(ids) > room:
                        rest.append((document, start + room, ids[room:], n))
                    room -= len(pieces[-1][2])
                if rest:
                    self._open(sum(len(p[2]) for p in rest), rest)
                level = self.window - room
            if level == self.window:
                yield pieces
            else:
                self._open(level, pieces)

    def end(self):
        """Complete all windows; the last one is cut into powers of two, largest first."""
        yield from self.close(1)
        if not self.held:
            return
        (level,) = self.at
        rest = self._take(level)[::-1]
        while level:
            size = 1 << (level.bit_length() - 1)
            level -= size
            pieces = []
            while size:
                document, start, ids, n = rest.pop()
                pieces.append((document, start, ids[:size], n))
                if len(ids) > size:
                    rest.append((document, start + size, ids[size:], n))
                size -= len(pieces[-1][2])
            yield pieces


_NAMES = ["doc_id", "document", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def _pieces(path: str, window: int, end: int, max_open: int):
    def run(batches):
        tokens = Tokens(path)
        part = TaskContext.get().partitionId()
        packer, rows, size, sequence, document = Packer(window, max_open), [], 0, part << 33, part << 33
        kind = None

        def flush():
            ids = [r[4].tobytes() for r in rows]
            cols = list(zip(*rows))
            kinds = [kind, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            cols[4] = ids
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], _NAMES)

        def windows(full):
            nonlocal sequence, rows, size
            for pieces in full:
                at = 0
                for (doc_id, number), start, ids, n in pieces:
                    rows.append((doc_id, number, start, len(ids), ids, n, sequence, at))
                    at += len(ids)
                sequence += 1
                size += 4 * at
                if size >= BYTES:
                    yield flush()
                    rows, size = [], 0

        for b in batches:
            kind = b.schema.field(0).type
            names, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            first = 0
            while first < len(texts):
                last, size_of = first, 0
                while last < len(texts) and size_of < CHARACTERS:
                    size_of += 1 + len(texts[last])
                    last += 1
                for i, ids in enumerate(tokens.ids(texts[first:last])):
                    yield from windows(packer.put((names[first + i], document), np.append(ids, np.uint32(end))))
                    document += 1
                first = last
        yield from windows(packer.end())
        if rows:
            yield flush()

    return run


def pack(df: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, max_open: int = MAX_OPEN) -> DataFrame:
    """Pieces of ``df`` (doc_id, text): doc_id, document, start, length, ids (binary,
    little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a ``tokenizers`` JSON file that every executor
    can open; ``window`` is a power of two.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two")
    kind = df.select("doc_id").schema[0].dataType.simpleString()
    schema = (f"doc_id {kind}, document long, start long, length long, ids binary, doc_tokens long, "
              "sequence_id long, offset long")
    rows = df.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_pieces(tokenizer, window, end, max_open), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, ids (binary, in order), length, and the
    documents with their offsets, for attention masks that keep documents apart."""
    return (pieces.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "document", "start", "length", "ids"))).alias("p"))
            .select("sequence_id",
                    F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
                    F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("length"),
                    F.transform("p", lambda x: x.dropFields("ids")).alias("pieces")))


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the check sum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "document")
