"""Bounded-space online packing of tokenised documents into fixed windows.

Each partition keeps a fixed number of open windows. A document's full windows go out at once; its rest is
placed where it fits best. If it fits nowhere, the fullest window is topped up with its first ids and goes
out. At the end the open windows are merged into full ones, and what each partition has left (less than one
window) is merged in groups of partitions, round by round, until one is left. So at most one window in
all is padded, and a merge task gets a bounded number of ids.

Tokenising: the vocabulary drops white space, so a text's ids are those of its pieces between ASCII white
space; a bounded cache keeps the ids of pieces, and pieces it lacks are encoded many at once, with a
separator between them. A word of ASCII letters and the marks after it are encoded apart, so that a word is encoded once,
whatever follows it.

Edge cases: a null or empty text is just the end id. Repeated rows and doc_ids are packed as they come; a
null doc_id stays null. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, slices, spool, text_of

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part int, ids binary"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
TYPES = [pa.int64()] * 7 + [pa.int32(), pa.binary()]
MARK = "\x01"
#: Marks at a word's end that are tokens of their own.
ENDS = b".,;:!?"
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of texts as packed little-endian 32-bit numbers."""

    #: Pieces that are kept; beyond this the cache starts anew. After a task only the first ones stay.
    MOST, STAY = 600_000, 100_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.mark = self.model.encode(MARK, add_special_tokens=False).ids
        self.cache: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def rest(self) -> None:
        """Give back most of the memory: workers live longer than a task."""
        self.cache = dict(islice(self.cache.items(), self.STAY))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, rows: list[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts. The vocabulary has no capitals, so A-Z are lowered before pieces are looked up."""
        pieces = [r.lower().split() for r in rows]
        cache = self.cache
        if len(cache) > self.MOST:
            cache.clear()
        own = dict.fromkeys(chain.from_iterable(pieces))  # small and near, against the cache
        lacking = []
        for x in own:
            found = cache.get(x)
            if found is None:
                lacking.append(x)
            else:
                own[x] = found
        plain, ended = dict.fromkeys(x for x in lacking if len(x) < 64 and b"\x01" not in x), []
        for x in [*plain]:
            word = x.rstrip(ENDS)
            if len(word) < len(x) and word.isalpha():  # ASCII letters: the pattern parts them from the marks after them
                ended.append((x, word, x[len(word) :]))
                del plain[x]
        for _, *parts in ended:
            for y in parts:
                if y not in own and y not in cache:
                    plain[y] = None
        plain = [*plain]
        runs = [plain[j : j + 500] for j in range(0, len(plain), 500)]
        for run, ids in zip(runs, self._ids([f" {MARK} ".join([x.decode() for x in run]) for run in runs]), strict=True):
            raw, at = ids.tobytes(), 0
            ends = (4 * np.flatnonzero(ids == self.mark[0])).tolist()
            for x, end in zip(run, [*ends, len(raw)], strict=True):
                own[x] = cache[x] = raw[at:end]
                at = end + 4
        for x, word, marks in ended:
            own[x] = cache[x] = (own.get(word) or cache[word]) + (own.get(marks) or cache[marks])
        odd = [x for x in lacking if not (len(x) < 64 and b"\x01" not in x)]
        if odd:
            own.update(zip(odd, [i.tobytes() for i in self._ids([x.decode() for x in odd])], strict=True))
        get = own.__getitem__
        return [b"".join(map(get, p)) for p in pieces]


class Packer:
    """Places (doc_id, start, ids, doc_tokens) pieces; yields finished windows as lists of them."""

    def __init__(self, size: int = 2048, windows: int = 64):
        self.size, self.most = size, windows
        self.open: dict[int, list] = {}
        self.free: list[tuple[int, int]] = []
        self.number = 0

    def _put(self, key: int, room: int, piece) -> None:
        self.open[key].append(piece)
        insort(self.free, (room - len(piece[2]) // 4, key))

    def add(self, doc, start: int, ids: bytes, total: int) -> Iterator[list]:
        whole = 4 * self.size
        at = 0
        while len(ids) - at >= whole:
            yield [(doc, start + at // 4, ids[at : at + whole], total)]
            at += whole
        ids, start = ids[at:], start + at // 4
        while ids:
            n = len(ids) // 4
            i = bisect_left(self.free, (n, -1))
            if i < len(self.free):
                room, key = self.free.pop(i)
                self._put(key, room, (doc, start, ids, total))
                return
            if len(self.open) < self.most:
                self.number += 1
                self.open[self.number] = []
                self._put(self.number, self.size, (doc, start, ids, total))
                return
            room, key = self.free.pop(0)
            window = self.open.pop(key)
            if room:
                window.append((doc, start, ids[: 4 * room], total))
                ids, start = ids[4 * room :], start + room
            yield window

    def close(self) -> Iterator[tuple[list, bool]]:
        """The open windows merged into (window, whether it is full); at most the last isn't full."""
        window, room = [], self.size
        for _, key in self.free:
            for doc, start, ids, total in self.open[key]:
                while ids:
                    cut = 4 * min(room, len(ids) // 4)
                    window.append((doc, start, ids[:cut], total))
                    ids, start, room = ids[cut:], start + cut // 4, room - cut // 4
                    if not room:
                        yield window, True
                        window, room = [], self.size
        if window:
            yield window, False
        self.open, self.free = {}, []


class _Rows:
    """Collects windows as rows of SCHEMA."""

    def __init__(self, base: int, part: int):
        self.next, self.part, self.rows = base, part, []

    def take(self, window: list, left: bool = False) -> None:
        at = 0
        for doc, start, ids, total in window:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next, at, self.part, ids if left else None))
            at += n
        self.next += 1

    def batches(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > least:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), TYPES, strict=True)], NAMES)
            self.rows = []


def _pack(path: str, end: int, size: int, windows: int):
    def run(batches):
        from pyspark import TaskContext

        encoder, part = Encoder.of(path), TaskContext.get().partitionId()
        packer, out, last = Packer(size, windows), _Rows(part << 32, part), np.uint32(end).tobytes()
        for batch in batches:
            texts, docs = text_of(batch, "text"), batch.column("doc_id").to_pylist()
            for at, _, data, offsets in slices(texts):
                raw = data.tobytes()
                rows = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                for doc, ids in zip(docs[at:], encoder.encode(rows), strict=False):
                    for window in packer.add(doc, 0, ids + last, len(ids) // 4 + 1):
                        out.take(window)
                yield from out.batches(5000)
        encoder.rest()
        for window, full in packer.close():
            out.take(window, not full)
        yield from out.batches()

    return run


def _merge(rounds: int, size: int, windows: int):
    def run(key, table):
        group = key[0].as_py()
        packer, out = Packer(size, windows), _Rows((rounds << 58) | (group << 32), group)
        for r in sorted(table.to_pylist(), key=lambda r: (r["part"], r["offset"])):
            for window in packer.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"]):
                out.take(window)
        for window, full in packer.close():
            out.take(window, not full)
        return pa.Table.from_batches(list(out.batches()), pa.schema(list(zip(NAMES, TYPES, strict=True))))

    return run


def pack(documents: DataFrame, path: str, *, end: int = 1, size: int = 2048, windows: int = 64, fan: int = 64) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of ``size`` ids; ``end`` closes each document.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. fan: leftovers that one task merges.
    """
    rows = spool(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack(path, end, size, windows), SCHEMA), "packed")
    done, left, rounds = rows.where("ids IS NULL"), rows.where("ids IS NOT NULL"), 0
    while left.select("part").distinct().limit(2).count() > 1:
        rounds += 1
        merged = left.groupBy(F.expr(f"part div {fan}").alias("g")).applyInArrow(_merge(rounds, size, windows), SCHEMA)
        merged = spool(merged, "merged")
        done, left = done.union(merged.where("ids IS NULL")), merged.where("ids IS NOT NULL")
    return done.union(left).drop("part", "ids")


def op4_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 ids."""
    import public_tokenizers

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
