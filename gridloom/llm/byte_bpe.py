"""Byte-level BPE encoding and decoding by given ranks.

Texts of up to ``chunk`` characters are encoded as they are. Longer ones are cut, in one pass, into chunks
that are written to the shared folder and go to different tasks: each chunk's row also holds the chunk
before it and an overlap after it. Chunks are pre-tokenised from their first character, which may lie inside
a pre-token; where the pre-token starts of two neighbours first agree in their overlap, both go on alike, so
cutting there is exact, and each chunk encodes the text between its two such places. A text with two
neighbours that never agree in their overlap is put together again and encoded whole in one task. Decoding
concatenates the raw bytes of the ids.

Edge cases: a null or empty text has no ids. Special tokens in a text are ordinary text. Repeated rows and
doc_ids are encoded each for itself; a null doc_id stays null. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, short_batches, spool, text_of

_codecs: dict[tuple[str, str], "Codec"] = {}


class Codec:
    """Encoder and decoder by a file of ranks and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.encode: Callable[[str], list[int]] = self.encoding.encode_ordinary
        self.decode: Callable[[Iterable[int]], bytes] = self.encoding.decode_bytes

    @classmethod
    def of(cls, path: str, pattern: str) -> "Codec":
        if (path, pattern) not in _codecs:
            _codecs[path, pattern] = cls(path, pattern)
        return _codecs[path, pattern]

    def starts(self, text: str) -> set[int]:
        """Where pre-tokens start that no further text can move.

        Whether one starts among the last characters may depend on what follows: the pattern's longest
        fixed alternative has three characters.
        """
        return {m.start() for m in self.pattern.finditer(text) if m.start() <= len(text) - 3}

    def agreement(self, before: str, own: str) -> int | None:
        """The first place in ``own`` where a chunk that begins with it and one that begins with ``before`` both start a pre-token.

        Not after white space, which pre-tokens divide by what follows.
        """
        both, n = before + own, len(before)
        shared = self.starts(both)
        return min((x for x in self.starts(own) if x + n in shared and not both[x + n - 1 : x + n].isspace()), default=None)


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


RESULT = "doc_id long, n_tokens long, ids binary"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _whole(path: str, pattern: str):
    def run(batches):
        codec = Codec.of(path, pattern)
        for batch in batches:
            ids, size, docs, counts = [], 0, [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), text_of(batch, "text"), strict=True):
                found = codec.encode(text.as_py())
                ids.append(np.array(found, np.uint32).tobytes())
                docs.append(doc)
                counts.append(len(found))
                size += len(found)
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], schema=_RESULT)
                    ids, size, docs, counts = [], 0, [], []
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], schema=_RESULT)

    return run


CHUNKS = "row long, doc_id long, i int, before string, own string, after string"


def _cut(chunk: int, overlap: int):
    """Rows (row, doc_id, i, before, own, after) of each text's chunks; row numbers the texts, by task and place."""

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 36
        names = [x.split()[0] for x in CHUNKS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text, row = text.as_py(), row + 1
                for at in range(0, len(text), 16 * chunk):
                    cuts = range(at, min(at + 16 * chunk, len(text)), chunk)
                    rows = [(row, doc, x // chunk, text[max(0, x - chunk) : x], text[x : x + chunk], text[x + chunk : x + chunk + overlap]) for x in cuts]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return run


PIECES = "row long, doc_id long, i int, ids binary"


def _pieces(path: str, pattern: str, overlap: int):
    """ids of each chunk (row, doc_id, i, before, own, after): null if it doesn't agree with a neighbour."""

    def run(batches):
        codec = Codec.of(path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 16):
                part, out = batch.slice(i, 16), []
                for before, own, after in zip(part.column("before"), part.column("own"), part.column("after"), strict=True):
                    before, own, after = before.as_py(), own.as_py(), after.as_py()
                    begin = codec.agreement(before, own[:overlap]) if before else 0
                    end = codec.agreement(own, after) if after else 0
                    out.append(None if begin is None or end is None else np.array(codec.encode((own + after[:end])[begin:]), np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "doc_id", "i")), pa.array(out, pa.binary())], ["row", "doc_id", "i", "ids"])

    return run


def _one(doc, ids: bytes) -> pa.Table:
    return pa.table([doc, pa.array([len(ids) // 4], pa.int64()), pa.array([ids], pa.binary())], schema=_RESULT)


def _stitched(table: pa.Table) -> pa.Table:
    """One text's pieces to its ids; none if a piece has no ids."""
    table = table.sort_by("i")
    if table.column("ids").null_count:
        return _RESULT.empty_table()
    return _one(table.column("doc_id").slice(0, 1), b"".join(table.column("ids").to_pylist()))


def _together(path: str, pattern: str):
    """One text's chunks, put together and encoded whole."""

    def run(table):
        table = table.sort_by("i")
        ids = Codec.of(path, pattern).encode("".join(table.column("own").to_pylist()))
        return _one(table.column("doc_id").slice(0, 1), np.array(ids, np.uint32).tobytes())

    return run


def encode(documents: DataFrame, path: str, pattern: str, *, chunk: int = 1 << 15, overlap: int = 1 << 10) -> DataFrame:
    """(doc_id, n_tokens, ids) for each row of documents (doc_id, text); ids: little-endian 32-bit numbers."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.length("text") > chunk
    short = rows.where(~long).mapInArrow(_whole(path, pattern), RESULT)
    with short_batches(documents.sparkSession, 50):
        cut = spool(rows.where(long).mapInArrow(_cut(chunk, overlap), CHUNKS), "chunks")
        pieces = spool(cut.repartition("row", "i").mapInArrow(_pieces(path, pattern, overlap), PIECES), "pieces")
    stitched = pieces.groupBy("row").applyInArrow(_stitched, RESULT)
    apart = pieces.where("ids IS NULL").select("row").distinct()
    whole = cut.join(apart, "row", "left_semi").select("row", "doc_id", "i", "own").groupBy("row").applyInArrow(_together(path, pattern), RESULT)
    return short.union(stitched).union(whole)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """encoded (with a column ids) and one more column, the bytes that they stand for."""

    def run(batches):
        codec = Codec.of(path, pattern)
        for batch in batches:
            out = [codec.decode(np.frombuffer(x.as_buffer(), np.uint32).tolist()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "bytes"])

    from pyspark.sql.types import BinaryType, StructType

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields]).add("bytes", BinaryType()))


def add_digests(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """encoded (with a column ids) and ids_sha256, of the decimal ids joined by commas, and decoded_sha256, of the decoded bytes."""

    def run(batches):
        codec = Codec.of(path, pattern)
        for batch in batches:
            both: list[tuple[str, str]] = []
            for x in batch.column("ids"):  # one row's numbers at a time
                ids = np.frombuffer(x.as_buffer(), np.uint32).tolist()
                both.append((_digest(ids), hashlib.sha256(codec.decode(ids)).hexdigest()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x for x, _ in both], pa.string()), pa.array([x for _, x in both], pa.string())], [*batch.schema.names, "ids_sha256", "decoded_sha256"])

    from pyspark.sql.types import StringType, StructType

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields]).add("ids_sha256", StringType()).add("decoded_sha256", StringType()))


def op6_byte_bpe(spark, sf_dir):
    """Encode and decode every document."""
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode(read(spark, sf_dir, "documents"), path, P.PATTERN)
    return add_digests(encoded, path, P.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
