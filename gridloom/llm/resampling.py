"""Importance resampling towards a target: documents drawn by how much likelier their features are there.

Features are single words and pairs of neighbouring words, hashed (CRC-32) to buckets. The document-by-bucket
count matrix is written once, as compressed sparse rows in blocks of some documents. Its column sums give the
distribution of all documents, those of the target's matrix the target's; the gain of a bucket is the rounded
logarithm of their ratio. The product of the sparse matrix with the gains, divided by each document's number of
features, is its weight. Weights plus Gumbel noise from a hash of the doc_id rank the documents, so the highest
are a draw without replacement in proportion to the exponentials of the weights.

CRC-32 is linear: a pair's value comes from the first word's register, moved over a space and over as many zero
bytes as the second word has, and from the second word's own. So each byte is looked at once.

Ranking: a histogram of the scores, whole numbers of bounded range, gives the lowest that is drawn; the rows from
there on are sorted by ranges, and ranks are places within a range plus the sizes of the ranges before it.

Edge cases: a null or empty text, or one without words, has no features and weight 0. Only documents with at least
``least`` words can be drawn. A null doc_id has the noise of an empty one and comes last among ties; repeated rows
are documents of their own. Texts of any length are taken whole, long ones in pieces that end between words. With
an empty target all gains follow from its counts of 0. Empty documents give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import each_batch, read, short_batches, slices, small_reads, spool, text_of

WORDS = K.classes(0x30)
FULL = np.uint32(0xFFFFFFFF)
#: Words up to so many bytes go through tables; longer ones one by one.
SHORT = 64
#: Bytes of a long text that are looked at together.
PIECE = 1 << 20
#: Blocks of the matrix, some 0.3 MB each, that a task reads and sends to Python together.
BLOCKS = 16


@dataclass(frozen=True)
class Resampling:
    buckets: int = 10_000
    percent: int = 25
    #: Words that a document needs to be drawn.
    least: int = 20
    seed: int = 7


def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0xEDB88320), x >> 1)
    return x


STEP = _byte_table()


def _moves() -> np.ndarray:
    """[n, k, b]: what byte k of a register, of value b, adds to the register after n zero bytes."""
    x = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    out = [x]
    for _ in range(SHORT):
        x = STEP[x & 255] ^ (x >> 8)
        out.append(x)
    return np.stack(out)


MOVES = _moves()
MOVED_FULL = MOVES[:, 0, 255] ^ MOVES[:, 1, 255] ^ MOVES[:, 2, 255] ^ MOVES[:, 3, 255]


def registers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 register after each word, from the full one."""
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, SHORT + 1), kind="stable")
    at, size, out = starts[order], sizes[order], np.full(len(starts), FULL)
    long = int((size > SHORT).sum())
    for i in range(long):
        out[i] = zlib.crc32(data[at[i] : at[i] + size[i]]) ^ 0xFFFFFFFF
    at, size, short = at[long:], size[long:], out[long:]
    active = len(size) - np.searchsorted(size[::-1], np.arange(1, (size[0] if len(size) else 0) + 1))
    for k, n in enumerate(active):
        r = short[:n]
        short[:n] = STEP[(r ^ data[at[:n] + k]) & 255] ^ (r >> 8)
    back = np.empty_like(out)
    back[order] = out
    return back


def pair_registers(data, starts, ends, first: np.ndarray, second: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The registers after ``word space word``: first are registers of words, second numbers of words, own registers of all."""
    moved = STEP[(first ^ 32) & 255] ^ (first >> 8)
    sizes = (ends - starts)[second]
    n = np.minimum(sizes, SHORT)
    out = own[second] ^ MOVED_FULL[n]
    for k in range(4):
        out ^= MOVES[n, k, (moved >> np.uint32(8 * k)) & 255]
    for i in np.flatnonzero(sizes > SHORT):
        w = second[i]
        out[i] = zlib.crc32(data[starts[w] : ends[w]], int(moved[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return out


def features(data: np.ndarray, offsets: np.ndarray, before: int | None = None):
    """(CRC-32 of each feature, its row, words of each row, register of the last word), of rows of bytes; before: the register of the word before the first row."""
    data = K.FOLD[data]
    starts, ends, first = K.words(data, offsets, WORDS)
    own = registers(data, starts, ends)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    second = np.flatnonzero(row[1:] == row[:-1]) + 1
    prior, rows = own[second - 1], row[second]
    if before is not None and len(starts):
        second, prior, rows = np.append(second, 0), np.append(prior, np.uint32(before)), np.append(rows, 0)
    pairs = pair_registers(data, starts, ends, prior, second, own)
    return np.concatenate([own, pairs]) ^ FULL, np.concatenate([row, rows]), np.diff(first), int(own[-1]) if len(own) else before


def _long_row(data: np.ndarray, buckets: int, piece: int = PIECE) -> tuple[np.ndarray, int]:
    """The counts of all buckets and the number of words of one long text."""
    total, words, at, before = np.zeros(buckets, np.int64), 0, 0, None
    while at < len(data):
        end = min(at + piece, len(data))
        while end < len(data) and not WORDS[data[end]]:
            end += 1
        found, _, n, before = features(data[at:end], np.array([0, end - at]), before)
        total += np.bincount(found % buckets, minlength=buckets)
        words, at = words + int(n[0]), end
    return total, words


_BLOCK = "doc_id array<long>, words array<long>, indptr array<long>, indices array<int>, counts array<int>"


def count_matrix(documents: DataFrame, buckets: int) -> DataFrame:
    """Blocks of rows (doc_id, words, indptr, indices, counts) of documents (doc_id, text), written to the shared folder."""

    def make():
        def run(batch):
            ids, texts = batch.column("doc_id"), text_of(batch, "text")
            for at, end, data, offsets in slices(texts):
                if len(data) > 4 * PIECE:
                    total, n = _long_row(data, buckets)
                    indices = np.flatnonzero(total)
                    counts, words, indptr = total[indices], np.array([n]), np.array([0, len(indices)])
                else:
                    found, row, words, _ = features(data, offsets)
                    key, counts = np.unique(row * buckets + (found % buckets), return_counts=True)
                    rows, indices = np.divmod(key, buckets)
                    indptr = np.searchsorted(rows, np.arange(end - at + 1))
                one = lambda x, t: pa.array([x], pa.list_(t))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, end - at], pa.int32()), ids.slice(at, end - at).cast(pa.int64())), one(words.astype(np.int64), pa.int64()), one(indptr.astype(np.int64), pa.int64()), one(indices.astype(np.int32), pa.int32()), one(counts.astype(np.int32), pa.int32())],
                    ["doc_id", "words", "indptr", "indices", "counts"],
                )

        return run

    return spool(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each_batch(make), _BLOCK), "matrix")


def _rows_of(column) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)


def column_sums(matrix: DataFrame, buckets: int) -> np.ndarray:
    """The matrix's sums by bucket; a row of sums for each task and bucket is what moves."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for indices, counts in zip(batch.column("indices"), batch.column("counts"), strict=True):
                total += np.bincount(_rows_of(indices), _rows_of(counts), buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    with short_batches(matrix.sparkSession, BLOCKS), small_reads(matrix.sparkSession, BLOCKS):
        found = matrix.select("indices", "counts").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths of a natural logarithm."""
    k = len(source)
    ratio = (target + 1.0) * (float(source.sum()) + k) / ((source + 1.0) * (float(target.sum()) + k))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(matrix: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_features, weight) of the matrix's rows: its product with gain over the number of features."""
    sent = matrix.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        for batch in batches:
            for ids, words, indptr, indices, counts in zip(*(batch.column(c) for c in ("doc_id", "words", "indptr", "indices", "counts")), strict=True):
                words, indptr = _rows_of(words), _rows_of(indptr)
                sums = np.concatenate([[0], np.cumsum(sent.value[_rows_of(indices)] * _rows_of(counts).astype(np.int64))])
                n = np.maximum(2 * words - 1, 0)
                mean = (sums[indptr[1:]] - sums[indptr[:-1]]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(n), pa.array(mean)], ["doc_id", "n_features", "weight"])

    return matrix.mapInArrow(run, "doc_id long, n_features long, weight long")


def ranked(scored: DataFrame, may, count: int) -> DataFrame:
    """scored (doc_id, score, ...), a spooled table, with rank: 1 to count for the highest scores of the rows for which may holds, ties to smaller doc_ids."""
    histogram = sorted(((r["score"], r["n"]) for r in scored.where(may).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    none = F.lit(None).cast("long")
    seen = 0
    for low, n in histogram:
        seen += n
        if seen >= count:
            break
    if not histogram or count <= 0:
        return scored.withColumn("rank", none)
    drawn = may & (F.col("score") >= low)
    # the last key parts equal rows, so that many of them need not be in one range
    order = scored.where(drawn).withColumn("seq", F.monotonically_increasing_id()).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "seq").drop("seq")
    order = spool(order.withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33).alias("part")
    sizes = sorted((r["part"], r["n"]) for r in order.groupBy(part).agg(F.count("*").alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])])
    shift = scored.sparkSession.createDataFrame([(p, int(b)) for (p, _), b in zip(sizes, before, strict=False)], "part long, before long")
    rank = F.col("before") + F.col("place") - F.shiftleft("part", 33) + 1
    placed = order.withColumn("part", part).join(F.broadcast(shift), "part").withColumn("rank", F.when(rank <= count, rank))
    return placed.select(*scored.columns, "rank").union(scored.where(~F.coalesce(drawn, F.lit(False))).withColumn("rank", none))


def resample(documents: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of documents (doc_id, text) for a target (text); rank is null for what isn't drawn."""
    with short_batches(documents.sparkSession, 1000):
        matrix = count_matrix(documents, how.buckets)
        aim = count_matrix(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), how.buckets)
    gain = gains(column_sums(matrix, how.buckets), column_sums(aim, how.buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    with short_batches(documents.sparkSession, BLOCKS), small_reads(documents.sparkSession, BLOCKS):
        scored = spool(weights(matrix, gain).withColumn("score", F.col("weight") + noise), "scored")
    may = F.col("n_features") >= 2 * how.least - 1
    return ranked(scored, may, how.percent * scored.where(may).count() // 100)


def op11_importance_resampling(spark, sf_dir):
    """Documents drawn towards the texts of benchmark."""
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH tab AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i)) AS t),
texts AS (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS text, FALSE AS aim FROM documents UNION ALL SELECT row_number() OVER (), NULL, coalesce(text, ''), TRUE FROM benchmark),
words AS (SELECT no, doc_id, aim, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
f AS (SELECT no, aim, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words),
each AS (SELECT DISTINCT feature FROM f),
codes AS (SELECT feature, hex(encode(feature)) AS code FROM each),
crc AS (SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(code) // 2), lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM codes, tab),
n AS (SELECT no, aim, bucket, count(*) AS n FROM f JOIN crc USING (feature) GROUP BY no, aim, bucket),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE NOT aim), 0) AS s, coalesce(sum(n) FILTER (WHERE aim), 0) AS t FROM n GROUP BY bucket),
total AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM sums),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((sums.t + 1) AS DOUBLE) * (total.s + 10000) / (CAST((sums.s + 1) AS DOUBLE) * (total.t + 10000)))) AS BIGINT) AS g FROM sums, total),
w AS (SELECT no, CAST(floor(sum(n * g) / sum(n)) AS BIGINT) AS weight FROM n JOIN gain USING (bucket) WHERE NOT aim GROUP BY no),
h AS (SELECT no, doc_id, CAST(greatest(2 * len(w) - 1, 0) AS BIGINT) AS n_features, CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM words WHERE NOT aim),
scored AS (SELECT doc_id, n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score, n_features >= 39 AS may FROM h LEFT JOIN w USING (no)),
placed AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) OVER (PARTITION BY may) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND r <= 25 * n // 100 THEN r END AS rank FROM placed
"""
