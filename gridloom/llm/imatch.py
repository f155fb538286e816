"""I-Match fingerprints.

A term counts if its share of all documents lies in a band. A document's terms in the band, distinct and
sorted, are hashed as a whole, and again for several randomised subsets of that lexicon: subset (j, r) keeps
a term with chance 1 / 2**r, and each next r keeps half of what the one before kept. Of the rates the
fingerprint holds the first at which at most half of the subsets keep a term of the document, and the two
after it, so that a hash stands for one or two terms whatever the document's length. The likeness of two
fingerprints is the share of equal hashes among the subsets of common rates in which either has terms; it
follows the share of common terms. Documents whose numbers of terms differ more than some eightfold have no
common rate and no likeness.

Document frequencies are exact. Each partition first reports the terms that reach the band's lower share
there (or all, if it has few documents), which every term of the band does somewhere; those are then
counted everywhere. At most ``mean distinct terms / low`` terms can reach the lower share, however large
the corpus is, so the lexicon that tasks get is bounded.

Edge cases: a null text counts as empty. A text without terms in the band is fingerprinted by all its
terms; one without words has a constant fingerprint. Rows are ordered by doc_id, null first, then by the
text's hash; the next of the last is the first (a single row is its own next). An empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import read, slices, text_of


@dataclass(frozen=True)
class Band:
    """Least and greatest share of documents, number of subsets of each rate, and rates that a fingerprint holds."""

    low: float = 0.002
    high: float = 0.1
    subsets: int = 32
    rates: int = 3
    seed: int = 11

    def depths(self, terms: np.ndarray) -> np.ndarray:
        """For each term (row) and subset number (column) the last rate that keeps it, up to 31."""
        out = np.empty((len(terms), self.subsets), np.uint8)
        for j in range(self.subsets):
            x = K.mix(terms ^ K.mix(np.array([self.seed * 1000 + j], np.uint64))) >> K.U(33) | K.U(1)
            out[:, j] = 31 - np.frexp(x.astype(np.float64))[1]  # leading zeros of 31 bits
        return out


def term_sets(data: np.ndarray, offsets: np.ndarray):
    """For each row its sorted distinct terms, hashed."""
    starts, ends, first = K.words(data, offsets)
    hashed = K.word_hashes(data, starts, ends)
    for r in range(len(offsets) - 1):
        yield np.unique(hashed[first[r] : first[r + 1]])


def _counts(terms, counts, slack) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(counts, pa.int64()), pa.array(slack, pa.float64())], ["term", "n", "slack"])


def _local(low: float):
    """Rows (term, n, slack): terms that reach the share low here; and (null, documents, slack)."""

    def run(batches):
        kept, sums, waiting, size, docs = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0, 0

        def merge():
            nonlocal kept, sums, waiting, size
            both = np.concatenate([kept, *waiting])
            weight = np.concatenate([sums, np.ones(size, np.int64)])
            kept, back = np.unique(both, return_inverse=True)
            sums, waiting, size = np.bincount(back, weight, len(kept)).astype(np.int64), [], 0

        for batch in batches:
            docs += batch.num_rows
            for _, _, data, offsets in slices(text_of(batch, "text"), 1 << 17):
                for x in term_sets(data, offsets):
                    waiting.append(x)
                    size += len(x)
                if size > 2_000_000:
                    merge()
        merge()
        slack = low * docs if low * docs > 2 else 0.0
        often = sums >= slack
        terms, n = kept[often].view(np.int64), sums[often]
        yield _counts([None], [docs], [slack])
        for i in range(0, len(terms), 100_000):
            yield _counts(terms[i : i + 100_000], n[i : i + 100_000], np.full(len(terms[i : i + 100_000]), slack))

    return run


def _exact(candidates):
    def run(batches):
        known = np.frombuffer(candidates.value, np.uint64)
        sums = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(text_of(batch, "text"), 1 << 17):
                found = np.concatenate([np.zeros(0, np.uint64), *term_sets(data, offsets)])
                at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
                if len(known):
                    sums += np.bincount(at[known[at] == found], minlength=len(known))
        hit = np.flatnonzero(sums)
        yield _counts(known[hit].view(np.int64), sums[hit], np.zeros(len(hit)))

    return run


def lexicon(documents: DataFrame, band: Band) -> np.ndarray:
    """The sorted hashes of the terms in the band."""
    spark = documents.sparkSession
    schema = "term long, n long, slack double"
    local = documents.select("text").mapInArrow(_local(band.low), schema).groupBy("term").agg(F.sum("n").alias("n"), F.sum("slack").alias("slack"))
    from .common import spool

    local = spool(local, "terms")
    total = local.where("term IS NULL").first()
    if not total or not total["n"]:
        return np.zeros(0, np.uint64)
    docs, slack = total["n"], total["slack"]
    least, most = band.low * docs, band.high * docs
    found = local.where("term IS NOT NULL").where((F.col("n") + slack - F.col("slack")) >= least - 1e-6)
    if slack:
        terms = np.sort(found.select("term").toPandas()["term"].to_numpy(np.int64).view(np.uint64))
        shared = spark.sparkContext.broadcast(terms.tobytes())
        found = documents.select("text").mapInArrow(_exact(shared), schema).groupBy("term").agg(F.sum("n").alias("n"))
    kept = found.where((F.col("n") >= least) & (F.col("n") <= most)).select("term").toPandas()["term"]
    return np.sort(kept.to_numpy(np.int64).view(np.uint64))


class Fingerprints:
    """Fingerprints by a lexicon."""

    def __init__(self, terms: np.ndarray, band: Band):
        self.terms, self.band, self.depth = terms, band, band.depths(terms)

    def of_set(self, x: np.ndarray) -> str:
        """x: sorted distinct terms of a text. ``i`` or ``t`` (terms in the band, or all), the whole hash, then ``/rate:number=hash,...``."""
        at = np.minimum(np.searchsorted(self.terms, x), max(len(self.terms) - 1, 0))
        hit = self.terms[at] == x if len(self.terms) else np.zeros(len(x), bool)
        if hit.any():
            x, depth, sort = x[hit], self.depth[at[hit]], "i"
        else:
            depth, sort = self.band.depths(x), "t"
        out = [sort + hashlib.blake2b(x.tobytes(), digest_size=8).hexdigest()]
        if len(x):
            top = depth.max(axis=0)
            first = next(r for r in range(1, 33) if 2 * np.count_nonzero(top >= r) <= self.band.subsets)
            for r in range(first, first + self.band.rates):
                cells = [f"{j}={hashlib.blake2b(x[depth[:, j] >= r].tobytes(), digest_size=4).hexdigest()}" for j in np.flatnonzero(top >= r)]
                out.append(f"{r}:{','.join(cells)}")
        return "/".join(out)

    def of(self, texts: list[str]) -> list[str]:
        array = pa.array(texts, pa.string())
        return [self.of_set(x) for _, _, data, offsets in slices(array, 1 << 17) for x in term_sets(data, offsets)]

    @classmethod
    def likeness(cls, a: str, b: str) -> float:
        if a == b:
            return 1.0
        if a[0] != b[0]:
            return 0.0
        one, two = (dict(part.split(":") for part in f.split("/")[1:]) for f in (a, b))
        same = either = 0
        for rate in one.keys() & two.keys():
            x, y = (set(cells.split(",")) - {""} for cells in (one[rate], two[rate]))
            same += len(x & y)
            either += len({c.split("=")[0] for c in x | y})
        return same / either if either else 0.0


def add_fingerprint(documents: DataFrame, band: Band = Band()) -> DataFrame:
    """documents and one more column, ``fingerprint``."""
    from pyspark.sql.types import StringType, StructType

    shared = documents.sparkSession.sparkContext.broadcast(lexicon(documents, band).tobytes())

    def run(batches):
        prints = Fingerprints(np.frombuffer(shared.value, np.uint64), band)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.of(text_of(batch, "text").to_pylist()))], [*batch.schema.names, "fingerprint"])

    return documents.mapInArrow(run, StructType([*documents.schema.fields]).add("fingerprint", StringType()))


def _places(ids: pa.Array, hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The part of each row: by doc_id, and by the text's hash where one doc_id takes several parts."""
    x = ids.fill_null(-(1 << 63)).to_numpy()
    low, high = np.searchsorted(edges, x, "left"), np.searchsorted(edges, x, "right")
    share = hashes.astype(np.float64) / 2.0**64 + 0.5
    return (low + np.floor(share * np.maximum(high - low, 1)).astype(np.int64).clip(0, np.maximum(high - low - 1, 0))).astype(np.int32)


def _deal(bounds: list, before: dict | None, keys: list[int]):
    """Rows (part, slot, ghost, doc_id, hash, text); the first document of a part also goes, as a ghost, to the part before it.

    slot: a number that hash partitioning sends to a task of its own for each part.
    """
    names = ["part", "slot", "ghost", "doc_id", "hash", "text"]

    def run(batches):
        edges, slots = np.array(bounds, np.int64), np.array(keys, np.int64)
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("hash")
            part = _places(ids, hashes.to_numpy(), edges)
            if before is None:
                yield pa.RecordBatch.from_arrays([pa.array(part), ids, hashes], ["part", "doc_id", "hash"])
                continue
            own = pa.RecordBatch.from_arrays([pa.array(part), pa.array(slots[part]), pa.array(np.zeros(len(part), bool)), ids, hashes, text_of(batch, "text")], names)
            yield own
            first = [(i, before[x]) for i, x in enumerate(zip(ids.to_pylist(), hashes.to_pylist(), strict=True)) if x in before]
            if first:
                some, to = own.take(pa.array([i for i, _ in first])), np.array([p for _, p in first], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(slots[to]), pa.array(np.ones(len(to), bool)), *some.columns[3:]], names)

    return run


def _slots(spark, parts: int) -> list[int]:
    """For each part a number that hash partitioning by so many parts sends to it."""
    rows = spark.range(0, 40 * parts + 200).groupBy(F.pmod(F.hash("id"), F.lit(parts)).alias("p")).agg(F.min("id").alias("id")).collect()
    found = {r["p"]: r["id"] for r in rows}
    return [found.get(p, p) for p in range(parts)]


PAIRS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(shared, band: Band):
    def run(batches):
        prints = Fingerprints(np.frombuffer(shared.value, np.uint64), band)
        last = None
        for batch in batches:
            parts, ghosts, ids = (batch.column(c).to_pylist() for c in ("part", "ghost", "doc_id"))
            texts = text_of(batch, "text").to_pylist()
            rows, edited = [], []
            for row in zip(parts, ghosts, ids, texts, prints.of(texts), strict=True):
                if last and not last[1] and last[0] == row[0]:
                    text, half = last[3], len(last[3]) // 2
                    edited.append(text[: len(text) - half] + row[3][:half])
                    rows.append((last[2], len(text), last[4], row[4]))
                last = row
            out = [(i, n, hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), own, other, prints.likeness(own, other), prints.likeness(own, after)) for (i, n, own, after), e, other in zip(rows, edited, prints.of(edited), strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(zip(*out, strict=True))], [x.split()[0] for x in PAIRS.split(", ")])

    return run


def compare_with_next(documents: DataFrame, band: Band = Band()) -> DataFrame:
    """Each document's fingerprint against those of its edited text and of the next document.

    Parts are ranges of doc_id, and of the text's hash for a doc_id of very many rows; each also gets the
    first document of the next, so texts move once and tasks read their rows in order, one behind the other.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), "text")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * docs.rdd.getNumPartitions())
    found = docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts) if docs.where("doc_id IS NOT NULL").take(1) else []
    bounds, keys = sorted(int(x) for x in found), _slots(spark, parts + 1)
    low = F.min(F.struct("doc_id", "hash")).alias("first")
    firsts = docs.select("doc_id", "hash").mapInArrow(_deal(bounds, None, keys), "part int, doc_id long, hash long").groupBy("part").agg(low).orderBy("part").collect()
    before = {tuple(r["first"]): firsts[i - 1]["part"] for i, r in enumerate(firsts)}
    shared = spark.sparkContext.broadcast(lexicon(docs, band).tobytes())
    dealt = docs.mapInArrow(_deal(bounds, before, keys), "part int, slot long, ghost boolean, doc_id long, hash long, text string").repartition(parts + 1, "slot")
    ordered = dealt.sortWithinPartitions("part", "ghost", F.col("doc_id").asc_nulls_first(), "hash").select("part", "ghost", "doc_id", "text")
    return ordered.mapInArrow(_pairs(shared, band), PAIRS)


def op5_imatch(spark, sf_dir):
    """Fingerprints of all documents, their edited texts and their successors."""
    return compare_with_next(read(spark, sf_dir, "documents"))
