"""N-gram Jaccard join with adaptive multi-match prefixes, and the classes of linked documents.

A document is the set of its distinct k-word shingles, as 64-bit hashes. Shingles are put in one global
order, rare ones first, by a table of counts over all documents. The first ``n - T + l`` shingles of a set
of n, with T the least overlap that a partner needs, are its prefix; two sets that reach the threshold
share at least min(l, l') shingles of their prefixes. Each document's l is chosen by the estimated cost of
its candidates: reading more postings against verifying fewer pairs.

Only the classes of linked documents are asked for, so pairs within a group aren't all made: in each
shingle's posting list every document is first held against one pivot, and what that links is merged.
Then the pairs that still join different classes, and share enough shingles, are all verified; none is
dropped. Exact copies of a set are merged beforehand.

Texts are the nodes: rows of one doc_id with unlike texts get a node each, beside the doc_id itself. Where
the class of a doc_id is asked for, they are tied together; where rows are dropped, they aren't.

Edge cases: a null or empty text, or one without words, has an empty set and is linked with nothing (a
class of its own). Fewer than k words make one shingle of the whole sequence. Rows with the same doc_id
are in one class, which all their texts link to. Rows with a null doc_id come back with a null class. An
empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import discard, short_batches, slices, spool, text_of, whole
from .graph import components

#: The order's table has a byte for each counter and goes to all tasks: a counter for each shingle of the corpus, 2**24 (16 MB) at most.
LEAST_BITS, MOST_BITS = 16, 24
#: Counters that are put together in one row, and shingles that a task counts at a time.
BLOCK = 1 << 13
RUN = 2_000_000
#: Tasks that the pairs of one frequent document are dealt out to.
PLACES = 64


@dataclass(frozen=True)
class Similarity:
    """Word shingles of k words; sets link when percent * union <= 100 * intersection."""

    k: int = 5
    percent: int = 80
    #: The longest extension of prefixes, and the cost of verifying a pair against that of reading a posting.
    most: int = 4
    verify: float = 8.0

    def least(self, n):
        """The least overlap of a set of n with any partner."""
        return (self.percent * n + 99) // 100

    def alone(self, n):
        """Whether a set of n can link with equal sets only: one shingle more is too much already."""
        return 100 * n < self.percent * (n + 1)


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("doc_id").to_numpy(zero_copy_only=False), np.int64)


def _spots_of(x: np.ndarray, counters: int) -> np.ndarray:
    """The counter of each hash: its upper bits."""
    return (x >> K.U(64 - counters.bit_length() + 1)).astype(np.int64)


def _signature(x: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a, b = K.mix(x + K.U(1)).sum(dtype=np.uint64), K.mix(x ^ K.U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return a.view(np.int64), b.view(np.int64)


def _survey(k: int):
    """Rows of two sorts: (0, doc_id, signature, n, first) of documents, and (1, counter, 0, 0, count, null) of shingles met again within a run of documents.

    first: the first document of the same set in this task; itself for the first.
    """
    names = ["sort", "a", "b", "c", "n", "first"]

    def run(batches):
        waiting, seen, size = [], {}, 0

        def again():
            nonlocal waiting, size
            tokens, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *waiting]), return_counts=True)
            waiting, size = [], 0
            spots, back = np.unique(_spots_of(tokens[counts > 1], 1 << MOST_BITS), return_inverse=True)
            counts = np.bincount(back, counts[counts > 1], len(spots)).astype(np.int64)
            for i in range(0, len(spots), 100_000):
                x = spots[i : i + 100_000]
                zero = pa.array(np.zeros(len(x), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(x), np.int32)), pa.array(x), zero, zero, pa.array(counts[i : i + 100_000]), pa.nulls(len(x), pa.int64())], names)

        for batch in batches:
            ids, texts, rows = _ids(batch), text_of(batch, "text"), []
            for at, _, data, offsets in slices(texts):
                for r, x in enumerate(K.shingle_sets(data, offsets, k)):
                    sign, own = _signature(x), ids[at + r]
                    rows.append((own, *sign, len(x), seen.setdefault(sign, own)))
                    if rows[-1][-1] == own:
                        waiting.append(x)
                        size += len(x)
                if size > RUN:
                    yield from again()
            if rows:
                columns = [pa.array(np.array(v, np.int64)) for v in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(rows), np.int32)), *columns], names)
        yield from again()

    return run


def _prefix(x: np.ndarray, level: np.ndarray, how: Similarity) -> tuple[int, np.ndarray]:
    """The l chosen for a set, and its prefix in the global order (level, hash)."""
    n, least = len(x), how.least(len(x))
    own = level[_spots_of(x, len(level))]
    order = np.argsort(own, kind="stable")
    cost = np.cumsum(np.exp2(own[order[: n - least + how.most]].astype(float)))
    reaches = np.arange(1, min(how.most, least) + 1)
    postings = cost[np.minimum(n - least + reaches, len(cost)) - 1]
    reach = int(reaches[np.argmin(postings + how.verify * postings / reaches)])
    return reach, x[order[: n - least + reach]]


def _each_prefix(batch, how: Similarity, level: np.ndarray, seen: set):
    """(doc_id, n, l, prefix) of the documents that can link with any other set; equal sets once."""
    ids, texts = _ids(batch), text_of(batch, "text")
    for at, _, data, offsets in slices(texts):
        for r, x in enumerate(K.shingle_sets(data, offsets, how.k)):
            if not how.alone(len(x)) and (sign := _signature(x)) not in seen:
                seen.add(sign)
                yield (ids[at + r], len(x), *_prefix(x, level, how))


def _probe(how: Similarity, levels):
    """Rows (token, n): how many prefixes of the first order hold a shingle."""

    def run(batches):
        level, seen, waiting, size = np.frombuffer(levels.value, np.uint8), set(), [], 0

        def counted():
            tokens, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *waiting]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts.astype(np.int64))], ["token", "n"])

        for batch in batches:
            for _, _, _, x in _each_prefix(batch, how, level, seen):
                waiting.append(x)
                size += len(x)
                if size > RUN:
                    yield counted()
                    waiting, size = [], 0
        yield counted()

    return run


def _prefixes(how: Similarity, levels):
    """Rows (token, doc_id, n, reach, at): the shingles of each document's prefix; reach is its l, at the place in its order."""

    def run(batches):
        level, seen = np.frombuffer(levels.value, np.uint8), set()
        for batch in batches:
            out = list(_each_prefix(batch, how, level, seen))
            for i in range(0, len(out), 2000):
                part = out[i : i + 2000]
                sizes = [len(o[3]) for o in part]
                rep = lambda j, t, part=part, sizes=sizes: pa.array(np.repeat(np.array([o[j] for o in part], t), sizes))
                at = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[3] for o in part]).view(np.int64)), rep(0, np.int64), rep(1, np.int32), rep(2, np.int32), pa.array(at)], ["token", "doc_id", "n", "reach", "at"])

    return run


def _sets(k: int, wanted):
    """Rows (doc_id, set) of the documents whose bit is set in wanted."""

    def run(batches):
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            spots = K.mix(_ids(batch).view(np.uint64)) % K.U(len(bits))
            batch = batch.filter(pa.array(bits[spots.astype(np.int64)]))
            ids, texts = _ids(batch), text_of(batch, "text")
            for at, end, data, offsets in slices(texts):
                packed = [x.tobytes() for x in K.shingle_sets(data, offsets, k)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at:end]), pa.array(packed, pa.binary())], ["doc_id", "set"])

    return run


def _spots(bits: int):
    def run(batches):
        found = np.zeros(bits, bool)
        for batch in batches:
            found[(K.mix(_ids(batch).view(np.uint64)) % K.U(bits)).astype(np.int64)] = True
        packed = np.packbits(found, bitorder="little").view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(packed[at])], ["at", "bits"])

    return run


def _overlaps(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(documents: DataFrame, pairs: DataFrame, how: Similarity) -> DataFrame:
    """Those of pairs (a, b) that link, as edges (u, v)."""
    spark = documents.sparkSession
    pairs = spool(pairs.select("a", "b"), "pairs")
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id")))
    # bits of the wanted doc_ids, so that only their sets are moved; the table's size is bounded, and a full one only saves less
    count = pairs.count()
    bits = 1 << min(26, max(12, (16 * max(1, count)).bit_length()))
    rows = ends.mapInArrow(_spots(bits), "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    packed = np.zeros(bits // 64, np.int64)
    packed[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    wanted = spark.sparkContext.broadcast(packed.tobytes())
    # documents with a 200th of all ends and more: 200 at most; their pairs are dealt out, and their sets to all places
    hot = [r["doc_id"] for r in ends.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") >= max(64, 2 * count / 200)).select("doc_id").collect()]
    place = lambda x, other: F.when(F.col(x).isin(hot), F.pmod(F.xxhash64(other), F.lit(PLACES)).cast("int")).otherwise(0)
    places = F.when(F.col("doc_id").isin(hot), F.sequence(F.lit(0), F.lit(PLACES - 1))).otherwise(F.array(F.lit(0)))
    sets = documents.mapInArrow(_sets(how.k, wanted), "doc_id long, set binary").select("doc_id", F.explode(places).alias("place"), "set").dropDuplicates(["doc_id", "place"])
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("place").alias(f"place_{x}"), F.col("set").alias(f"set_{x}"))
    placed = pairs.select("a", "b", place("a", "b").alias("place_a"), place("b", "a").alias("place_b"))
    two = placed.join(side("b"), ["b", "place_b"]).join(side("a"), ["a", "place_a"])
    return two.select("a", "b", "set_a", "set_b").mapInArrow(_overlaps(how.percent), "u long, v long")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def _open(rows: DataFrame) -> DataFrame:
    """rows of the tokens whose documents aren't all of one class yet, with the token's pivot."""
    each = rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min(F.struct("component", "doc_id", "n", "reach", "at")).alias("pivot"))
    return rows.join(each.where("lo <> hi").select("token", "pivot"), "token")


def _block(key, table):
    out = np.zeros(BLOCK, np.uint8)
    out[table.column("spot").to_numpy() % BLOCK] = table.column("level").to_numpy()
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bytes": pa.array([out.tobytes()], pa.binary())})


def _raised(levels: np.ndarray, counts: DataFrame) -> np.ndarray:
    """levels with those of the counters of counts (spot, n), which come to the driver as a byte each at most."""
    rows = counts.select("spot", F.least(F.floor(F.log2("n")), F.lit(63)).cast("int").alias("level"))
    packed = rows.groupBy(F.expr(f"spot div {BLOCK}").alias("block")).applyInArrow(_block, "block long, bytes binary").collect()
    out = levels.copy()
    for r in packed:
        part = out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK]
        np.maximum(part, np.frombuffer(r["bytes"], np.uint8), out=part)
    return out


def _needed(x: str, y: str, percent: int):
    """The overlap that sets of the sizes x.n and y.n need to link."""
    return F.ceil((F.col(f"{x}.n") + F.col(f"{y}.n")) * percent / (100.0 + percent) - 1e-9)


def _meets(x: str, y: str, how: Similarity):
    """Whether a shared token counts for a pair: sizes are close enough, and it lies in both prefixes for the pair's own overlap and l."""
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    spare = F.least(f"{x}.reach", f"{y}.reach") - _needed(x, y, how.percent)
    return (F.least(a, b) * 100 >= F.greatest(a, b) * how.percent) & (F.col(f"{x}.at") < a + spare) & (F.col(f"{y}.at") < b + spare)


def link_classes(documents: DataFrame, how: Similarity) -> DataFrame:
    """A row (doc_id, n_shingles, component_id) for each row of documents (doc_id, text)."""
    with short_batches(documents.sparkSession, 1000):
        return _link_classes(documents, how)


def _with_nodes(documents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """documents (doc_id, text, and one more column at most, all) with a column __node__, a number for each text of a doc_id, and ties (u, v) between the texts of one doc_id, if there are any.

    It is the doc_id, or for doc_ids that have unlike texts a number above 2**62, a hash of both.
    """
    number = F.col("doc_id").cast("long")
    own = F.xxhash64(F.coalesce("text", F.lit("")))
    unlike = documents.where("doc_id IS NOT NULL").select(number.alias("__id__"), own.alias("__hash__")).groupBy("__id__").agg(F.min("__hash__").alias("lo"), F.max("__hash__").alias("hi")).where("lo <> hi").select("__id__")
    unlike = spool(unlike, "unlike")
    if not unlike.take(1):
        return documents.withColumn("__node__", number), None
    marked = documents.join(unlike, number == F.col("__id__"), "left")
    apart = F.shiftrightunsigned(F.xxhash64(number, "text"), 2).bitwiseOR(F.lit(1 << 62))
    marked = marked.withColumn("__node__", F.when(F.col("__id__").isNotNull(), apart).otherwise(number))
    ties = marked.where("__id__ IS NOT NULL").select(F.col("__node__").alias("u"), F.col("__id__").alias("v")).distinct()
    return marked.drop("__id__"), ties


def _link_classes(documents: DataFrame, how: Similarity) -> DataFrame:
    docs, ties = _with_nodes(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    sizes, final = _linked(docs.where("__node__ IS NOT NULL").select(F.col("__node__").alias("doc_id"), "text"), how, ties)
    if ties is not None:
        sizes = sizes.join(ties.select(F.col("u").alias("doc_id"), "v"), "doc_id", "left").select(F.coalesce("v", "doc_id").alias("doc_id"), "n")
    out = sizes.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    lost = docs.where("doc_id IS NULL").select("doc_id", "text").mapInArrow(_lost(how.k), out.schema)
    return out.union(lost)


def _linked(known: DataFrame, how: Similarity, ties: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n) for each row of known (doc_id, text), whose doc_ids name texts; and (node, component) of those in classes of several, which ties (u, v) belong to."""
    spark = known.sparkSession
    survey = spool(known.mapInArrow(_survey(how.k), "sort int, a long, b long, c long, n long, first long"), "survey")
    sizes = survey.where("sort = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("s1"), F.col("c").alias("s2"), "n", "first")
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, int(total).bit_length()))
    levels = _raised(np.zeros(1 << bits, np.uint8), survey.where("sort = 1").groupBy(F.shiftright("a", MOST_BITS - bits).alias("spot")).agg(F.sum("n").alias("n")))
    sent = spark.sparkContext.broadcast(levels.tobytes())
    counts = known.mapInArrow(_probe(how, sent), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= 4)
    levels = _raised(levels, counts.groupBy(F.shiftrightunsigned("token", 64 - bits).alias("spot")).agg(F.max("n").alias("n")))
    sent.destroy()
    sent = spark.sparkContext.broadcast(levels.tobytes())
    # a set's copies hang on the first in their task, and the firsts of all tasks on one of them
    firsts = sizes.where("n > 0 AND doc_id = first").select("first", "s1", "s2", "n").distinct()
    tops = firsts.groupBy("s1", "s2", "n").agg(F.min("first").alias("top"), F.count("*").alias("tasks")).where("tasks > 1").select("s1", "s2", "n", "top")
    higher = spool(firsts.join(tops, ["s1", "s2", "n"]).select(F.col("first").alias("u"), F.col("top").alias("v")).where("u <> v"), "firsts")
    below = sizes.where("n > 0 AND doc_id <> first").select(F.col("doc_id").alias("u"), F.col("first").alias("v"))
    copies = spool(below.union(higher), "copies")

    prefixes = spool(known.mapInArrow(_prefixes(how, sent), "token long, doc_id long, n int, reach int, at int"), "prefixes")
    sent.destroy()
    shared = prefixes.groupBy("token").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("token")
    rows = spool(prefixes.join(shared, "token"), "postings")
    discard(prefixes)

    # copies hang on their first: they need no search for classes
    edges, labels = copies, higher.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(2):
        live = _open(_labelled(rows, labels)).where(F.col("component") != F.col("pivot.component"))
        live = live.select(F.struct("doc_id", "n", "reach", "at").alias("x"), "pivot").where(_meets("x", "pivot", how))
        pairs = live.groupBy(F.col("x.doc_id").alias("a"), F.col("pivot.doc_id").alias("b")).agg(F.count("*").alias("shared"), F.min(F.least("x.reach", "pivot.reach")).alias("reach"))
        pairs = pairs.where("shared >= reach").groupBy("a").agg(F.max(F.struct("shared", (-F.col("b")).alias("b"))).alias("best")).select("a", (-F.col("best.b")).alias("b"))
        edges = spool(edges.union(_verified(known, pairs, how)), "links")
        labels = spool(components(edges), "labels")
    # all pairs that are still in different classes: those outside a token's pivot class against all others
    live = spool(_open(_labelled(rows, labels)).select("token", "doc_id", "n", "reach", "at", "component", F.col("pivot.component").alias("main")), "open")
    discard(rows)
    # of l shared tokens the last two lie at least as the (l - 1)th in either's own list of open tokens: earlier ones needn't meet
    live = live.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy("at", "token")))
    reach = F.least("x.reach", "y.reach")
    late = F.least("x.rank", "y.rank") >= reach - 1
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.doc_id") < F.col("y.doc_id"))
    met = live.where("component <> main").alias("x").join(live.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.component") != F.col("y.component")) & _meets("x", "y", how) & late & once)
    pairs = met.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"), reach.alias("reach"))
    pairs = pairs.groupBy("a", "b", "reach").agg(F.count("*").alias("shared")).where("shared >= least(reach, 2)")
    edges = edges.union(_verified(known, pairs, how))
    return sizes.select("doc_id", "n"), components(edges if ties is None else edges.union(ties))


def _lost(k: int):
    def run(batches):
        for batch in batches:
            n = [len(x) for _, _, data, offsets in slices(text_of(batch, "text")) for x in K.shingle_sets(data, offsets, k)]
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(n, pa.int64()), none], ["doc_id", "n_shingles", "component_id"])

    return run


def drop_near_copies(documents: DataFrame, how: Similarity = Similarity()) -> DataFrame:
    """documents with one row of each class: the one of the smallest doc_id.

    Rows without a doc_id all stay. Of a doc_id with unlike texts each text is judged for itself; in a class
    they come after the doc_ids that have one text. Repeated rows are one.
    """
    docs, _ = _with_nodes(documents.select("doc_id", "text", whole(documents).alias("all")))
    with short_batches(documents.sparkSession, 1000):
        _, classes = _linked(docs.where("__node__ IS NOT NULL").select(F.col("__node__").alias("doc_id"), "text"), how)
    others = classes.where("node <> component").select(F.col("node").alias("__node__"))
    kept = docs.where("__node__ IS NOT NULL").join(others, "__node__", "left_anti").dropDuplicates(["__node__"])
    return kept.select("all.*").union(docs.where("__node__ IS NULL").select("all.*"))


def op2_ngram_jaccard_join(spark, sf_dir):
    """Classes of documents linked by three-word shingles at 0.9."""
    from .common import read

    return link_classes(read(spark, sf_dir, "documents"), Similarity(k=3, percent=90))
