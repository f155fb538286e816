"""Source divergence audit: how far each source's word frequencies lie from every other source's of its language.

Two-dimensional tiles of groups: a group is a source within a language. The terms of a language that enough of
its documents hold are dealt to vocabulary chunks by a hash; a group's counts in a chunk are one packed vector.
Groups are dealt to blocks of about ``block``; the vectors of a block go to the tiles it forms with every block
of its language, and a tile's task walks the chunks in order, holding one chunk of both blocks as dense
matrices and the sums of its pairs. Long vocabularies are divided into ranges of chunks, tasks of their own,
whose sums are added.

Counting: a task counts terms of some million words at a time and gives a row for each language and term, with
its counts by source, so a term's rows are bounded by the number of such runs however frequent it is.

Smoothed frequencies are whole numbers, 1 + floor(scale * (count + 5) / (N + 5 * V)), made by exact division;
N counts the group's kept terms, V is the number of the language's kept terms.

Edge cases: a null text, language or source is an empty string, which is a language or source like others. A
text without terms adds nothing, but its group takes part, all its counts zero. A language without kept terms
has distance 0 between all its sources; one with a single source has no pairs. Repeated rows count as often
as they occur, each as a document of its own. Texts of any length are taken whole. Ties are ordered by the
item's bytes. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import discard, read, short_batches, slices, spool, text_of

SCALE = 1_000_000_000
PRIOR = 5
TERMS = K.classes(0x3A)
#: Words and bytes that a task counts at a time.
RUN, RUN_BYTES = 2_000_000, 16 << 20


@dataclass(frozen=True)
class Audit:
    """A term counts if ``least`` documents of its language hold it; ``top`` terms of each group are reported."""

    least: int = 30
    top: int = 50
    #: Groups of a block, terms of a chunk, chunks of a range.
    block: int = 8
    chunk: int = 1024
    chunks: int = 256


def frequencies(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (counts + PRIOR) / (total + PRIOR * terms)), by long division in base 1000: exact below 2**53 words."""
    whole = np.asarray(total, np.int64) + PRIOR * terms
    rest, out = np.asarray(counts, np.int64) + PRIOR, 0
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def _frequency(count: str, total: str):
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(38, 0)) * ({count} + {PRIOR}) div ({total} + {PRIOR} * terms)")


class _Run:
    """Words of some documents, until they are counted."""

    def __init__(self):
        self.langs, self.sources, self.groups, self.of_doc = {}, {}, {}, []
        self.parts, self.words, self.bytes = [], 0, 0

    def add(self, data, offsets, langs, sources):
        starts, ends, first = K.words(data, offsets, TERMS)
        hashes = K.word_hashes(data, starts, ends)
        doc = np.repeat(np.arange(len(langs)) + len(self.of_doc), np.diff(first))
        for pair in zip(langs, sources, strict=True):
            self.of_doc.append(self.groups.setdefault(pair, len(self.groups)))
        self.parts.append((K.FOLD[data], starts + self.bytes, ends + self.bytes, hashes, doc))
        self.words, self.bytes = self.words + len(starts), self.bytes + len(data)

    def full(self) -> bool:
        return self.words >= RUN or self.bytes >= RUN_BYTES

    def counted(self):
        """Batches (lang, term, docs, sources, counts), and one row without term for each language, with all its sources."""
        langs = sorted({a for a, _ in self.groups})
        names = [s for _, s in self.groups]
        lang_of = np.array([langs.index(a) for a, _ in self.groups], np.int64)
        of_doc = np.array(self.of_doc, np.int64)
        data, starts, ends, hashes, doc = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        _, where, term = np.unique(hashes, return_index=True, return_inverse=True)
        # (term, document) once with its count, then by term and group
        key, count = np.unique(term * len(of_doc) + doc, return_counts=True)
        term, group = np.divmod(key, max(len(of_doc), 1))
        group = of_doc[group]
        # terms of one language side by side: (language, term, group)
        key = (lang_of[group] * len(where) + term) * len(names) + group
        key, back = np.unique(key, return_inverse=True)
        docs, counts = np.bincount(back, minlength=len(key)), np.bincount(back, count, len(key)).astype(np.int64)
        both, group = np.divmod(key, max(len(names), 1))
        begin = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
        lang, term = np.divmod(both[begin], max(len(where), 1))
        docs = np.add.reduceat(docs, begin) if len(begin) else docs
        at, sizes = starts[where[term]], (ends - starts)[where[term]]
        bounds = np.append(begin, len(both)).astype(np.int32)
        langs_, names_ = pa.array(langs, pa.string()), pa.array(names, pa.string())
        for i in range(0, len(begin), 50_000):
            part = slice(i, i + 50_000)
            to = np.concatenate([[0], np.cumsum(sizes[part])])
            chars = data[np.repeat(at[part] - to[:-1], sizes[part]) + np.arange(to[-1])]
            terms = pa.StringArray.from_buffers(len(to) - 1, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(chars.tobytes()))
            edges = bounds[i : i + len(to)]
            inner = slice(edges[0], edges[-1])
            offsets = pa.array(edges - edges[0], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [langs_.take(pa.array(lang[part])), terms, pa.array(docs[part].astype(np.int64)), pa.ListArray.from_arrays(offsets, names_.take(pa.array(group[inner]))), pa.ListArray.from_arrays(offsets, pa.array(counts[inner]))], _COUNTED
            )
        of = [[n for n, x in zip(names, lang_of, strict=True) if x == i] for i in range(len(langs))]
        zero = pa.array([[0] * len(x) for x in of], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([langs_, pa.nulls(len(of), pa.string()), pa.array([0] * len(of), pa.int64()), pa.array(of, pa.list_(pa.string())), zero], _COUNTED)


_COUNTED = ["lang", "term", "docs", "sources", "counts"]


def _counts(batches):
    run = _Run()
    for batch in batches:
        texts = text_of(batch, "text")
        langs, sources = (pc.fill_null(batch.column(c).cast(pa.string()), "").to_pylist() for c in ("lang", "source"))
        for at, end, data, offsets in slices(texts, 1 << 20):
            run.add(data, offsets, langs[at:end], sources[at:end])
            if run.full():
                yield from run.counted()
                run = _Run()
    if run.of_doc:
        yield from run.counted()


def term_counts(documents: DataFrame, how: Audit = Audit()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, groups, sizes) of documents (text, lang, source), from spooled tables.

    counts: lang, term, chunk, slot, source, count of the kept terms. groups: lang, source, total, terms, block,
    blocks, chunks. sizes: lang, chunk, size.
    """
    runs = spool(documents.select("text", "lang", "source").mapInArrow(_counts, "lang string, term string, docs long, sources array<string>, counts array<long>"), "runs")
    kept = runs.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= how.least).select("lang", "term")
    kept = spool(kept, "terms")
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("terms")).withColumn("chunks", F.ceil(F.col("terms") / how.chunk))
    dealt = kept.join(F.broadcast(vocabulary) if vocabulary.count() <= 10_000 else vocabulary, "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), "chunks").cast("int"))
    slots = dealt.withColumn("slot", F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")) - 1).select("lang", "term", "chunk", "slot")
    slots = spool(slots, "slots")
    each = runs.where("term IS NOT NULL").join(slots.hint("shuffle_hash"), ["lang", "term"]).select("lang", "term", "chunk", "slot", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    counts = spool(each.groupBy("lang", "term", "chunk", "slot", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("count")), "counts")
    known = runs.where("term IS NULL").select("lang", F.explode("sources").alias("source")).distinct()
    known = known.join(counts.groupBy("lang", "source").agg(F.sum("count").alias("total")), ["lang", "source"], "left").join(vocabulary, "lang", "left")
    known = known.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("total", "terms", "chunks")})
    many = known.groupBy("lang").agg(F.ceil(F.count("*") / how.block).cast("int").alias("blocks"))
    groups = spool(known.join(many, "lang").withColumn("block", F.pmod(F.xxhash64("source"), "blocks").cast("int")), "groups")
    discard(runs)
    return counts, groups, slots.groupBy("lang", "chunk").agg(F.count("*").cast("int").alias("size"))


class _Tile:
    """Sums of absolute differences between the groups of two blocks, over chunks that come one after the other."""

    def __init__(self, key):
        self.key, self.names, self.totals, self.sides, self.terms = key, [], [], ([], []), 0
        self.sums = self.open = None

    def group(self, row):
        at = len(self.names)
        self.names.append(row["source"])
        self.totals.append(row["total"])
        self.terms = row["terms"]
        for side in (0, 1):
            if row["block"] == self.key[1 + side]:
                self.sides[side].append(at)

    def chunk(self, size):
        self.close()
        self.open = np.zeros((len(self.names), size), np.int64)
        self.at = {n: i for i, n in enumerate(self.names)}

    def vector(self, source, slots, counts):
        self.open[self.at[source], slots] = counts

    def close(self):
        if self.sums is None:
            self.sums = np.zeros((len(self.sides[0]), len(self.sides[1])), np.int64)
        if self.open is not None:
            p = frequencies(self.open, np.array(self.totals)[:, None], self.terms)
            other = p[self.sides[1]]
            for i, a in enumerate(self.sides[0]):
                self.sums[i] += np.abs(other - p[a]).sum(axis=1)
            self.open = None

    def rows(self):
        """(lang, source, item, value), in both directions."""
        self.close()
        out = []
        for i, a in enumerate(self.sides[0]):
            for j, b in enumerate(self.sides[1]):
                if a != b:
                    out.append((self.key[0], self.names[a], self.names[b], int(self.sums[i, j])))
                    if self.key[1] != self.key[2]:
                        out.append((self.key[0], self.names[b], self.names[a], int(self.sums[i, j])))
        return out


def _tiles(batches):
    """Rows (lang, i, j, range, chunk, kind, ...) in that order: groups (chunk -1), a chunk's size (kind 0), its vectors (kind 1)."""

    def packed(rows):
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["lang", "source", "item", "value"])

    tile = None
    for batch in batches:
        slots, counts = batch.column("slots"), batch.column("counts")
        rest = batch.select([n for n in batch.schema.names if n not in ("slots", "counts")]).to_pylist()
        for n, row in enumerate(rest):
            key = (row["lang"], row["i"], row["j"], row["part"])
            if tile is None or tile.key != key:
                if tile is not None:
                    yield packed(tile.rows())
                tile = _Tile(key)
            if row["chunk"] < 0:
                tile.group(row)
            elif row["kind"] == 0:
                tile.chunk(row["size"])
            else:
                tile.vector(row["source"], np.asarray(slots[n].values), np.asarray(counts[n].values))
    if tile is not None:
        yield packed(tile.rows())


def pair_distances(counts: DataFrame, groups: DataFrame, sizes: DataFrame, how: Audit = Audit()) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, in both directions: tiles of blocks by blocks."""
    null = lambda t: F.lit(None).cast(t)
    every = F.expr("explode(sequence(0, blocks - 1))")
    ends = lambda df: df.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    columns = ["lang", "i", "j", "part", "chunk", "kind", "source", "block", "total", "terms", "size", "slots", "counts"]
    last = F.greatest(F.lit(0), F.expr(f"cast((chunks - 1) div {how.chunks} AS int)"))
    heads = ends(groups.withColumn("other", every)).withColumn("part", F.explode(F.sequence(F.lit(0), last))).withColumns({"chunk": F.lit(-1), "kind": F.lit(0), "size": null("int"), "slots": null("array<int>"), "counts": null("array<long>")})
    part = F.expr(f"cast(chunk div {how.chunks} AS int)")
    langs = groups.select("lang", "blocks").distinct()
    bounds = sizes.join(langs, "lang").withColumn("i", every).withColumn("j", F.expr("explode(sequence(i, blocks - 1))"))
    bounds = bounds.withColumns({"part": part, "kind": F.lit(0), "source": null("string"), "block": null("int"), "total": null("long"), "terms": null("long"), "slots": null("array<int>"), "counts": null("array<long>")})
    packed = counts.groupBy("lang", "source", "chunk").agg(F.sort_array(F.collect_list(F.struct("slot", "count"))).alias("x"))
    vectors = packed.join(groups.select("lang", "source", "block", "blocks"), ["lang", "source"]).select("lang", "source", "chunk", "block", "blocks", F.col("x.slot").alias("slots"), F.col("x.count").alias("counts"))
    vectors = ends(vectors.withColumn("other", every)).withColumns({"part": part, "kind": F.lit(1), "total": null("long"), "terms": null("long"), "size": null("int")})
    rows = heads.select(*columns).unionByName(bounds.select(*columns)).unionByName(vectors.select(*columns))
    key = ["lang", "i", "j", "part"]
    with short_batches(counts.sparkSession, 500):
        sums = spool(rows.repartition(*key).sortWithinPartitions(*key, "chunk", "kind").mapInArrow(_tiles, "lang string, source string, item string, value long"), "tiles")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def leading_terms(counts: DataFrame, groups: DataFrame, how: Audit = Audit()) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group holds more of than its language, the widest differences first."""
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    own = groups.select("lang", "source", "total", "terms").join(langs, "lang")
    whole = counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"))
    each = counts.join(whole, ["lang", "term"]).join(own, ["lang", "source"])
    value = _frequency("count", "total") - _frequency("lang_count", "lang_total")
    each = each.where("count > 0").select("lang", "source", F.col("term").alias("item"), value.cast("long").alias("value")).where("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return each.withColumn("rank", rank).where(F.col("rank") <= how.top)


def audit_sources(documents: DataFrame, how: Audit = Audit()) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of documents (text, lang, source).

    part ``pair``: every other source of the language, with the distance of the two groups' frequencies; part
    ``term``: the group's leading terms. Ranks are from 1, by value downwards and item upwards.
    """
    counts, groups, sizes = term_counts(documents, how)
    pairs = pair_distances(counts, groups, sizes, how)
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return out(pairs, "pair").union(out(leading_terms(counts, groups, how), "term"))


def op13_source_divergence(spark, sf_dir):
    """Distances between the sources of each language, and each source's leading terms."""
    return audit_sources(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc FROM documents),
w AS (SELECT lang, source, doc, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
total AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
grid AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(total.n, 0) + 5 * v.v)::HUGEINT AS p
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term LEFT JOIN total ON total.lang = g.lang AND total.source = g.source),
lc AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
lt AS (SELECT lang, sum(n) AS n FROM c GROUP BY lang),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (lc.n + 5)) // (lt.n + 5 * v.v)::HUGEINT AS q FROM lc JOIN lt USING (lang) JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM grid JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) AS u)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
