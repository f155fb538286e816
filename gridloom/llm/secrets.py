"""Secret scans: base patterns, and multipart linking of credential parts that are weak alone.

All patterns run as built-in regular expressions over whole texts. A match's place is the running sum of
the pieces between matches, so a text with very many matches costs no more than a sort of them. Weak
parts (account names, mixed-case keys of 40 characters, endpoints) are reported only if the other parts
of a credential lie in the same scope, a given number of code points; the interval join goes by bins of
that width, which hold a bounded number of matches however long a text is.

Edge cases: a null or empty text has no spans. Rows are told apart by an internal number, so repeated rows
and repeated or null doc_ids each get their own result. Very many matches in one text cost no more each
than few. Ties of start are ordered by the kinds as in
KINDS. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read, spool, whole


@dataclass(frozen=True)
class Kind:
    """A pattern (Java syntax); a match counts if its group has at least ``least`` characters and ``needs`` fits it."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    needs: str = ""
    weak: bool = False


KINDS = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24),
    Kind("account", r"""(?i)(?<![A-Za-z0-9])(?:client_?id|account_?id|access_?key_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""", weak=True),
    Kind("key", r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-]|\.+[A-Za-z0-9+/=_-])", 0, 40, r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])", weak=True),
    Kind("endpoint", r"""(?i)(?<![A-Za-z0-9])(?:https?|ftps?|ssh|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+""", weak=True),
)
IDENTIFIERS, SECRETS = ("access", "account"), ("assign", "hex", "key")
#: For each weak kind the groups of kinds of which each must have a span in scope.
PARTNERS = {"account": (SECRETS,), "key": (IDENTIFIERS,), "endpoint": (IDENTIFIERS, SECRETS)}


def matches(text, kind: Kind):
    """An array of (kind, number, gap before it, its length, whether it counts), for the matches of one kind.

    Hits, gaps and groups are made once for a text and then walked side by side.
    """
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hit")
    gaps = F.split(text, kind.pattern, -1).alias("gap")
    parts = [F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)).alias("part")] if kind.group else []

    def row(x, i):
        keep = F.length(x["part"] if parts else x["hit"]) >= kind.least
        if kind.needs:
            keep = keep & x["hit"].rlike(kind.needs)
        return F.struct(F.lit(kind.name).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("size"), keep.alias("keep"))

    empty = F.array().cast("array<struct<kind:string,i:int,gap:int,size:int,keep:boolean>>")
    # the piece after the last match has no hit
    each = F.filter(F.arrays_zip(hits, gaps, *parts), lambda x: x["hit"].isNotNull())
    return F.when(text.rlike(kind.pattern), F.transform(each, row)).otherwise(empty)


def find(documents: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Rows (row, doc_id, text_hash, kind, start, end) of all counting matches, and one without kind for each row that has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    each = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(text).alias("text_hash"), F.concat(*[matches(text, k) for k in kinds]).alias("found"))
    rows = each.select("row", "doc_id", "text_hash", F.explode_outer("found").alias("m")).select("row", "doc_id", "text_hash", "m.*")
    before = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(before)
    placed = rows.select("row", "doc_id", "text_hash", "kind", F.coalesce("keep", F.lit(True)).alias("keep"), (end - F.col("size")).alias("start"), end.alias("end"))
    # a row all of whose matches fail still needs its line
    return placed.select("row", "doc_id", "text_hash", F.when(F.col("keep"), F.col("kind")).alias("kind"), F.when(F.col("keep"), F.col("start")).alias("start"), F.when(F.col("keep"), F.col("end")).alias("end"))


def linked(found: DataFrame, scope: int) -> DataFrame:
    """The weak spans of found whose partners all lie within scope code points."""
    spans = found.where(F.col("kind").isNotNull()).select("row", "kind", "start", "end")
    bins = lambda wider: F.explode(F.expr(f"sequence(start div {scope} - {wider}, end div {scope} + {wider})")).alias("bin")
    out = None
    for name, groups in PARTNERS.items():
        weak = spans.where(F.col("kind") == name)
        for group in groups:
            other = spans.where(F.col("kind").isin(*group)).select("row", F.col("start").alias("s"), F.col("end").alias("e"), bins(1)).alias("o")
            each = weak.select("row", "kind", "start", "end", bins(0)).alias("w")
            near = F.greatest("s", "start") - F.least("e", "end") <= scope
            weak = each.join(other, (F.col("w.row") == F.col("o.row")) & (F.col("w.bin") == F.col("o.bin")) & near, "left_semi").select("row", "kind", "start", "end").distinct()
        out = weak if out is None else out.union(weak)
    return out


def scan_secrets(documents: DataFrame, *, kinds: tuple[Kind, ...] = KINDS, scope: int = 200) -> DataFrame:
    """Spans of documents (doc_id, text): a row for each document row.

    Returns row, doc_id, text_hash, and spans, an array of (start, rank of the kind, kind, end) in order;
    base kinds always count, weak ones if their partners are in scope (code points between them).
    """
    found = spool(find(documents, kinds), "spans")
    strong = [k.name for k in kinds if not k.weak]
    reported = found.select("row", "kind", "start", "end").where(F.col("kind").isin(*strong)).union(linked(found, scope))
    rank = F.coalesce(*[F.when(F.col("kind") == k.name, F.lit(i)) for i, k in enumerate(kinds)])
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    rows = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"))
    spans = reported.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return rows.join(spans, "row", "left").withColumn("spans", F.coalesce("spans", empty))


#: Code points of a text that are cut at once.
CHUNK = 4096


def _cuts(spans: DataFrame, mark: str) -> DataFrame:
    """spans (row, doc_id, text_hash, spans) as one map for each doc_id and text: chunk -> (place of the last cut's end, start, end, what comes instead).

    Spans that overlap are one; one that goes on in further chunks has its mark in the first.
    """
    once = spans.where(F.size("spans") > 0).select("doc_id", "text_hash", "spans").dropDuplicates(["doc_id", "text_hash"]).withColumn("row", F.monotonically_increasing_id())
    once = spool(once, "marked")
    each = once.select("row", F.explode("spans").alias("s")).select("row", "s.start", "s.end")
    before = Window.partitionBy("row").orderBy("start", "end")
    fresh = F.coalesce(F.col("start") >= F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    one = each.withColumn("fresh", fresh.cast("int")).withColumn("group", F.sum("fresh").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    one = one.groupBy("row", "group").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    parts = one.select("row", "start", "end", F.explode(F.expr(f"sequence(start div {CHUNK}, (end - 1) div {CHUNK})")).alias("chunk"))
    low = F.col("chunk") * CHUNK
    parts = parts.select("row", F.col("chunk").cast("int").alias("chunk"), F.greatest("start", low).alias("a") - low, F.least("end", low + CHUNK).alias("b") - low, F.when(F.col("start") >= low, mark).otherwise("").alias("mark"))
    parts = parts.toDF("row", "chunk", "a", "b", "mark").withColumn("last", F.lag("b", 1, 0).over(Window.partitionBy("row", "chunk").orderBy("a")))
    lists = parts.groupBy("row", "chunk").agg(F.array_sort(F.collect_list(F.struct(*[F.col(c).cast("int").alias(c) for c in ("last", "a", "b")], "mark"))).alias("cuts"))
    maps = lists.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("chunk", "cuts"))).alias("cuts"))
    return once.select("row", "doc_id", "text_hash").join(maps, "row").select("doc_id", "text_hash", "cuts")


def redact(documents: DataFrame, *, mark: str = "[SECRET]", scope: int = 200) -> DataFrame:
    """documents with every reported span replaced by mark, overlapping ones by one mark; other columns as they were (n_chars anew)."""
    cuts = _cuts(scan_secrets(documents, scope=scope), mark)
    text = F.coalesce(F.col("all.text"), F.lit(""))
    docs = documents.select(whole(documents).alias("all"))
    joined = docs.join(cuts, F.col("all.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64(text) == F.col("text_hash")), "left").select("all", "cuts")

    def cut(chunk, i):
        own = F.col("cuts")[i]
        head = F.transform(own, lambda c: F.concat(F.substring(chunk, c["last"] + 1, c["a"] - c["last"]), c["mark"]))
        rest = F.substring(chunk, F.element_at(own, -1)["b"] + 1, F.lit(CHUNK))
        return F.when(own.isNull(), chunk).otherwise(F.concat(F.array_join(head, ""), rest))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    done = F.when(F.col("cuts").isNull(), F.col("all.text")).otherwise(F.array_join(F.transform(chunks, cut), ""))
    joined = joined.select("all", done.alias("text"))
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return joined.select(*[own.get(c, F.col(f"all.`{c}`")).alias(c) for c in documents.columns])


def op10_secret_scan(spark, sf_dir):
    """Secrets in every text of documents, as counts and digests."""
    spans = scan_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["rank"] < 3)
    line = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
