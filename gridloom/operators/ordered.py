"""Operators on ordered rows: lines, clusters, blocks, headers, carried values.

``keys`` are the columns that part the work (a page, a table); everything is local to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def islands(df: DataFrame, keys: list[str], order: list, starts: Column, name: str) -> DataFrame:
    """df with the number (from 0) of the run that each row belongs to; starts is true where a run begins."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_start", starts).withColumn(name, F.sum(F.when(F.coalesce("_start", F.lit(False)), 1).otherwise(0)).over(w) - 1).drop("_start")


def before(column, keys: list[str], order: list, n: int = 1) -> Column:
    return F.lag(column, n).over(Window.partitionBy(*keys).orderBy(*order))


def word_lines(words: DataFrame, keys: list[str], tolerance: float = 3.0) -> DataFrame:
    """Words to lines: a new line where top moves by more than the tolerance from the word before."""
    order = ["top", "x0", "word_id"]
    last = before("top", keys, order)
    return islands(words, keys, order, last.isNull() | (F.abs(F.col("top") - last) > tolerance), "line")


def x_clusters(words: DataFrame, keys: list[str], gap: float = 18.0) -> DataFrame:
    """The number of clusters of word centres for each key."""
    w = words.withColumn("centre", (F.col("x0") + F.col("x1")) / 2)
    last = before("centre", keys, ["centre", "word_id"])
    return w.withColumn("_jump", (F.col("centre") - last > gap).cast("int")).groupBy(*keys).agg((F.coalesce(F.sum("_jump"), F.lit(0)) + 1).alias("clusters"))


def word_clusters(words: DataFrame, keys: list[str], least: float = 14.0, factor: float = 1.2) -> DataFrame:
    """Words to clusters: a new one where the gap exceeds a part of the size of the word before."""
    order = ["x0", "word_id"]
    gap = F.col("x0") - before("x1", keys, order)
    return islands(words, keys, order, gap.isNull() | (gap > F.greatest(F.lit(least), factor * before("size", keys, order))), "cluster")


def style_runs(words: DataFrame, keys: list[str], factor: float = 1.5) -> DataFrame:
    """Words of a line to runs of one font and small gaps; a run's key is its font, weight, slant and size."""
    order = ["x0", "word_id"]
    style = F.struct(T.font_css(F.col("fontname")).alias("family"), T.is_bold(F.col("fontname")).alias("bold"), T.is_italic(F.col("fontname")).alias("italic"), T.half_points(F.col("size")).alias("points"))
    w = words.withColumn("style", style)
    gap = F.col("x0") - before("x1", keys, order)
    return islands(w, keys, order, gap.isNull() | (gap > factor * before("size", keys, order)) | (F.col("style") != before("style", keys, order)), "run")


def cohesive_side(words: DataFrame, keys: list[str], side: str, factor: float = 1.5) -> DataFrame:
    """The run nearest to the inside: the last one of a left side, the first one of a right side."""
    runs = style_runs(words, keys, factor)
    best = runs.groupBy(*keys).agg((F.max("run") if side == "left" else F.min("run")).alias("_best"))
    return runs.join(best, keys).where(F.col("run") == F.col("_best")).drop("_best")


def merge_split_digits(words: DataFrame, keys: list[str], tolerance: float = 3.0, factor: float = 1.8, least: int = 4) -> DataFrame:
    """Runs of at least four neighbouring one-digit words as one word each; all others stay."""
    order = [F.bround("top"), F.col("x0"), F.col("word_id")]
    digit = (F.length("text") <= 2) & F.col("text").rlike(r"^\d$")
    size = F.when(before("size", keys, order) > 0, before("size", keys, order)).otherwise(10.0)
    near = (F.abs(F.col("top") - before("top", keys, order)) <= tolerance) & (F.col("x0") - before("x1", keys, order) <= factor * size)
    fresh = ~F.coalesce(F.col("_digit") & before("_digit", keys, order) & near, F.lit(False))
    marked = words.withColumn("_digit", F.coalesce(digit, F.lit(False))).withColumn("_fresh", fresh)
    runs = islands(marked, keys, order, F.col("_fresh"), "_run")
    # a run is digits, or one other word: its first row brings all of it, so that words needn't be grouped one by one
    part = F.struct("x0", "word_id", "text", "x1", "top", "bottom", "size")
    runs = runs.withColumn("_d", F.collect_list(F.when(F.col("_digit"), part)).over(Window.partitionBy(*keys, "_run")))
    many = F.size("_d") >= least
    parts = F.sort_array("_d")
    first = lambda c: parts[0][c]
    merged = {"word_id": F.array_min("_d.word_id"), "text": F.array_join(parts.getField("text"), ""), "x0": F.array_min("_d.x0"), "x1": F.array_max("_d.x1"), "top": first("top"), "bottom": first("bottom"), "size": first("size")}
    return runs.where(F.col("_fresh") | ~many).select(*keys, *[F.when(many, c).otherwise(F.col(n)).alias(n) for n, c in merged.items()])


def running_blocks(rows: DataFrame, keys: list[str], gap: float = 14.0) -> DataFrame:
    """Boxes to blocks: a new one where top lies further below the greatest bottom so far, over all before."""
    w = Window.partitionBy(*keys).orderBy("top", "seq").rowsBetween(Window.unboundedPreceding, -1)
    lowest = F.max("bottom").over(w)
    return islands(rows, keys, ["top", "seq"], lowest.isNull() | (F.col("top") - lowest > gap), "block")


def paragraphs(lines: DataFrame, keys: list[str], factor: float = 1.4) -> DataFrame:
    """Lines (top, bottom, size, text) to paragraphs: a wide gap, or a capital after a closing mark, begins one."""
    order = ["top", "line"]
    gap = F.col("top") - before("bottom", keys, order)
    closed = before("text", keys, order).rlike(r"[.:;?!]$") & T.starts_capital(F.col("text"))
    return islands(lines, keys, order, gap.isNull() | (gap > factor * F.col("size")) | closed, "paragraph")


def anchored_groups(df: DataFrame, keys: list[str], order: list[str], value: str, tolerance: float) -> DataFrame:
    """Rows to groups by the distance to the group's first row (not to the row before).

    One array fold for each key; returns keys, group, and the members' order values and ids.
    """
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(c) for c in order], F.col(value).alias("_v")))).alias("_rows"))
    kind = rows.schema["_rows"].dataType.elementType.simpleString()
    start = F.expr(f"named_struct('head', cast(null AS double), 'g', -1, 'out', cast(array() AS array<struct<g:int,r:{kind}>>))")

    def step(a, x):
        fresh = a["head"].isNull() | (F.abs(x["_v"].cast("double") - a["head"]) > tolerance)
        g = F.when(fresh, a["g"] + 1).otherwise(a["g"])
        return F.struct(F.when(fresh, x["_v"].cast("double")).otherwise(a["head"]).alias("head"), g.alias("g"), F.array_append(a["out"], F.struct(g.alias("g"), x.alias("r"))).alias("out"))

    folded = rows.select(*keys, F.explode(F.aggregate("_rows", start, step)["out"]).alias("_m"))
    return folded.select(*keys, F.col("_m.g").alias("group"), *[F.col(f"_m.r.{c}").alias(c) for c in order])


def header_rows(rows: DataFrame, keys: list[str], most: int = 6, ratio: float = 0.3) -> DataFrame:
    """Rows (row, filled, numeric_ratio, tabular, sentences, texts) to HEADER or DATA.

    A prefix rule: rows are header until the first that looks like data, six at most.
    """
    prose = (F.col("filled") >= 4) & (F.col("numeric_ratio") < 0.15) & (F.col("texts") >= 4) & (F.col("sentences") >= 2)
    fails = F.col("tabular") | prose | ~((F.col("numeric_ratio") < ratio) & (F.col("filled") >= 1))
    first = F.min(F.when(fails, F.col("row"))).over(Window.partitionBy(*keys))
    return rows.withColumn("kind", F.when((F.col("row") < F.coalesce(first, F.lit(2147483647))) & (F.col("row") < most), "HEADER").otherwise("DATA"))


def tabular_start(lines: DataFrame, keys: list[str], reach: float = 95.0) -> DataFrame:
    """Where a table without rules begins: the first line that isn't prose and is tabular with two of three; then upwards over near lines that aren't prose."""
    w = Window.partitionBy(*keys).orderBy("line").rowsBetween(0, 2)
    dense = F.sum(F.col("tabular").cast("int")).over(w)
    marked = lines.withColumn("_hit", ~F.col("prose") & (F.col("company") | (dense >= 2)))
    first = marked.groupBy(*keys).agg(F.min(F.when(F.col("_hit"), F.col("line"))).alias("_first"))
    above = marked.join(first.where("_first IS NOT NULL"), keys).where("line <= _first")
    back = Window.partitionBy(*keys).orderBy(F.col("line").desc()).rowsBetween(Window.unboundedPreceding, 0)
    gap = F.lag("top").over(Window.partitionBy(*keys).orderBy(F.col("line").desc())) - F.col("top")
    stopped = F.max(F.when((F.col("line") < F.col("_first")) & (F.col("prose") | (F.col("_gap") > reach)), 1).otherwise(0)).over(back)
    return above.withColumn("_gap", gap).withColumn("_stop", stopped).where("_stop = 0").groupBy(*keys).agg(F.min("line").alias("start_line"))


def alternate_blocks(rows: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Rows (row, is_prose, filled) to alternating prose and table blocks; thin table blocks go."""
    runs = islands(rows, keys, ["row"], F.coalesce(F.col("is_prose") != before("is_prose", keys, ["row"]), F.lit(True)), "block")
    blocks = runs.groupBy(*keys, "block").agg(F.first("is_prose").alias("is_prose"), F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.sum("filled").alias("filled"))
    return blocks.where(F.col("is_prose") | (F.col("filled") >= least))


def movement_split(rows: DataFrame, keys: list[str], wide: int = 10, narrow: int = 7) -> DataFrame:
    """The first row from the fourth on that is narrow and has a header word after wide rows among the six before."""
    w = Window.partitionBy(*keys).orderBy("row").rowsBetween(-6, -1)
    split = (F.col("row") >= 3) & (F.max("filled").over(w) >= wide) & (F.col("filled") <= narrow) & F.col("header_word")
    return rows.withColumn("_split", split).groupBy(*keys).agg(F.min(F.when(F.col("_split"), F.col("row"))).alias("split_row"))


def carry_forward(rows: DataFrame, keys: list[str], order: list, column: str, default) -> DataFrame:
    """Nulls of a column take the last value before them."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("carried", F.coalesce(F.last(column, True).over(w), F.lit(default)))


def reuse_first(rows: DataFrame, keys: list[str], order: list, column: str, accepted: Column) -> DataFrame:
    """Every accepted row takes the value of the first accepted one, whatever that is."""
    w = Window.partitionBy(*keys, "_ok").orderBy(*order)
    return rows.withColumn("_ok", accepted).withColumn("reused", F.when(F.col("_ok"), F.first(column).over(w))).drop("_ok")


def tail_run(rows: DataFrame, keys: list[str], bare: Column) -> DataFrame:
    """The run of bare rows that ends at the last bare row; place counts from its end (0 is the last)."""
    back = Window.partitionBy(*keys).orderBy(F.col("row").desc()).rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("_bare", bare)
    last = marked.groupBy(*keys).agg(F.max(F.when(F.col("_bare"), F.col("row"))).alias("_last"))
    upto = marked.join(last.where("_last IS NOT NULL"), keys).where("row <= _last")
    return upto.withColumn("_gone", F.sum(F.when(F.col("_bare"), 0).otherwise(1)).over(back)).where("_gone = 0").withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("row").desc())) - 1).drop("_gone", "_bare", "_last")


def merge_intervals(df: DataFrame, keys: list[str], gap: float) -> DataFrame:
    """Intervals (lo, hi) no further apart than gap, merged."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("hi").over(w)
    runs = islands(df, keys, ["lo", "hi"], reach.isNull() | (F.col("lo") - reach > gap), "_run")
    return runs.groupBy(*keys, "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("parts")).drop("_run")


def cluster_values(df: DataFrame, keys: list[str], value: str, gap: float) -> DataFrame:
    """Sorted values to clusters with gaps over ``gap`` between them: centre (mean), least, greatest, number."""
    last = before(value, keys, [value])
    runs = islands(df, keys, [value], last.isNull() | (F.col(value) - last > gap), "cluster")
    return runs.groupBy(*keys, "cluster").agg(F.avg(value).alias("centre"), F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("n"))


def dedupe_parallel(df: DataFrame, keys: list[str], at: str, size: Column, gap: float) -> DataFrame:
    """Of parallel segments within gap of the one before, the longest (first on ties)."""
    last = before(at, keys, [at, "seq"])
    runs = islands(df, keys, [at, "seq"], last.isNull() | (F.col(at) - last > gap), "_run")
    best = Window.partitionBy(*keys, "_run").orderBy(size.desc(), at, "seq")
    return runs.withColumn("_i", F.row_number().over(best)).where("_i = 1").drop("_i", "_run")


def trailing_chrome(rows: DataFrame, keys: list[str], anchor: Column, footer: Column, totals: Column, least: int = 3) -> DataFrame:
    """The first row after the anchor that reads like a footer and isn't a total; none before row ``least``."""
    after = rows.withColumn("_anchor", F.max(F.when(anchor, F.col("row"))).over(Window.partitionBy(*keys)))
    cut = F.min(F.when(footer & ~totals & (F.col("row") > F.coalesce("_anchor", F.lit(-1))) & (F.col("row") >= least), F.col("row")))
    return after.groupBy(*keys).agg(cut.alias("cut_row"))


def horizontal_bands(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (row, index_header, headerish, dataish, empty, bordered) to bands split where a new table begins.

    By priority: the index row, walked back over up to three header-like rows; a data row after two
    header-like ones among the four before; an empty row between bordered rows.
    """
    key = Window.partitionBy(*keys)
    line = key.orderBy("row")
    near = F.sum(F.col("headerish").cast("int")).over(line.rowsBetween(-4, -1))
    empty = F.col("empty") & F.lag("bordered").over(line) & F.lead("bordered").over(line)
    marked = rows.withColumn("_data", F.col("dataish") & (near >= 2)).withColumn("_gap", F.coalesce(empty, F.lit(False)))
    marked = marked.withColumn("_index", F.min(F.when(F.col("index_header"), F.col("row"))).over(key))
    up = F.max(F.when((F.col("row") < F.col("_index")) & ~F.col("headerish"), F.col("row"))).over(key)
    from_index = F.greatest(F.coalesce(up + 1, F.lit(0)), F.col("_index") - 3)
    first = lambda c: F.min(F.when(F.col(c), F.col("row"))).over(key)
    marked = marked.withColumn("split_row", F.coalesce(from_index, first("_data"), first("_gap")))
    return marked.withColumn("band", F.when(F.col("row") >= F.col("split_row"), 1).otherwise(0)).drop("_data", "_gap", "_index")


def line_text() -> Column:
    """An aggregate: a line's words in their order, joined."""
    return F.array_join(T.in_order(F.collect_list(F.struct("word_id", "text")), "text"), " ")


def centres_of() -> Column:
    """An aggregate: the centres of a line's words, in order."""
    return F.sort_array(F.collect_list((F.col("x0") + F.col("x1")) / 2))


def clusters_of(centres: Column, gap: float = 18.0) -> Column:
    """How many groups of words a line has, by gaps between their centres (a column of centres_of: a lambda would sort them again for each use)."""
    n = F.size(centres)
    jumps = F.zip_with(F.slice(centres, 2, F.greatest(n, F.lit(1))), F.slice(centres, 1, F.greatest(n - 1, F.lit(0))), lambda b, a: b - a > gap)
    return (F.size(F.filter(jumps, lambda x: x)) + 1).cast("long")
