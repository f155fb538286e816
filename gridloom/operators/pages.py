"""Tables of pages: cells from words and slots, the choice among finders, and a page's elements in reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as GEO
from ..functions import text as T
from . import joins as J
from . import ordered as N
from .shapes import cluster_numeric, normalize_digits


def page_text(text: Column, words: Column, least: int = 40) -> Column:
    """A page's text, or its words where the text is too short; words: an array in order."""
    return F.when(F.length(F.coalesce(text, F.lit(""))) >= least, text).otherwise(F.array_join(words, " "))


def camelot_slots(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with a bottom-left origin (x1, y1, x2, y2, page_height, vspan, hspan, has_top, has_left) as slots.

    Covered cells and those without size have no box; tables come in the order of their tops, then lefts.
    """
    covered = (F.col("vspan") & ~F.col("has_top")) | (F.col("hspan") & ~F.col("has_left")) | (F.col("x2") <= F.col("x1")) | (F.col("y2") <= F.col("y1"))
    box = F.struct(F.col("x1").alias("x0"), (F.col("page_height") - F.col("y2")).alias("top"), F.col("x2").alias("x1"), (F.col("page_height") - F.col("y1")).alias("bottom"))
    return cells.select(*keys, "row", "col", F.when(~covered, box).alias("bbox"))


def joined_lines(parts: Column, low: Column, high: Column, y_tolerance: float = 3.0) -> Column:
    """A cell's text of its words (y, x0, word_id, top, w: x0, word_id, text), whose tops lie from low to high: lines joined by breaks, spaced digits made numbers.

    A line begins where a word stands further than the tolerance from the word before it, in the order of tops. Most
    cells have one line, which is joined without any lambda.
    """
    p = F.sort_array(parts)
    words, top = p.getField("w"), p.getField("top")
    starts = F.filter(F.sequence(F.lit(1), F.size(p)), lambda i: (i == 1) | F.coalesce(F.abs(F.get(top, i - 1) - F.get(top, i - 2)) > y_tolerance, F.lit(True)))
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(p) + 1))
    lines = F.zip_with(starts, ends, lambda s, e: F.array_join(T.in_order(F.slice(words, s, e - s), "text"), " "))
    return F.when(F.size(parts) == 0, "").when(high - low <= y_tolerance, F.array_join(T.in_order(parts.getField("w"), "text"), " ")).otherwise(F.array_join(lines, "\n"))


def build_cells(words: DataFrame, slots: DataFrame, keys: list[str]) -> DataFrame:
    """Cells (keys, table_id, row, col, text, bbox) of slots: the words whose centres lie in them.

    words: keys, word_id, text, x0, x1, top, bottom, size; slots: keys, table_id, row, col, bbox (null: no slot).
    Split digits are joined before. Slots without words have an empty text.
    """
    words, slots = words.repartition(*keys), slots.repartition(*keys)
    whole = N.merge_split_digits(words, keys)
    own = [*keys, "table_id", "row", "col"]
    more = [c for c in slots.columns if c not in own]
    part = F.struct(F.bround("top").alias("y"), "x0", "word_id", "top", F.struct("x0", "word_id", "text").alias("w"))
    met = J.slot_words(whole, slots, keys).select(*own, "top", part.alias("_w"))
    # slots come to their words in one grouping: neither a join nor a window of their own, and no order of words before
    both = slots.select(*own, F.struct(*more).alias("_s")).unionByName(met, allowMissingColumns=True)
    cells = both.groupBy(*own).agg(F.collect_list("_w").alias("_p"), F.min("top").alias("_a"), F.max("top").alias("_b"), F.collect_list("_s").alias("_s"))
    text = cells.select(*own, "_s", T.strip(joined_lines(F.col("_p"), F.col("_a"), F.col("_b"))).alias("text"))
    return text.select(*own, F.explode("_s").alias("_s"), normalize_digits(F.col("text")).alias("text")).select(*own, *[F.col(f"_s.{c}").alias(c) for c in more], "text")


def choose_tables(candidates: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates (keys, source, bbox, prose) to the tables of each page.

    pages: keys, known (whether the file's path and page are known to the second finder) and second (whether that
    finds any table there). Lines are first choice; where the second finder sees tables, borderless ones below
    (``supplementary``, at most 55 % covered) join them, and without lines its own tables or text ones do.
    """
    good = candidates.where("NOT prose").join(pages, keys)
    has = lambda s: F.coalesce(F.bool_or(F.col("source") == s).over(Window.partitionBy(*keys)), F.lit(False))
    good = good.withColumns({"_lines": has("lines"), "_camelot": has("camelot")})
    deep = F.col("known") & F.col("second")
    keep = (F.col("source") == "lines") | (deep & F.col("_lines") & (F.col("source") == "supplementary")) | (deep & ~F.col("_lines") & ((F.col("source") == "camelot") | (~F.col("_camelot") & (F.col("source") == "text"))))
    chosen = F.when(F.col("_lines"), "lines").when(F.col("_camelot") & deep, "camelot").otherwise("text")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("bbox.top", "bbox.x0", "table_id"))
    return good.where(keep).withColumns({"page_source": chosen, "place": place}).drop("_lines", "_camelot", "known", "second")


def largest(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """The table with the greatest area on each page; the first on ties."""
    best = F.max_by(F.struct("table_id", "bbox"), F.struct(GEO.area(F.col("bbox")).alias("a"), (-F.col("table_id")).alias("i")))
    return boxes.groupBy(*keys).agg(best.alias("b"), F.max(GEO.area(F.col("bbox"))).alias("area")).select(*keys, "b.table_id", "area")


def supplementary_region(words: DataFrame, existing: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    """Where to look for a borderless table below the others: keys, x0, top, x1, bottom.

    existing: tables with bbox; starts: keys, start_top of the first tabular lines below them.
    """
    low = existing.groupBy(*keys).agg(F.max("bbox.bottom").alias("_low"))
    below = words.join(low, keys).join(starts, keys).where((F.col("top") >= F.col("_low") - 5) & (F.col("top") >= F.col("start_top") - 2))
    box = below.groupBy(*keys).agg(F.min("x0").alias("x0"), F.greatest(F.max("_low") - 2, F.max("start_top") - 2).alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom"))
    return box.where("x1 > x0 AND bottom > top")


def page_elements(*parts: DataFrame, keys: list[str]) -> DataFrame:
    """Tables, code tables, prose and free text (keys, kind, top, x0, html) as one list in reading order, numbered."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    order = Window.partitionBy(*keys).orderBy(F.bround(F.col("top") / 4) * 4, F.bround("x0"), "kind", "html")
    return whole.withColumn("place", F.row_number().over(order))


def augment_rows(cells: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
    """Rows found above a table (keys, seq, label, code) put before its own as two cells each; all rows renumbered."""
    count = above.groupBy(*keys).agg(F.count("*").alias("_n"))
    place = (F.row_number().over(Window.partitionBy(*keys).orderBy("seq")) - 1).cast("int")
    rows = above.withColumn("row", place).select(*keys, "row", F.posexplode(F.array("label", "code")).alias("col", "text"))
    moved = cells.join(count, keys, "left").select(*keys, (F.col("row") + F.coalesce("_n", F.lit(0))).cast("int").alias("row"), "col", "text")
    return moved.unionByName(rows)


def codes_above(words: DataFrame, blocks: DataFrame | None, keys: list[str], up: float = 70.0, left: float = 140.0) -> DataFrame:
    """Words near a block of codes: over it (within up) and at its left (within left), with the side each is on.

    blocks: keys, bbox; none, if words bring their block's box (block), so that nothing is joined.
    """
    near = words.withColumnRenamed("block", "_b") if blocks is None else words.join(blocks.select(*keys, F.col("bbox").alias("_b")), keys)
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("top") + F.col("bottom")) / 2
    b = F.col("_b")
    over = (cy < b["top"]) & (cy >= b["top"] - up) & cx.between(b["x0"], b["x1"])
    beside = (cx < b["x0"]) & (cx >= b["x0"] - left) & cy.between(b["top"], b["bottom"])
    # lines out of reach go first, before they become words where a line's height is known
    near = near.where(cy.between(b["top"] - up, b["bottom"]))
    return near.withColumn("side", F.when(over, "above").when(beside, "left")).where("side IS NOT NULL").drop("_b")


def code_pairs(near: DataFrame, keys: list[str], tolerance: float = 4.0) -> DataFrame:
    """(keys, seq, label, code) of the words near a block of codes (codes_above): each band with a code gives one pair, its last code and all its other words.

    Bands without words beside their code take the words of the nearest band above that has no code, each such band once.
    """
    bands = N.word_lines(near.repartition(*keys), keys, tolerance)
    band = [*keys, "line"]
    is_code = F.col("text").rlike(r"^\d{2,10}$")
    last = F.max(F.when(is_code, F.struct("x0", "word_id"))).over(Window.partitionBy(*band))
    marked = bands.withColumn("_code", F.coalesce(last == F.struct("x0", "word_id"), F.lit(False)))
    parts = F.collect_list(F.when(~F.col("_code"), F.struct("x0", "word_id", "text")))
    rows = marked.groupBy(*band).agg(F.array_join(T.in_order(parts, "text"), " ").alias("own"), F.max(F.when(F.col("_code"), F.col("text"))).alias("code"))
    order = Window.partitionBy(*keys).orderBy("line")
    # the band right above, if it has words and no code, belongs to a code that has none
    above = F.when(F.lag("code").over(order).isNull(), F.lag("own").over(order))
    label = F.when(F.col("own") != "", F.col("own")).otherwise(F.coalesce(above, F.lit("")))
    return rows.withColumn("label", label).where("code IS NOT NULL").select(*keys, F.col("line").alias("seq"), "label", "code")


def realign_rows(words: DataFrame, keys: list[str], least: int = 3) -> DataFrame:
    """Cells (keys, row, col, text) of the data rows of statements without rules, put to their table's most frequent number of columns.

    words: keys, row, word_id, text, x0, x1, top, bottom, size. A data row has, in its longest line, three groups of
    words and two numbers: what stands before the first number is its label, column 0. Rows with the most frequent
    number of columns give the columns' right edges; each number of the other rows goes to the nearest one, those
    that go to the same one are joined. Tables with fewer than two data rows or ``least`` columns give none.
    """
    at = [*keys, "row"]
    row, page = Window.partitionBy(*at), Window.partitionBy(*keys)
    # windows instead of joins: all of them are local to the tables that are dealt out here
    lines = N.word_lines(words.repartition(*keys), at).withColumn("_k", F.count("*").over(Window.partitionBy(*at, "line")))
    longest = F.max(F.struct("_k", (-F.col("line")).alias("i"))).over(row)["i"]
    main = N.word_clusters(lines.withColumn("_best", -longest).where("line = _best"), at)
    # words before the first digit of a row's first group are its label
    digit = F.col("text").rlike(r"\d")
    seen = F.max(digit.cast("int")).over(Window.partitionBy(*at, "cluster").orderBy("x0", "word_id").rowsBetween(Window.unboundedPreceding, 0))
    main = main.withColumn("_lead", (F.col("cluster") == 0) & (seen == 0))
    groups = main.groupBy(*at, "cluster", "_lead").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "word_id", "text"))), lambda x: x["text"]), " ").alias("text"), F.min("x0").alias("x0"), F.max("x1").alias("x1"))
    order = row.orderBy("x0")
    groups = groups.withColumn("_num", cluster_numeric(F.col("text")))
    groups = groups.withColumns({"_i": F.row_number().over(order), "_n": F.max("cluster").over(row) + 1, "_m": F.sum(F.col("_num").cast("int")).over(row)})
    groups = groups.withColumn("_first", F.min(F.when(F.col("_num"), F.col("_i"))).over(row)).where("_n >= 3 AND _m >= 2")
    # from the first number on, numbers have places (_j); with the label they make the row's number of columns
    groups = groups.withColumns({"_j": F.sum(F.col("_num").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)), "columns": F.col("_m") + 1})
    one = F.when(F.col("_num") & (F.col("_j") == 1), 1).otherwise(0)
    groups = groups.withColumn("_rows", F.sum(one).over(Window.partitionBy(*keys, "columns")))
    groups = groups.withColumns({"_modal": F.max(F.struct("_rows", "columns")).over(page)["columns"], "_all": F.sum(one).over(page)}).where((F.col("_all") >= 2) & (F.col("_modal") >= least))
    typical = F.col("_num") & (F.col("columns") == F.col("_modal"))
    groups = groups.withColumn("_edge", F.avg(F.when(typical, F.col("x1"))).over(Window.partitionBy(*keys, "_j", "_num")))
    groups = groups.withColumn("_edges", F.array_sort(F.collect_set(F.when(typical, F.struct("_j", F.col("_edge").alias("edge")))).over(page)))
    nearest = F.array_min(F.transform("_edges", lambda e: F.struct(F.abs(e["edge"] - F.col("x1")).alias("d"), e["_j"].alias("col"))))["col"]
    col = F.when(F.col("_i") < F.col("_first"), 0).when(F.col("_num"), nearest).cast("int")
    own = F.struct(col.alias("col"), F.col("_i"), F.col("text"))
    # a row's first number brings all places of the grid, empty
    empty = F.transform(F.sequence(F.lit(0), F.col("_modal").cast("int") - 1), lambda c: F.struct(c.alias("col"), F.lit(None).cast("int").alias("_i"), F.lit(None).cast("string").alias("text")))
    cells = groups.select(*at, F.explode(F.when(one == 1, F.concat(F.array(own), empty)).otherwise(F.array(own))).alias("c")).select(*at, "c.*").where("col IS NOT NULL")
    parts = F.array_sort(F.collect_list(F.when(F.col("_i").isNotNull(), F.struct("_i", "text"))))
    return cells.groupBy(*at, "col").agg(F.array_join(F.transform(parts, lambda x: x["text"]), " ").alias("text"))


def best_column_count(counts: DataFrame, keys: list[str], value: str = "clusters") -> DataFrame:
    """The most frequent number of columns of a table's rows; the greater one on ties."""
    each = counts.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return each.groupBy(*keys).agg(F.max_by(value, F.struct("n", value)).alias("columns"), F.max("n").alias("rows"))


def longest_line(lines: DataFrame, keys: list[str]) -> DataFrame:
    """The line with the most words; the first on ties."""
    return lines.groupBy(*keys).agg(F.max_by("line", F.struct("words", (-F.col("line")).alias("i"))).alias("line"), F.max("words").alias("words"))
