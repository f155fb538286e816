"""Large grids cut into blocks: statements at their second header, sheets at their regions, layouts at their bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from . import joins as J
from . import shapes as S


def split_statement(rows: DataFrame, splits: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (row, texts, joined) of statements as blocks: an introduction, a table, a section's title, the table behind it.

    splits: keys, split_row (null: no second table). The title stands at the end of the first table's last row
    and leaves it: its row is given twice, once as the title's prose. Returns keys, block, kind, row, joined.
    """
    r = rows.join(splits, keys, "left")
    intro = (F.col("row") == 0) & S.intro_row(F.col("texts"))
    r = r.withColumns({"_title": F.when(F.col("row") == F.col("split_row") - 1, T.section_title(F.col("joined"))).otherwise(""), "_second": F.coalesce(F.col("row") >= F.col("split_row"), F.lit(False))})
    block = F.when(intro, 0).when(F.col("_second"), 3).otherwise(1)
    own = F.struct(block.alias("block"), F.when(intro, "prose").otherwise("table").alias("kind"), F.when(F.col("_title") != "", T.strip(F.replace("joined", "_title", F.lit("")))).otherwise(F.col("joined")).alias("joined"))
    title = F.struct(F.lit(2).alias("block"), F.lit("prose").alias("kind"), F.col("_title").alias("joined"))
    each = F.explode(F.when(F.col("_title") != "", F.array(own, title)).otherwise(F.array(own)))
    return r.select(*keys, "row", each.alias("x")).select(*keys, "x.block", "x.kind", "row", "x.joined")


def mashed_header(texts: Column, first: Column) -> Column:
    """Whether the first cell of a code row holds three and more words of a header that slid into it."""
    low = F.lower(first)
    hits = sum((low.contains(w).cast("int") for w in C.MASHED), F.lit(0))
    return S.line_code_row(texts) & (hits >= 3)


def blank_mashed_headers(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells without the header words that slid into the first cell of a code row; the other cells stay."""
    rows = S.rows_of(cells, keys)
    hit = rows.where(F.size("texts") > 0).where(mashed_header(F.col("texts"), F.get("texts", F.lit(0)))).select(*keys, "row", F.lit(True).alias("_mashed"))
    out = cells.join(hit, [*keys, "row"], "left")
    return out.withColumn("text", F.when(F.coalesce("_mashed", F.lit(False)) & (F.col("col") == 0), "").otherwise(F.col("text"))).drop("_mashed")


def strip_titles(rows: DataFrame, name: str = "joined") -> DataFrame:
    """Rows without the section title that their text ends in, and that title as ``title`` (empty if there is none)."""
    title = T.section_title(F.col(name))
    return rows.withColumn("title", title).withColumn(name, F.when(F.col("title") != "", T.strip(F.replace(name, "title", F.lit("")))).otherwise(F.col(name)))


def sheet_regions(rows: DataFrame, keys: list[str], least: float = 1.5, gap: int = 1) -> DataFrame:
    """Rows (row, score, bordered) of sheets to regions: keys, region, first_row, last_row.

    Rows that score enough are a table's; bordered rows behind one, or right before one, go with it. Regions
    no more than ``gap`` rows apart are one; one whose rows score less than twice the least is none.
    """
    order = Window.partitionBy(*keys).orderBy("row")
    r = rows.withColumn("_tab", F.col("score") >= least)
    r = r.withColumns({"_run": F.sum(F.when(F.col("_tab") | F.col("bordered"), 0).otherwise(1)).over(order), "_next": F.coalesce(F.lead("_tab").over(order), F.lit(False))})
    behind = F.coalesce(F.max(F.col("_tab").cast("int")).over(Window.partitionBy(*keys, "_run").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    on = r.withColumn("_on", F.coalesce(F.col("_tab") | (F.col("bordered") & (behind | F.col("_next"))), F.lit(False)))
    # rows between belong to the region before them up to its last row, so that no join of rows and regions is needed
    before = F.max(F.when(F.col("_on"), F.col("row"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("_on") & F.coalesce(F.col("row") - before > gap + 1, F.lit(True))
    placed = on.withColumn("_start", start.cast("int")).withColumn("region", F.sum("_start").over(order) - 1)
    placed = placed.withColumn("_last", F.max(F.when(F.col("_on"), F.col("row"))).over(Window.partitionBy(*keys, "region"))).where("region >= 0 AND row <= _last")
    whole = placed.groupBy(*keys, "region").agg(F.sum("score").alias("_s"), F.min("row").alias("first_row"), F.max("row").alias("last_row"))
    return whole.where(F.col("_s") >= 2 * least).drop("_s")


def row_borders(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, borders): the visible sides of a row's cells (borders); where none is, a floor by the table's inner rules (inside_h, inside_v) and width."""
    inner = F.when(F.max(F.col("inside_h").cast("int")) == 1, 2).otherwise(0) + F.when(F.max(F.col("inside_v").cast("int")) == 1, 2).otherwise(0)
    rows = cells.groupBy(*keys, "row").agg(F.sum(F.when(~F.col("covered"), F.col("borders")).otherwise(0)).alias("_n"), inner.alias("_inner"), (F.max("col") + 1).alias("_w"))
    every = Window.partitionBy(*keys)
    floor = F.max("_inner").over(every) * F.greatest(F.lit(1), F.expr("cast(_wide div 4 AS int)"))
    return rows.withColumn("_wide", F.max("_w").over(every)).withColumn("borders", F.when(F.col("_n") == 0, floor).otherwise(F.col("_n")).cast("long")).select(*keys, "row", "borders")


def sheet_measures(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, has_value, borders, merges, score) of sheets' rows: cells with a border, merges that begin, and how much like a table's row it is."""
    seen = ~F.col("covered") & ~T.is_empty(F.col("text"))
    texts = F.transform(F.array_sort(F.collect_list(F.when(seen, F.struct("col", T.strip(F.col("text")).alias("t"))))), lambda x: x["t"])
    n = lambda c: F.sum(c.cast("int"))
    rows = cells.groupBy(*keys, "row").agg(F.bool_or(seen).alias("has_value"), n(F.coalesce("borders", F.lit(0)) > 0).alias("borders"), n((F.col("rowspan") > 1) | (F.col("colspan") > 1)).alias("merges"), texts.alias("texts"))
    score = F.when(F.col("has_value"), 1.0).otherwise(0.0) + F.when(F.col("borders") >= 3, 2.0).when(F.col("borders") >= 1, 0.8).otherwise(0.0) + F.when(F.col("merges") >= 1, 0.8).otherwise(0.0) + F.when(sheet_index_header(F.col("texts")), 3.0).otherwise(0.0)
    return rows.withColumn("score", score)


def table_regions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of sheet_measures to regions (keys, region, first_row, last_row): runs of rows that look like a table's, and those with some border or merge behind or right before one.

    A single row with few borders is a title; a region without values counts only with borders enough.
    """
    order = Window.partitionBy(*keys).orderBy("row")
    tab = (F.col("score") >= 1.5) | ((F.col("borders") >= 2) & F.col("has_value"))
    near = F.col("has_value") & ((F.col("borders") >= 1) | (F.col("merges") >= 1))
    r = rows.repartition(*keys).withColumns({"_tab": tab, "_may": tab | near})
    next_to = F.coalesce(F.lead("_tab").over(order) & (F.lead("row").over(order) == F.col("row") + 1), F.lit(False))
    broken = F.coalesce(F.lag("row").over(order) != F.col("row") - 1, F.lit(True))
    r = r.withColumns({"_next": next_to, "_run": F.sum(F.when(F.col("_may") & ~broken, 0).otherwise(1)).over(order)})
    behind = F.coalesce(F.max(F.col("_tab").cast("int")).over(Window.partitionBy(*keys, "_run").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    on = r.withColumn("_on", F.col("_tab") | (F.col("_may") & (behind | F.col("_next")))).where("_on")
    start = F.coalesce(F.lag("row").over(order) != F.col("row") - 1, F.lit(True)).cast("int")
    found = on.withColumn("_start", start).withColumn("region", F.sum("_start").over(order) - 1).groupBy(*keys, "region").agg(F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.sum("borders").alias("_b"), F.sum(F.col("has_value").cast("int")).alias("_v"))
    title = (F.col("first_row") == F.col("last_row")) & (F.col("_b") < 2) & (F.col("_v") <= 1)
    return found.where(~title & ((F.col("_v") > 0) | (F.col("_b") >= 4))).drop("_b", "_v")


def region_grids(cells: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of each region (keys, region, row from 0, col, text, more, spans, covered): merges are clipped to its rows, and begin anew in its first row where they came from above."""
    of = lambda c: [F.col(f"r.{k}") == F.col(f"{c}.{k}") for k in keys]
    spot = F.col("m.row") + F.col("m.rowspan") - 1
    origins = cells.where("(rowspan > 1 OR colspan > 1) AND NOT covered").alias("m")
    clipped = origins.join(regions.alias("r"), [*of("m"), F.col("m.row") <= F.col("r.last_row"), spot >= F.col("r.first_row")]).select(
        *[F.col(f"r.{k}").alias(k) for k in keys], "r.region", (F.greatest("m.row", "r.first_row") - F.col("r.first_row")).alias("r0"), F.col("m.col").alias("c0"), (F.least(spot, F.col("r.last_row")) - F.col("r.first_row")).alias("r1"), (F.col("m.col") + F.col("m.colspan") - 1).alias("c1")
    )
    own = cells.drop("rowspan", "colspan", "covered").alias("c").join(regions.alias("r"), [*of("c"), F.col("c.row").between(F.col("r.first_row"), F.col("r.last_row"))])
    own = own.select("c.*", "r.region", "r.first_row").withColumn("row", (F.col("row") - F.col("first_row")).cast("int"))
    return J.expand_merges(own, clipped, [*keys, "region"])


def sheet_blocks(rows: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (row, joined) of sheets in blocks: tables where a region is, prose between; a sheet without regions is one table.

    Returns keys, block (in order of rows), kind, row, joined; rows without text stand in tables only.
    """
    order = Window.partitionBy(*keys).orderBy("row")
    none = rows.select(*keys).distinct().join(regions, keys, "left_anti").withColumns({"region": F.lit(-1).cast("long"), "first_row": F.lit(0), "last_row": F.lit(2147483647)})
    every = regions.select(*keys, F.col("region").cast("long").alias("region"), "first_row", "last_row").unionByName(none)
    inside = rows.join(every, keys).where(F.col("row").between(F.col("first_row"), F.col("last_row"))).select(*keys, "row", "region")
    placed = rows.join(inside, [*keys, "row"], "left").where(F.col("region").isNotNull() | (F.col("joined") != ""))
    before = F.lag(F.coalesce("region", F.lit(-2))).over(order)
    start = F.coalesce(before != F.coalesce("region", F.lit(-2)), F.lit(True)).cast("int")
    placed = placed.withColumn("_start", start).withColumn("block", F.sum("_start").over(order) - 1)
    return placed.select(*keys, "block", F.when(F.col("region").isNotNull(), "table").otherwise("prose").alias("kind"), "row", "joined")


def split_layouts(cells: DataFrame, bands: DataFrame, layouts: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with a column band: tables drawn as layouts (keys, layout_form) cut at their bands (row, band), each band's rows from 0."""
    b = bands.select(*keys, "row", "band").join(layouts.where("layout_form").select(*keys), keys)
    own = cells.join(b, [*keys, "row"], "left").withColumn("band", F.coalesce("band", F.lit(0)))
    first = F.min("row").over(Window.partitionBy(*keys, "band"))
    return own.withColumn("row", F.col("row") - first)


def sheet_index_header(texts: Column, least: int = 6) -> Column:
    """A sheet's row that numbers its columns: 1, 2, ... up to 40, other texts before or after; or «А 1 1а ...» with letters."""
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("ok"), F.lit(False).alias("done"))

    def step(s, t):
        number = F.when(t.rlike(r"^\d{1,2}$") & t.try_cast("int").between(1, 40), t.try_cast("int"))
        go = number.isNotNull() & ~s["done"]
        return F.struct(F.when(go, s["n"] + 1).otherwise(s["n"]).alias("n"), (s["ok"] & (~go | F.coalesce(number == s["n"] + 1, F.lit(True)))).alias("ok"), (s["done"] | (number.isNull() & (s["n"] > 0))).alias("done"))

    plain = F.aggregate(texts, start, step, lambda s: s["ok"] & (s["n"] >= least))
    parts = F.transform(texts, lambda t: F.lower(F.translate(t, "\n ", "")))
    short = F.size(F.filter(parts, lambda p: F.length(p) <= 3)) >= least
    coded = F.array_contains(parts, "1") & F.array_contains(parts, "2") & (F.exists(parts, lambda p: p.rlike("^[0-9]{1,2}[аaбb]$")) | F.coalesce(F.get(parts, F.lit(0)).isin("а", "a"), F.lit(False)))
    # few rows have texts enough and a 1 among them: the others aren't read text by text
    likely = (F.size(texts) >= least) & F.array_join(texts, "\n").rlike(r"(?m)^\s*0?1\s*$")
    return F.when(likely, plain | (short & coded)).otherwise(False)
