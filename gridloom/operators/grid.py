"""Aggregates, predicates and rewrites of grids. Cells: keys, row, col, text, rowspan, colspan, covered, x0, x1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def visible() -> Column:
    return ~F.col("covered") & ~T.is_empty(F.col("text"))


def bbox_union(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom"))


def column_bounds(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The narrowest cell of each column; the first row wins ties."""
    best = F.min_by(F.struct("x0", "x1"), F.struct((F.col("x1") - F.col("x0")).alias("w"), F.col("row")))
    return cells.where("x0 IS NOT NULL").groupBy(*keys, "col").agg(best.alias("b")).select(*keys, "col", "b.x0", "b.x1")


def row_bounds(cells: DataFrame, keys: list[str], only: Column | None = None) -> DataFrame:
    """Least top and greatest bottom of each row, of chosen cells only if asked."""
    take = lambda c: F.when(only, F.col(c)) if only is not None else F.col(c)
    return cells.groupBy(*keys, "row").agg(F.min(take("top")).alias("top"), F.max(take("bottom")).alias("bottom"))


def dominant(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    """The most frequent value; the one seen first wins ties."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(seq).alias("_first"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("n", -F.col("_first"))).alias(value), F.max("n").alias("n"))


def span_stats(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Merged cells of each table: how many, what they absorb, the largest."""
    c, r, open_ = F.col("colspan"), F.col("rowspan"), ~F.col("covered")
    count = lambda x: F.sum(F.when(open_ & x, 1).otherwise(0))
    most = lambda x: F.greatest(F.lit(1), F.max(F.when(open_, x).otherwise(1)))
    absorbed = F.sum(F.when(open_, F.greatest(c - 1, F.lit(0)) + F.greatest(r - 1, F.lit(0))).otherwise(0))
    return cells.groupBy(*keys).agg(count((c > 1) | (r > 1)).alias("span_cells"), count(c > 1).alias("colspan_cells"), count(r > 1).alias("rowspan_cells"), absorbed.alias("absorbed"), most(c).alias("max_colspan"), most(r).alias("max_rowspan"))


def size_stats(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, widest row and uncovered cells of each table."""
    rows = cells.groupBy(*keys, "row").agg(F.count("*").alias("w"), F.sum(F.when(~F.col("covered"), 1).otherwise(0)).alias("c"))
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.max("w").alias("n_cols"), F.sum("c").alias("n_cells"))


def row_signals(cells: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """What each row shows: filled cells, share of numbers, texts, sentences, and whether it looks like data; more: further aggregates."""
    t = T.strip(F.col("text"))
    c = cells.withColumns({"_t": t, "_see": visible(), "_num": T.looks_numeric(F.col("text")), "_val": T.data_value(F.col("text"))})
    see = lambda x: F.col("_see") & x
    any_ = lambda x: F.bool_or(see(x))
    cross = F.col("_t").isin("Х", "X", "х", "x")
    value = F.col("_num") | F.col("_val")
    word = F.col("text").rlike("[A-Za-zА-Яа-яЁё]{2,}")
    mixed = F.col("text").rlike(r"\d") & F.col("text").rlike("[A-Za-zА-Яа-я-]")
    text = see(~F.col("_num"))
    out = c.groupBy(*keys, "row").agg(
        F.sum(see(F.lit(True)).cast("int")).alias("filled"), F.sum(see(F.col("_num")).cast("int")).alias("numbers"), F.sum(text.cast("int")).alias("texts"),
        F.sum((text & (F.length("_t") > 50) & F.col("_t").rlike("[.;»]$")).cast("int")).alias("sentences"), F.array_join(T.in_order(F.collect_list(F.when(F.col("_see"), F.struct("col", "_t"))), "_t"), " ").alias("joined"),
        any_(F.col("_t").rlike(r"^\d{4}$")).alias("_account"), any_(F.col("_val") | F.col("_t").isin("Х", "X", "х", "x", "-", "—")).alias("_any"), any_(cross).alias("_cross"), any_(F.col("_val")).alias("_value"),
        any_((F.col("col") == 0) & T.has_letter(F.col("text"))).alias("_left"), any_((F.col("col") > 0) & value).alias("_right"), any_(mixed).alias("_mixed"),
        F.min(F.when(see(word), F.col("col"))).alias("_word"), F.max(F.when(see(value), F.col("col"))).alias("_last"), any_(F.col("text").contains("•")).alias("bullet"), *more,
    )
    data = (F.col("_account") & F.col("_any")) | (F.col("_cross") & F.col("_value")) | (F.col("_left") & F.col("_right")) | F.coalesce(F.col("_last") > F.col("_word"), F.lit(False)) | F.col("_mixed")
    ratio = F.when(F.col("filled") > 0, F.col("numbers") / F.col("filled")).otherwise(0.0)
    return out.withColumn("numeric_ratio", ratio).withColumn("tabular", (F.col("filled") >= 2) & data).withColumn("label_and_number", F.col("_left") & F.col("_right")).drop("_account", "_any", "_cross", "_value", "_word", "_last", "_mixed", "_left").withColumnRenamed("_right", "number_right")


def prose_tables(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Whether each table is running text or a list of contents, with the measures that decide."""
    length = F.length(T.strip(F.col("text")))
    size = (F.count("*").alias("width"), F.sum(F.when(visible(), length).otherwise(0)).alias("chars"), F.max(F.when(F.col("col") == 0, length)).alias("head_chars"))
    r = row_signals(cells.repartition(*keys), keys, *size)
    n = lambda c: F.sum(c.cast("int"))
    t = r.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.max("width").alias("n_cols"), F.sum("filled").alias("filled"), F.sum("numbers").alias("numbers"), n(F.col("filled") == 1).alias("blobs"), n(F.col("label_and_number")).alias("tabular_rows"),
        n(F.col("bullet")).alias("bullets"), n((F.col("filled") >= 2) & ~F.col("number_right")).alias("text_rows"), n((F.col("filled") == 1) & (F.coalesce("head_chars", F.lit(0)) >= 55)).alias("long_rows"), F.sum("chars").alias("chars"),
    )
    blob, numeric, rows_, cols, tab = F.col("blobs") / F.col("n_rows"), F.col("numbers") / F.col("filled"), F.col("n_rows"), F.col("n_cols"), F.col("tabular_rows")
    prose = (
        F.when(F.col("filled") == 0, False).when(tab >= 4, False).when((F.col("bullets") >= 2) & (numeric < 0.22), True)
        .when((tab < 2) & (F.col("text_rows") >= F.greatest(F.lit(4), F.floor(rows_ / 3))) & (numeric < 0.22), True)
        .when((cols >= 4) & (tab < 3) & (numeric < 0.18) & (rows_ >= 8) & (F.col("filled") / rows_ >= 2.2), True)
        .when((tab < 2) & (blob >= 0.48) & (numeric < 0.3) & (rows_ >= 6), True)
        .when((cols <= 3) & (blob >= 0.55) & (numeric < 0.28), True)
        .when((blob >= 0.8) & (numeric < 0.12) & (rows_ >= 3), True)
        .when((blob >= 0.7) & (numeric < 0.18) & (rows_ >= 4), True)
        .when((F.col("long_rows") >= 4) & (numeric < 0.24), True)
        .when((cols >= 4) & (blob >= 0.48) & (numeric < 0.22) & (rows_ >= 8) & (F.col("chars") / F.col("filled") >= 32), True)
        .otherwise(False)
    )
    return t.withColumn("prose", prose)


def code_column(cells: DataFrame, keys: list[str], least: int = 3) -> DataFrame:
    """The column with most four-digit codes (the first on ties), and the label column left of it."""
    hits = cells.where(T.strip(F.col("text")).rlike(r"^\d{4}$") & ~F.col("covered")).groupBy(*keys, "col").agg(F.count("*").alias("n"))
    best = hits.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("col")).alias("c"))).alias("b")).where(F.col("b.n") >= least)
    return best.select(*keys, (-F.col("b.c")).alias("code_col"), F.greatest(F.lit(0), -F.col("b.c") - 1).alias("label_col"), F.col("b.n").alias("hits"))


def label_column(cells: DataFrame, keys: list[str], among: int = 3) -> DataFrame:
    """Among the first columns the one with most labels; the first on ties."""
    hits = cells.where((F.col("col") < among) & T.has_letter(F.col("text")) & visible()).groupBy(*keys, "col").agg(F.count("*").alias("n"))
    return hits.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("col")).alias("c"))).alias("b")).select(*keys, (-F.col("b.c")).alias("label_col"), F.col("b.n").alias("labels"))


def right_code_column(cells: DataFrame, keys: list[str], least: int = 2, share: float = 0.4) -> DataFrame:
    """Among the rightmost three columns the one with most codes of five to eight digits; the last on ties."""
    width = F.max("col").over(Window.partitionBy(*keys))
    code = T.strip(F.col("text")).rlike(r"^\d{5,8}$")
    c = cells.withColumn("_w", width).where("col > _w - 3")
    hits = c.groupBy(*keys, "col").agg(F.sum(code.cast("int")).alias("n"), F.sum(visible().cast("int")).alias("filled")).where((F.col("n") >= least) & (F.col("n") >= share * F.col("filled")))
    return hits.groupBy(*keys).agg(F.max(F.struct("n", "col")).alias("b")).select(*keys, F.col("b.col").alias("code_col"), F.col("b.n").alias("hits"))


def index_header(cells: DataFrame, keys: list[str], least: int = 6, limit: int = 99) -> DataFrame:
    """Rows that number their columns: 1, 2, ... to six at least; a leading letter column may stand before."""
    texts = F.transform(F.array_sort(F.collect_list(F.when(visible(), F.struct("col", T.strip(F.col("text")).alias("t"))))), lambda x: x["t"])
    rows = cells.groupBy(*keys, "row").agg(texts.alias("t"))
    plain = F.filter("t", lambda x: ~x.rlike("^[АA]$"))
    n = F.size(plain)
    wanted = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i.cast("string"))
    return rows.select(*keys, "row", F.coalesce((n >= least) & (n <= limit) & (plain == wanted), F.lit(False)).alias("index_header"))


def line_item_table(cells: DataFrame, keys: list[str], within: int = 6, least: int = 3) -> DataFrame:
    """Tables of line items: numbered columns near the top, or three rows of number, name and amount."""
    index = index_header(cells.where(F.col("row") < within), keys).groupBy(*keys).agg(F.bool_or("index_header").alias("by_index"))
    t = T.strip(F.col("text"))
    first = F.bool_or((F.col("col") == 0) & t.rlike(r"^\d{1,3}\.?$"))
    rows = cells.where(visible()).groupBy(*keys, "row").agg((first & F.bool_or((F.col("col") > 0) & T.has_letter(t) & (F.length(t) >= 4)) & F.bool_or((F.col("col") > 1) & T.looks_numeric(t))).alias("item"))
    items = rows.groupBy(*keys).agg(F.sum(F.col("item").cast("int")).alias("items"))
    return items.join(index, keys, "left").select(*keys, "items", F.coalesce("by_index", F.lit(False)).alias("by_index"), (F.coalesce("by_index", F.lit(False)) | (F.col("items") >= least)).alias("line_items"))


def financial_statement(cells: DataFrame, keys: list[str], least: int = 4) -> DataFrame:
    """Tables with at least four cells that are four-digit codes."""
    return cells.groupBy(*keys).agg((F.sum(T.strip(F.col("text")).rlike(r"^\d{4}$").cast("int")) >= least).alias("financial"))


def code_stack(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Narrow tables whose rows pair a label with a code."""
    t = T.strip(F.col("text"))
    rows = cells.groupBy(*keys, "row").agg(F.bool_or(visible() & T.has_letter(t)).alias("label"), F.bool_or(visible() & t.rlike(r"^\d{2,10}$")).alias("code"), F.count("*").alias("width"))
    return rows.groupBy(*keys).agg(((F.count("*") >= 3) & (F.max("width") <= 4) & (F.sum((F.col("label") & F.col("code")).cast("int")) >= 3)).alias("code_stack"))


def bare_totals(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of amounts only."""
    t = T.strip(F.col("text"))
    return cells.groupBy(*keys, "row").agg(((F.sum((visible() & T.looks_numeric(t)).cast("int")) >= 1) & ~F.bool_or(visible() & T.has_letter(t))).alias("bare"))


def layout_form(cells: DataFrame, keys: list[str], form: str) -> DataFrame:
    """Form sheets drawn as tables: form words in a large grid, or a sparse grid with many merges or columns."""
    rows = cells.groupBy(*keys, "row").agg(F.count("*").alias("w"), F.sum(visible().cast("int")).alias("f"), F.sum(((F.col("colspan") > 1) | (F.col("rowspan") > 1)).cast("int")).alias("m"), F.bool_or(visible() & F.col("text").rlike(form)).alias("form"))
    t = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.max("w").alias("n_cols"), F.sum("w").alias("cells"), F.sum("f").alias("filled"), F.sum("m").alias("merged"), F.bool_or("form").alias("form"))
    wide = ((F.col("n_rows") >= 8) & (F.col("n_cols") >= 4)) | ((F.col("n_rows") >= 12) & (F.col("n_cols") >= 3))
    sparse = (F.col("n_rows") >= 15) & (F.col("n_cols") >= 6) & (F.col("filled") < 0.55 * F.col("cells")) & ((F.col("merged") >= 0.12 * F.col("cells")) | (F.col("n_cols") >= 8))
    return t.select(*keys, "n_rows", "n_cols", "filled", ((F.col("form") & wide) | sparse).alias("layout_form"))


def phantom_boundaries(cells: DataFrame, keys: list[str], size: float = 10.0, factor: float = 2.0, share: float = 0.35) -> DataFrame:
    """Boundaries between columns that most rows write across: cells (row, col, text_x0, text_x1) side by side.

    support is the share of rows whose texts nearly touch over the boundary; a row with numbers on both sides keeps it.
    """
    a, b = cells.alias("a"), cells.alias("b")
    on = (F.col("a.row") == F.col("b.row")) & (F.col("b.col") == F.col("a.col") + 1)
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    pair = a.join(b, on).select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.col").alias("boundary"), (F.col("b.text_x0") - F.col("a.text_x1")).alias("gap"), (T.looks_numeric(F.col("a.text")) & T.looks_numeric(F.col("b.text"))).alias("keep"))
    out = pair.groupBy(*keys, "boundary").agg(F.avg(F.when(F.col("gap") <= factor * size, 1.0).otherwise(0.0)).alias("support"), F.bool_or("keep").alias("keep"))
    return out.withColumn("phantom", (F.col("support") >= share) & ~F.col("keep"))


def merge_phantom_columns(cells: DataFrame, phantom: DataFrame, keys: list[str]) -> DataFrame:
    """Cells rejoined over phantom boundaries: the new column is the old one less the phantoms left of it.

    Boundaries and columns of a table come as arrays beside its cells, which are dealt out once, by the keys.
    """
    gone = phantom.where("phantom").groupBy(*keys).agg(F.collect_set(F.col("boundary") + 1).alias("_gone"))
    own = cells.select(*keys, "row", "col", "text").repartition(*keys)
    there = cells.groupBy(*keys).agg(F.collect_set("col").alias("_cols"))
    gone = there.join(gone, keys, "left").select(*keys, F.array_intersect("_cols", F.coalesce("_gone", F.array().cast("array<int>"))).alias("_gone"))
    shifted = own.join(gone, keys).withColumn("new_col", (F.col("col") - F.size(F.filter("_gone", lambda c: c <= F.col("col")))).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct("col", "text")))
    return shifted.groupBy(*keys, "row", "new_col").agg(T.join_labels(F.transform(parts, lambda p: p["text"])).alias("text"))


def drop_empty(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Without columns and rows that have no text; the rest renumbered, spans cut to what is kept."""
    open_ = visible()
    rows = cells.groupBy(*keys, "row").agg(F.bool_or(open_).alias("k")).where("k").withColumn("new_row", F.row_number().over(Window.partitionBy(*keys).orderBy("row")) - 1).drop("k")
    cols = cells.groupBy(*keys, "col").agg(F.bool_or(open_).alias("k")).where("k").withColumn("new_col", F.row_number().over(Window.partitionBy(*keys).orderBy("col")) - 1).drop("k")
    return cells.join(rows, [*keys, "row"]).join(cols, [*keys, "col"]).drop("row", "col").withColumnsRenamed({"new_row": "row", "new_col": "col"})


def compact(cells: DataFrame, keys: list[str]) -> DataFrame:
    """drop_empty with colspans shrunk to kept columns and rowspans clamped; columns under a merged cell count as used.

    Cells are dealt out once, by the keys: rows are numbered in windows, a table's used columns come as an array.
    """
    wide = F.greatest(F.col("colspan"), F.lit(1))
    own = cells.repartition(*keys)
    reach = F.when(visible(), F.sequence(F.col("col"), F.col("col") + wide - 1))
    used = cells.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(reach)))).alias("_cols"))
    kept = own.withColumn("_open", F.bool_or(visible()).over(Window.partitionBy(*keys, "row"))).where("_open").drop("_open")
    kept = kept.withColumn("_row", F.dense_rank().over(Window.partitionBy(*keys).orderBy("row")) - 1).withColumn("_rows", F.max("_row").over(Window.partitionBy(*keys)) + 1)
    out = kept.join(used, keys).withColumn("_col", F.array_position("_cols", F.col("col")).cast("int") - 1).where("_col >= 0")
    span = F.size(F.filter("_cols", lambda c: (c >= F.col("col")) & (c < F.col("col") + wide)))
    out = out.withColumn("colspan", span).withColumn("rowspan", F.least(F.col("rowspan"), (F.col("_rows") - F.col("_row")).cast("int")))
    return out.drop("row", "col", "_cols", "_rows").withColumnsRenamed({"_row": "row", "_col": "col"})


def slice_rows(cells: DataFrame, first: int, last: int) -> DataFrame:
    """Rows first to last, renumbered from 0; rowspans end with them."""
    cut = cells.where(F.col("row").between(first, last))
    return cut.withColumn("rowspan", F.least(F.col("rowspan"), F.lit(last) - F.col("row") + 1)).withColumn("row", F.col("row") - first)


def matrix(cells: DataFrame, keys: list[str]) -> DataFrame:
    """A full matrix: every row as long as the widest, blanks where a merged cell goes on or nothing is.

    Cells are dealt out once, by the keys; each row's texts are an array that its columns look into.
    """
    shown = F.when(~F.col("covered"), F.struct("col", T.strip(F.col("text")).alias("t")))
    end = F.max(F.when(~F.col("covered"), F.col("col") + F.greatest(F.col("colspan"), F.lit(1)) - 1))
    rows = cells.repartition(*keys).groupBy(*keys, "row").agg(F.collect_list(shown).alias("_texts"), end.alias("_end"))
    slots = rows.withColumn("_w", F.max("_end").over(Window.partitionBy(*keys))).select(*keys, "row", "_texts", F.explode(F.sequence(F.lit(0), F.col("_w"))).alias("col"))
    text = F.array_max(F.transform(F.filter("_texts", lambda x: x["col"] == F.col("col")), lambda x: x["t"]))
    return slots.select(*keys, "row", "col", F.coalesce(text, F.lit("")).alias("text"))



def peel_codes(cells: DataFrame, codes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows as (label, code): all other texts joined, the code column apart."""
    c = cells.join(codes.select(*keys, "code_col"), keys).where(visible())
    label = F.transform(F.array_sort(F.collect_list(F.when(F.col("col") != F.col("code_col"), F.struct("col", "text")))), lambda x: x["text"])
    return c.groupBy(*keys, "row").agg(T.join_labels(label).alias("label"), F.max(F.when(F.col("col") == F.col("code_col"), T.strip(F.col("text")))).alias("code"))


def flatten(cells: DataFrame, keys: list[str], sep: str = " ") -> DataFrame:
    """All uncovered texts of a table in order."""
    parts = F.array_sort(F.collect_list(F.when(visible(), F.struct("row", "col", T.strip(F.col("text")).alias("t")))))
    return cells.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["t"]), sep).alias("text"))


def value_colspan(cells: DataFrame, keys: list[str]) -> DataFrame:
    """A row's single value spans all value columns."""
    w = Window.partitionBy(*keys, "row")
    filled = F.sum((visible() & (F.col("col") > 0)).cast("int")).over(w)
    width = F.max("col").over(Window.partitionBy(*keys))
    return cells.withColumn("colspan", F.when((filled == 1) & visible() & (F.col("col") > 0), F.greatest(width, F.lit(1))).otherwise(F.col("colspan")))


def split_number_name(cells: DataFrame, keys: list[str]) -> DataFrame:
    """A cell of number and name with an empty right neighbour as two cells."""
    right = F.lead("text").over(Window.partitionBy(*keys, "row").orderBy("col"))
    left = F.lag("text").over(Window.partitionBy(*keys, "row").orderBy("col"))
    pattern = r"(?s)^\s*(\d{1,3})\s+(\S.*)$"
    splits = lambda text, col, span: text.rlike(pattern) & ((col == 0) | (span >= 2))
    w = Window.partitionBy(*keys, "row").orderBy("col")
    own = splits(F.col("text"), F.col("col"), F.col("colspan")) & T.is_empty(right) & right.isNotNull()
    prior = splits(left, F.lag("col").over(w), F.lag("colspan").over(w)) & T.is_empty(F.col("text"))
    return cells.withColumn("_new", F.when(F.coalesce(own, F.lit(False)), F.regexp_extract("text", pattern, 1)).when(F.coalesce(prior, F.lit(False)), T.strip(F.regexp_extract(left, pattern, 2))).otherwise(F.col("text"))).drop("text").withColumnRenamed("_new", "text")


def shift_sections(rows: DataFrame, keys: list[str], pattern: str) -> DataFrame:
    """Rows whose label holds a section and its first item as two rows; values go with the item."""
    section, item = F.regexp_extract("label", pattern, 1), F.regexp_extract("label", pattern, 2)
    both = F.array(F.struct(section.alias("label"), F.lit(None).cast("string").alias("value"), F.lit(0).alias("part")), F.struct(item.alias("label"), F.col("value"), F.lit(1).alias("part")))
    one = F.array(F.struct(F.col("label"), F.col("value"), F.lit(0).alias("part")))
    cut = rows.select(*keys, "row", F.explode(F.when(F.col("label").rlike(pattern), both).otherwise(one)).alias("x"))
    return cut.select(*keys, (F.row_number().over(Window.partitionBy(*keys).orderBy("row", "x.part")) - 1).alias("row"), "x.label", "x.value")
