"""Joins of words, boxes and tables. Every join has the page or table as an equi key; ranges come on top."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G


def word_key() -> list[Column]:
    """What makes a word the same one: rounded place and text."""
    return [F.bround("x0", 1), F.bround("top", 1), F.bround("x1", 1), F.col("text")]


def centre(kind: str = "w") -> tuple[Column, Column]:
    return (F.col(f"{kind}.x0") + F.col(f"{kind}.x1")) / 2, (F.col(f"{kind}.top") + F.col(f"{kind}.bottom")) / 2


def _same(keys: list[str], a: str, b: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & (F.col(f"{a}.{k}") == F.col(f"{b}.{k}"))
    return out


def words_in_slots(words: DataFrame, slots: DataFrame, keys: list[str], margin: float = 0.0) -> DataFrame:
    """Every slot (bbox, more columns) with the words whose centre it holds, edges included; empty slots stay."""
    x, y = centre()
    return slots.alias("s").join(words.alias("w"), _same(keys, "s", "w") & G.holds(F.col("s.bbox"), x, y, margin), "left").select("s.*", *[F.col(f"w.{c}").alias(f"word_{c}" if c != "word_id" else c) for c in words.columns if c not in keys])


def inside(keys: list[str], words: str, boxes: str, margin: float) -> Column:
    """Whether a word's centre lies in a box of its page; both are aliases."""
    x, y = centre(words)
    return _same(keys, words, boxes) & G.holds(F.col(f"{boxes}.bbox"), x, y, margin)


def slot_words(words: DataFrame, slots: DataFrame, keys: list[str], band: float = 48.0) -> DataFrame:
    """Words with the slots (table_id, row, col, bbox) that hold their centres; slots without words don't come.

    Slots go to all bands of the page that they reach, words to their centre's, so a word meets the slots of its
    own height only.
    """
    reach = lambda c: F.floor(F.col(f"bbox.{c}") / band)
    kept, more = ["table_id", "row", "col"], [c for c in words.columns if c not in keys]
    s = slots.where("bbox IS NOT NULL").dropna(subset=keys).select(*keys, F.explode(F.sequence(reach("top"), reach("bottom"))).alias("_band"), F.struct(*kept, "bbox").alias("s"))
    w = words.select(*keys, F.floor((F.col("top") + F.col("bottom")) / 2 / band).alias("_band"), F.struct(*more).alias("w"))
    # no join: that would shuffle both by page and band, while this stays where pages were dealt to
    near = F.collect_list("s").over(Window.partitionBy(*keys, "_band"))
    met = s.unionByName(w, allowMissingColumns=True).withColumn("s", near).where("w IS NOT NULL").select(*keys, "w", F.explode("s").alias("s"))
    return met.where(G.holds(F.col("s.bbox"), *centre(), 0.0)).select(*keys, *[F.col(f"s.{c}").alias(c) for c in kept], *[F.col(f"w.{c}").alias(c) for c in more])


def words_of_tables(words: DataFrame, tables: DataFrame, keys: list[str], margin: float = 1.0, outside: bool = False) -> DataFrame:
    """Words whose centre lies in any table's box, or in none."""
    x, y = centre()
    return words.alias("w").join(tables.alias("t"), _same(keys, "w", "t") & G.holds(F.col("t.bbox"), x, y, margin), "left_anti" if outside else "left_semi")


def used_words(words: DataFrame, cell_words: DataFrame, tables: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of words that cells or tables (2 points around) took."""
    key = [c.alias(f"k{i}") for i, c in enumerate(word_key())]
    near = words_of_tables(words, tables, keys, 2.0)
    return cell_words.select(*keys, *key).union(near.select(*keys, *key)).distinct()


def free_words(words: DataFrame, used: DataFrame, keys: list[str]) -> DataFrame:
    """Words that aren't blank and whose key isn't among the used ones."""
    w = words.where(F.trim("text") != "").withColumns({f"k{i}": c for i, c in enumerate(word_key())})
    return w.join(used, [*keys, "k0", "k1", "k2", "k3"], "left_anti").drop("k0", "k1", "k2", "k3")


def drop_nested(tables: DataFrame, keys: list[str], share: float = 0.85) -> DataFrame:
    """Tables (table_id, bbox) but those that another one covers; of two that cover each other the lower id stays."""
    inner, outer = F.col("i.bbox"), F.col("o.bbox")
    over = G.intersection(inner, outer)
    covered = (over >= share * G.area(inner)) & (G.area(inner) > 0)
    mutual = over >= share * G.area(outer)
    wins = ~mutual | (F.col("o.table_id") < F.col("i.table_id"))
    return tables.alias("i").join(tables.alias("o"), _same(keys, "i", "o") & (F.col("i.table_id") != F.col("o.table_id")) & covered & wins, "left_anti")


def uncovered_share(boxes: DataFrame, tables: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, box_id, uncovered): the share of each box that no table takes, overlaps of tables counted each."""
    both = boxes.alias("b").join(tables.alias("t"), _same(keys, "b", "t"), "left")
    shared = F.coalesce(G.intersection(F.col("b.bbox"), F.col("t.bbox")), F.lit(0.0))
    each = both.groupBy(*[F.col(f"b.{k}").alias(k) for k in keys], F.col("b.box_id").alias("box_id")).agg(F.max(G.area(F.col("b.bbox"))).alias("area"), F.sum(shared).alias("shared"))
    return each.select(*keys, "box_id", F.when(F.col("area") > 0, F.greatest(F.lit(0.0), 1 - F.col("shared") / F.col("area"))).otherwise(0.0).alias("uncovered"))


def expand_merges(cells: DataFrame, merges: DataFrame, keys: list[str]) -> DataFrame:
    """Cells (row, col) with spans and covered flags of merge ranges (r0, c0, r1, c1)."""
    hit = _same(keys, "c", "m") & F.col("c.row").between(F.col("m.r0"), F.col("m.r1")) & F.col("c.col").between(F.col("m.c0"), F.col("m.c1"))
    origin = (F.col("c.row") == F.col("m.r0")) & (F.col("c.col") == F.col("m.c0"))
    return cells.alias("c").join(merges.alias("m"), hit, "left").select(
        "c.*", F.when(origin, F.col("m.r1") - F.col("m.r0") + 1).otherwise(1).alias("rowspan"), F.when(origin, F.col("m.c1") - F.col("m.c0") + 1).otherwise(1).alias("colspan"), F.coalesce(~origin, F.lit(False)).alias("covered")
    )


def columns_under(extents: DataFrame, columns: DataFrame, keys: list[str]) -> DataFrame:
    """Columns (col, x0, x1) whose centre lies in an extent (extent_id, lo, hi)."""
    middle = (F.col("c.x0") + F.col("c.x1")) / 2
    return extents.alias("e").join(columns.alias("c"), _same(keys, "e", "c") & middle.between(F.col("e.lo"), F.col("e.hi"))).select("e.*", F.col("c.col"))


def strip_right_of_code(words: DataFrame, codes: DataFrame, keys: list[str], margin: float = 3.0, band: float = 4.0) -> DataFrame:
    """Words left of the code box (code_x0), but those on the band of its date line (date_top)."""
    w = words.join(codes, keys, "left")
    left = F.col("code_x0").isNull() | (F.col("x0") < F.col("code_x0") - margin)
    dated = F.coalesce(F.abs(F.col("top") - F.col("date_top")) <= band, F.lit(False))
    return w.where(left & ~dated).drop("code_x0", "date_top")


def side_labels(words: DataFrame, rows: DataFrame, keys: list[str], width: float, reach: float = 0.3, slack: float = 2.0) -> DataFrame:
    """Words beside a grid (rows: row, top, bottom, left, right) that share a band with a word inside it.

    Returns keys, row, side, word_id, text. A word goes to the first row whose band it meets.
    """
    x, _ = centre()
    band = _same(keys, "w", "r") & (F.col("w.top") <= F.col("r.bottom") + slack) & (F.col("w.bottom") >= F.col("r.top") - slack)
    met = words.alias("w").join(rows.alias("r"), band)
    side = F.when(F.col("w.x1") <= F.col("r.left"), "left").when(F.col("w.x0") >= F.col("r.right"), "right").otherwise("inside")
    near = F.greatest(F.col("r.left") - F.col("w.x1"), F.col("w.x0") - F.col("r.right")) <= reach * width
    met = met.select(*[F.col(f"w.{k}").alias(k) for k in keys], F.col("r.row").alias("row"), side.alias("side"), near.alias("near"), F.col("w.word_id").alias("word_id"), F.col("w.text").alias("text"), F.col("w.top").alias("top"), F.col("w.bottom").alias("bottom"))
    anchors = met.where("side = 'inside'").select(*keys, "row", F.col("top").alias("a_top"), F.col("bottom").alias("a_bottom"))
    beside = met.where("side <> 'inside' AND near").alias("o")
    aligned = G.y_aligned(F.col("o.top"), F.col("o.bottom"), F.col("a.a_top"), F.col("a.a_bottom"), 3.0)
    found = beside.join(anchors.alias("a"), _same([*keys, "row"], "o", "a") & aligned, "left_semi")
    return found.groupBy(*keys, "word_id", "side", "text").agg(F.min("row").alias("row"))


def label_to_values(rows: DataFrame, keys: list[str], slack: float = 14.0) -> DataFrame:
    """Label-only rows to value rows next to them whose band they meet; a label goes to the first value row."""
    near = _same(keys, "l", "v") & (F.abs(F.col("l.row") - F.col("v.row")) <= 1) & (F.col("l.row") != F.col("v.row"))
    meets = (F.col("l.top") <= F.col("v.bottom") + slack) & (F.col("l.bottom") >= F.col("v.top") - slack)
    labels, values = rows.where("label_only").alias("l"), rows.where("has_values").alias("v")
    return labels.join(values, near & meets).groupBy(*[F.col(f"l.{k}").alias(k) for k in keys], F.col("l.row").alias("label_row")).agg(F.min("v.row").alias("value_row"))


def lookup(df: DataFrame, column: str, table: dict, name: str, default=None) -> DataFrame:
    """A column by a small fixed table, as an expression."""
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    return df.withColumn(name, F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(default)))
