"""What rows and tables of forms are: headers, items, prose, chrome. Expressions over each row's visible texts.

Rows come from ``rows_of``: keys, row, texts (visible, in order), joined, max_colspan (of uncovered cells) and
width. All tests are built-in functions; a table's tests need one shuffle, by the table's keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from . import grid as G


def says(text: Column, pattern: str) -> Column:
    """Whether a pattern of config occurs, in capitals or not."""
    return text.rlike("(?iu)" + pattern)


def upper_share(text: Column) -> Column:
    n = lambda other: F.length(F.regexp_replace(text, other, ""))
    return F.coalesce(F.try_divide(n(r"[^\p{Lu}]+"), n(r"[^\p{L}]+")), F.lit(0.0))


def n_of(texts: Column, test) -> Column:
    return F.size(F.filter(texts, test))


def rows_of(cells: DataFrame, keys: list[str]) -> DataFrame:
    seen = F.when(~F.col("covered") & (F.col("_t") != ""), F.struct("col", F.col("_t").alias("t")))
    rows = cells.repartition(*keys).withColumn("_t", T.strip(F.col("text"))).groupBy(*keys, "row").agg(
        T.in_order(F.collect_list(seen), "t").alias("texts"), F.greatest(F.lit(1), F.max(F.when(~F.col("covered"), F.col("colspan")))).alias("max_colspan"), F.count("*").alias("width")
    )
    return rows.withColumn("joined", F.array_join("texts", " "))


# ---- single texts ----
def column_header(text: Column) -> Column:
    """A column's title, which is never joined to its neighbours."""
    t = T.strip(text)
    low = F.lower(F.translate(t, "\n", " "))
    return clean_header(t, low, folded(low))


def folded(low: Column) -> Column:
    """A text in small letters with the seven rounded forms as plain letters, all that ``(?iu)`` folds further in Cyrillic: patterns in small letters need no flag on it, which costs a folding for each letter and branch."""
    return F.when(low.rlike("[\u1c80-\u1c86]"), F.translate(low, "\u1c80\u1c81\u1c82\u1c83\u1c84\u1c85\u1c86", "вдосттъ")).otherwise(low)


def clean_header(t: Column, low: Column, fold: Column) -> Column:
    """column_header of a stripped text, given in small letters and folded too; what is cheap and seldom true is asked first."""
    short = (F.length(t) <= 28) & t.rlike(r"\p{Lu}") & (F.size(F.split(t, r"\s+")) <= 4) & (upper_share(t) >= 0.65)
    by_words = low.isin(*C.HEADER_EXACT) | fold.rlike(C.HEADER_WHOLE) | (low.startswith("наименование") & low.rlike(r"^наименование(?:$|[^\p{L}\d_])") & (F.length(t) <= 48)) | (low.contains("район") & low.contains("промысл"))
    words = t.rlike(r"\p{L}") & (((F.length(t) <= 64) & fold.rlike(C.HEADER_PAYMENT)) | ((F.length(t) <= 96) & fold.rlike(C.HEADER_SECOND)))
    return (t != "") & (by_words | short | words)


def label_text(text: Column, col: Column) -> Column:
    """A label rather than a value; in the first column numbers of rows and years are labels too."""
    t = T.strip(text)
    return (t == "") | (~T.data_value(t) & (t.rlike("[A-Za-zА-Яа-яЁё«]") | ((col == 0) & t.rlike(r"^(\d{1,2}|20\d\d)$"))))


def labels_merge(a: Column, b: Column, col_a: Column, row_text: Column) -> Column:
    """Whether the label in the next column carries on this one; titles and years of columns never do."""
    x, y = T.strip(a), T.strip(b)
    year = r"\d{4}\s*г(?:ода?)?|на\s+31\s+декабря"
    apart = column_header(x) | column_header(y) | says(x, year) | says(y, year)
    number = (col_a == 0) & x.rlike(r"^\d{1,2}$") & T.has_letter(y) & ~row_text.rlike(r"\d{2}\.\d{2}\.\d{4}|\d[\d\s]*[.,]\d{2}(?:$|[^\p{L}\d_])")
    return (x != "") & (y != "") & ~apart & (x.rlike(r"[-,;]$") | y.rlike(r"^\p{Ll}") | number)


def cluster_numeric(text: Column) -> Column:
    t = T.strip(text)
    return (t != "") & (T.looks_numeric(t) | t.rlike(r"\d{2,}"))


def side_label(text: Column, fonts: Column, table_font: Column) -> Column:
    """Whether a fragment beside a table labels it: one font, no sentence, a form's word, a capital or the table's font."""
    t = T.strip(text)
    form = says(t, r"^(?:по\s+)?(?:ОКПО|ОКУД|ОКОПФ|ОКФС|ОКЕИ|ОКВЭД2?|ИНН|ОГРН)|^Форма\s+по|^Дата\s*\(|^Единица\s+измерения")
    sentence = t.endswith(".") & ~T.known_abbreviation(t)
    return (t != "") & (fonts <= 1) & ~sentence & ~T.stray_text(t) & (form | t.rlike(r"^\p{Lu}") | table_font)


def normalize_digits(text: Column) -> Column:
    """Runs of four and more single digits with blanks between become one grouped number."""
    run = r"\d(?: \d){3,}"
    parts, found = F.split(text, run, -1), F.regexp_extract_all(text, F.lit(run), F.lit(0))
    joined = F.zip_with(parts, F.concat(F.transform(found, lambda x: T.format_thousands(F.translate(x, " ", ""))), F.array(F.lit(""))), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.rlike(run), F.array_join(joined, "")).otherwise(text)


# ---- rows: texts and joined ----
def section_title_row(texts: Column, joined: Column, tabular: Column, facts: Column | None = None) -> Column:
    """A title in capitals on a row of its own."""
    letters = F.length(F.regexp_replace(joined, r"[^\p{L}]", ""))
    facts = text_facts(texts) if facts is None else facts
    plain = ~F.exists(facts, lambda x: x["value"] | x["t"].rlike(r"^\d{4}$")) & ~joined.rlike(r"^[XХxх]\s+[\d\s().,-]+$")
    return ~tabular & plain & F.length(joined).between(8, 120) & (letters >= 4) & (upper_share(joined) >= 0.85)


def intro_row(texts: Column) -> Column:
    only = F.get(texts, F.lit(0))
    return F.coalesce((F.size(texts) == 1) & (F.length(only) >= 80) & reduce(lambda a, b: a | b, [only.contains(m) for m in C.INTRO_MARKERS]), F.lit(False))


def line_code_row(texts: Column) -> Column:
    return F.exists(texts, lambda t: t.rlike(r"^\d{4}$"))


def company_row(texts: Column, joined: Column, facts: Column | None = None) -> Column:
    return joined.rlike(C.COMPANY) & (F.exists(texts, T.data_value) if facts is None else F.exists(facts, lambda x: x["value"]))


def text_facts(texts: Column) -> Column:
    """What each text of a row is, found once for all tests of the row: stripped first, then in small letters, as lambdas repeat what isn't a field."""
    clean = F.transform(texts, lambda t: F.struct(t.alias("t"), T.strip(t).alias("s")))
    low = F.transform(clean, lambda x: F.struct(x["t"].alias("t"), x["s"].alias("s"), F.lower(F.translate(x["s"], "\n", " ")).alias("low")))
    low = F.transform(low, lambda x: F.struct(x["t"].alias("t"), x["s"].alias("s"), x["low"].alias("low"), folded(x["low"]).alias("fold")))
    return F.transform(low, lambda x: F.struct(x["t"].alias("t"), clean_header(x["s"], x["low"], x["fold"]).alias("head"), T.clean_value(x["s"]).alias("value"), T.clean_stray(x["s"]).alias("stray"), T.has_letter(x["t"]).alias("letter")))


def header_row(texts: Column, facts: Column | None = None) -> Column:
    """A row of column titles; facts: text_facts of the texts, if they are at hand."""
    facts = text_facts(texts) if facts is None else facts
    n, heads = F.size(texts), n_of(facts, lambda x: x["head"])
    stray = n_of(facts, lambda x: x["stray"])
    other = F.get(F.filter(facts, lambda x: ~x["head"]), F.lit(0))["t"]
    test = lambda head, t: F.when(head | t.rlike("^[№NПп]") | (t.rlike(r"^\p{Lu}") & (F.length(t) <= 48)), 1.0).when((F.length(t) <= 28) & ~t.rlike("[.»]$"), 0.5).otherwise(0.0)
    many = F.aggregate(F.transform(facts, lambda x: test(x["head"], x["t"])), F.lit(0.0), lambda a, x: a + x) >= F.greatest(F.lit(3.0), n * 0.55)
    titled = (heads >= 2) | ((heads >= 1) & (n >= 3)) | F.coalesce((heads == 1) & (n == 2) & says(other, C.HEADER_COMPANION), F.lit(False)) | ((n >= 4) & many)
    return (n >= 2) & ~F.exists(facts, lambda x: x["value"]) & ~((stray > 0) & (stray >= F.greatest(F.lit(1), n - 1))) & titled


def ends_sentence(text: Column) -> Column:
    s = F.rtrim(text)
    bracket = s.endswith(")") & ~(s.rlike(r"\([^)]{0,48}\)$") & (F.length(s) <= 90))
    return s.rlike("[.;»]$") | bracket


def prose_row(texts: Column, joined: Column, tabular: Column, facts: Column | None = None, header: Column | None = None) -> Column:
    """A paragraph that was cut into the cells of a row; facts and header: those of the texts, if they are at hand."""
    facts = text_facts(texts) if facts is None else facts
    header = header_row(texts, facts) if header is None else header
    n, size = F.size(texts), F.length(joined)
    words = n_of(facts, lambda x: x["letter"] & ~x["value"])
    values = n_of(facts, lambda x: x["value"])
    ends = ends_sentence(joined)
    early = (size >= 35) & (words >= 2) & ((joined.rlike(r"тыс\.\s*руб|руб\.;|\)\s*,") & (values <= 4)) | (ends & (values <= 3)))
    late = ~tabular & (size >= 40) & (((words >= 2) & (values <= 3) & (ends | joined.contains("тыс.") | (size >= 90))) | ((words >= 3) & (values <= 2) & (ends | (size >= 36 * words))))
    return (n >= 2) & ~header & ~company_row(texts, joined, facts) & ~says(joined, C.HEADER_PARTS) & (early | late)


def numbered_row(texts: Column, least: int = 6) -> Column:
    """A row that numbers the columns from 1."""
    n = F.size(texts)
    wanted = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i.cast("string"))
    return (n >= least) & (texts == wanted)


def headerish(texts: Column, joined: Column, colspan: Column) -> Column:
    return (F.size(texts) > 0) & ((colspan >= 3) | says(joined, C.FORM_HEADS))


def dataish(texts: Column, joined: Column, colspan: Column) -> Column:
    n = F.size(texts)
    numbers = n_of(texts, lambda t: t.rlike(r"\d"))
    return numbered_row(texts) | ((n >= 4) & (colspan <= 2)) | ((n > 0) & says(joined, C.DATA_WORDS)) | ((n >= 3) & (numbers >= 2) & (colspan <= 2))


def product_row(texts: Column, joined: Column, colspan: Column) -> Column:
    """An item with a name and two numbers at least."""
    named = F.exists(texts, lambda t: (F.length(t) >= 10) & t.rlike("[А-Яа-яA-Za-z]"))
    return (colspan <= 2) & (F.size(texts) >= 4) & ~says(joined, C.SIGNATURES) & ~says(joined, C.PARTIES) & (n_of(texts, lambda t: t.rlike(r"\d")) >= 2) & named


# ---- tables ----
def row_shapes(rows: DataFrame, tabular: Column | None = None) -> DataFrame:
    """rows with every row test as a column; tabular: whether a row looks like data, false if not given."""
    tabular = F.lit(False) if tabular is None else tabular
    t, j, c = F.col("texts"), F.col("joined"), F.col("max_colspan")
    found = rows.withColumn("_facts", text_facts(t)).withColumn("header", header_row(t, F.col("_facts")))
    return found.withColumns({
        "section_title": section_title_row(t, j, tabular, F.col("_facts")), "intro": intro_row(t), "line_code": line_code_row(t), "company": company_row(t, j, F.col("_facts")), "prose": prose_row(t, j, tabular, F.col("_facts"), F.col("header")),
        "numbered": numbered_row(t), "headerish": headerish(t, j, c), "dataish": dataish(t, j, c), "product": product_row(t, j, c), "filled": F.size(t),
    }).drop("_facts")


def table_shapes(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Each table's measures, and whether it holds line items, is a form's chrome, stays a table, reads as prose or is dropped."""
    t, j, c = F.col("texts"), F.col("joined"), F.col("max_colspan")
    r = rows_of(cells, keys).withColumns({"_product": product_row(t, j, c), "_signed": says(j, C.SIGNATURES)})
    n = lambda x: F.sum(x.cast("int"))
    dense = F.col("_product") | ((F.size(t) >= 4) & (c <= 2) & ~F.col("_signed"))
    ordered = F.array_join(T.in_order(F.collect_list(F.when(F.size(t) > 0, F.struct("row", "joined"))), "joined"), "\n")
    every = r.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.max("width").alias("n_cols"), F.sum(F.size(t)).alias("filled"), n(F.col("_product")).alias("products"), n(dense).alias("dense"), n(c >= 3).alias("merged_rows"),
        F.bool_or((F.col("row") < 8) & numbered_row(t)).alias("by_index"), F.bool_or((F.col("row") < 6) & says(j, C.COLUMN_HEADERS)).alias("by_header"), ordered.alias("_all"),
        F.bool_and(F.forall(t, lambda x: says(x, C.PAGE_ONLY))).alias("page_only"), F.max(F.size(t)).alias("widest"),
    )
    chosen = (F.col("by_header") & (F.col("products") >= 1) & (F.col("dense") >= 2)) | ((F.col("products") >= 2) & (F.col("dense") >= 3) & (F.col("n_rows") >= 5))
    items = (F.col("n_rows") >= 2) & (F.col("n_cols") >= 3) & (F.col("by_index") | (~says(F.col("_all"), C.FOOTERS) & chosen))
    every = every.withColumn("line_items", items)
    merged = (F.col("n_rows") >= 2) & (F.col("merged_rows") >= F.greatest(F.lit(2), F.floor(F.col("n_rows") * 0.35)))
    chrome = ~F.col("line_items") & (says(F.col("_all"), C.CHROME) | (F.col("n_cols") <= 2) | merged | says(F.col("_all"), C.CHROME_PARTIES))
    kind = F.when((F.col("filled") == 0) | F.col("page_only"), "drop").when(F.col("line_items"), "table").otherwise("prose")
    return every.withColumns({"chrome": chrome, "kind": kind}).drop("_all", "page_only", "widest")
