"""Queries of the engine's own operators, with DuckDB SQL of the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import geometry as GEO
from ..functions import text as T
from ..operators import classify as K
from ..operators import folds as D
from ..operators import forms as FO
from ..operators import grid as G
from ..operators import joins as J
from ..operators import ordered as N
from ..operators import render as R
from . import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
KEY = ["table_key"]


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# SQL for the scalar rules
STRIP = r"regexp_replace(coalesce({0}, ''), '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"
NUMERIC = "(NOT " + STRIP + " IN ('-', '—', 'Х', 'X', 'x', 'х') AND regexp_full_match(replace(translate(" + STRIP + ", '    ()', ''), ',', '.'), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?'))"
VALUE = (
    "(NOT " + STRIP + " IN ('-', '—', 'Х', 'X', 'x', 'х') AND NOT regexp_matches({0}, '[A-Za-zА-Яа-яЁё«»]') AND length(regexp_replace({0}, '[^0-9]', '', 'g')) >= 3"
    " AND NOT (length(regexp_replace({0}, '[^0-9]', '', 'g')) = 4 AND TRY_CAST(regexp_replace({0}, '[^0-9]', '', 'g') AS BIGINT) BETWEEN 1900 AND 2100)"
    " AND (regexp_matches({0}, '\\d{{1,3}}([\\s\\x{{a0}}]\\d{{3}})+') OR regexp_full_match(replace(regexp_replace({0}, '[\\s\\x{{a0}}(),-]', '', 'g'), ',', '.'), '[+-]?(\\d+\\.?\\d*|\\.\\d+)') OR length(regexp_replace({0}, '[^0-9]', '', 'g')) >= 4))"
)


def numeric(c: str) -> str:
    return NUMERIC.format(c)


def value(c: str) -> str:
    return VALUE.format(c)


SEE = "(NOT covered AND regexp_replace(text, '\\s', '', 'g') <> '')"
LETTER = "regexp_matches(text, '[A-Za-zА-Яа-яЁё]')"


# ---- text functions ----
@query(f"WITH {A.CELLS_SQL} SELECT table_key, row, col, {numeric('text')} AS numeric, {value('text')} AS data_value, {LETTER} AS letters, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS stripped FROM cells")
def numeric_text(spark, sf_dir):
    t = F.col("text")
    return A.cells(spark, sf_dir).select("table_key", "row", "col", T.looks_numeric(t).alias("numeric"), T.data_value(t).alias("data_value"), T.has_letter(t).alias("letters"), T.strip(t).alias("stripped"))


MICRO = "(VALUES (0, '# 234,56', TRUE, TRUE), (1, '(# 500)', TRUE, TRUE), (2, '123', TRUE, TRUE), (3, '12', TRUE, FALSE), (4, '2024', TRUE, FALSE), (5, '12.03.2024', FALSE, TRUE), (6, 'ООО #', FALSE, FALSE), (7, '-', FALSE, FALSE), (8, 'Х', FALSE, FALSE), (9, '', FALSE, FALSE), (10, '12%', FALSE, FALSE)) AS t(i, text, want_numeric, want_value)"
_CASES = f"SELECT o_orderkey, replace(text, '#', CAST(o_orderkey AS VARCHAR(12))) AS text, want_numeric, want_value FROM orders JOIN {MICRO} ON o_orderkey % 11 = i"


@query(f"SELECT o_orderkey, text, want_numeric AS numeric, want_value AS data_value FROM ({_CASES}) AS c")
def numeric_text_cases(spark, sf_dir):
    """The rules on texts made for each order: the SQL side holds the answer that each kind must get."""
    t = F.col("text")
    return A.relation(spark, sf_dir, _CASES).select("o_orderkey", "text", T.looks_numeric(t).alias("numeric"), T.data_value(t).alias("data_value"))


@query("SELECT o_orderkey, replace(format('{:,}', CAST(floor(o_totalprice) AS BIGINT)), ',', ' ') AS grouped FROM orders")
def format_thousands(spark, sf_dir):
    return A.table(spark, sf_dir, "orders").select("o_orderkey", T.format_thousands(F.floor("o_totalprice").cast("string")).alias("grouped"))


_PLAIN = "replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


@query(f"SELECT page_id, trim(regexp_replace({_PLAIN}, '[\\s\\x{{a0}}\\x{{85}}\\x{{2028}}\\x{{2029}}]+', ' ', 'g')) AS plain FROM pages")
def html_plain_text(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select("page_id", T.plain_text(F.col("html")).alias("plain"))


_LINES = "replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?i)<br\\s*/?>|</(p|tr|div|li|h[1-6])>', chr(10), 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


@query(f"SELECT page_id, list_filter(list_transform(string_split({_LINES}, chr(10)), lambda x: trim(regexp_replace(x, '[\\s\\x{{a0}}]+', ' ', 'g'))), lambda x: x <> '') AS lines FROM pages")
def html_lines(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select("page_id", T.html_lines(F.col("html")).alias("lines"))


@query(f"""WITH {A.POINTS_SQL} SELECT word_id, regexp_replace(fontname, '^[A-Z]{{6}}\\+', '') AS font, regexp_matches(fontname, '(?i)bold|black|heavy|semibold|demi') AS bold, regexp_matches(fontname, '(?i)italic|oblique') AS italic,
  round_even((size + word_id % 10 / 10.0) * 2, 0) / 2 AS points FROM words""")
def font_keys(spark, sf_dir):
    f = F.col("fontname")
    return A.points(spark, sf_dir).select("word_id", T.font_name(f).alias("font"), T.is_bold(f).alias("bold"), T.is_italic(f).alias("italic"), T.half_points(F.col("size") + F.col("word_id") % 10 / 10.0).alias("points"))


@query(f"""WITH {A.CELLS_SQL}, p AS (SELECT table_key, row, list(regexp_replace(text, '^\\s+|\\s+$', '', 'g') ORDER BY col) AS parts FROM cells GROUP BY table_key, row)
SELECT table_key, row, regexp_replace(array_to_string(list_filter(parts, lambda x: x <> ''), ' '), '- ', '-', 'g') AS label FROM p""")
def joined_labels(spark, sf_dir):
    parts = F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda x: x["text"])
    return A.cells(spark, sf_dir).groupBy("table_key", "row").agg(T.join_labels(parts).alias("label"))


# ---- ordered operators ----
_LINES_CTE = f"""WITH {A.POINTS_SQL}, a AS (SELECT *, lag(top) OVER (PARTITION BY page ORDER BY top, x0, word_id) AS p FROM words),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR abs(top - p) > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY top, x0, word_id ROWS UNBOUNDED PRECEDING) - 1 AS line FROM a)"""


@query(f"{_LINES_CTE} SELECT page, word_id, CAST(line AS BIGINT) AS line FROM g")
def word_lines(spark, sf_dir):
    return N.word_lines(A.points(spark, sf_dir), ["page"]).select("page", "word_id", "line")


@query(f"""WITH {A.WORDS_SQL}, c AS (SELECT *, (x0 + x1) / 2 - lag((x0 + x1) / 2) OVER (PARTITION BY doc_id, line_no ORDER BY (x0 + x1) / 2, word_id) > 18 AS jump FROM words),
s AS (SELECT doc_id, line_no, count(*) AS words, 1 + CAST(coalesce(sum(CASE WHEN jump THEN 1 ELSE 0 END), 0) AS BIGINT) AS clusters, avg(CASE WHEN regexp_matches(text, '\\d') THEN 1.0 ELSE 0.0 END) AS digit_share, string_agg(text, ' ' ORDER BY word_id) AS line FROM c GROUP BY doc_id, line_no)
SELECT doc_id, line_no, words, clusters, digit_share, regexp_matches(line, '^[\\p{{Lu}}«"'']') AS capital, length(line) >= 55 OR length(line) - length(replace(line, ',', '')) >= 2 AS prose FROM s""")
def line_stats(spark, sf_dir):
    keys = ["doc_id", "line_no"]
    text = A.words(spark, sf_dir).groupBy(*keys).agg(F.count("*").alias("words"), N.centres_of().alias("_centres"), F.avg(F.when(F.col("text").rlike(r"\d"), 1.0).otherwise(0.0)).alias("digit_share"), N.line_text().alias("line")).withColumn("clusters", N.clusters_of(F.col("_centres")))
    prose = (F.length("line") >= 55) | (F.length("line") - F.length(F.translate("line", ",", "")) >= 2)
    return text.select(*keys, "words", "clusters", "digit_share", T.starts_capital(F.col("line")).alias("capital"), prose.alias("prose"))


_DIGITS = f"""WITH {A.POINTS_SQL}, d AS (SELECT page, word_id, CAST(word_id % 10 AS VARCHAR) AS text, x0, x1, top, bottom, size FROM words),
e AS (SELECT page, word_id, CASE WHEN word_id % 7 = 0 THEN 'x' ELSE text END AS text, CAST(word_id % 50 AS DOUBLE) * 8 AS x0, CAST(word_id % 50 AS DOUBLE) * 8 + 5 AS x1, CAST(floor(word_id / 50) % 20 AS DOUBLE) * 12 AS top, size FROM d)"""
_DIGIT_ROWS = "SELECT page, word_id, CASE WHEN word_id % 7 = 0 THEN 'x' ELSE CAST(word_id % 10 AS STRING) END AS text, CAST(word_id % 50 AS DOUBLE) * 8 AS x0, CAST(word_id % 50 AS DOUBLE) * 8 + 5 AS x1, CAST(floor(word_id / 50) % 20 AS DOUBLE) * 12 AS top, CAST(floor(word_id / 50) % 20 AS DOUBLE) * 12 + 10 AS bottom, size FROM {v}"


@query(f"""{_DIGITS}, o AS (SELECT *, lag(text) OVER w AS pt, lag(x1) OVER w AS px, lag(size) OVER w AS ps, lag(top) OVER w AS pp FROM e WINDOW w AS (PARTITION BY page ORDER BY round_even(top, 0), x0, word_id)),
r AS (SELECT *, sum(CASE WHEN regexp_full_match(text, '\\d') AND regexp_full_match(pt, '\\d') AND abs(top - pp) <= 3 AND x0 - px <= 1.8 * ps THEN 0 ELSE 1 END) OVER (PARTITION BY page ORDER BY round_even(top, 0), x0, word_id ROWS UNBOUNDED PRECEDING) AS run FROM o),
n AS (SELECT *, count(*) OVER (PARTITION BY page, run) AS c FROM r)
SELECT page, min(word_id) AS word_id, string_agg(text, '' ORDER BY x0, word_id) AS text, min(x0) AS x0, max(x1) AS x1 FROM n GROUP BY page, run, CASE WHEN c >= 4 AND regexp_full_match(text, '\\d') THEN -1 ELSE word_id END""")
def split_digit_merge(spark, sf_dir):
    return N.merge_split_digits(A.relation(spark, sf_dir, _DIGIT_ROWS, v=A.points(spark, sf_dir)), ["page"]).select("page", "word_id", "text", "x0", "x1")


@query(f"""WITH {A.POINTS_SQL}, a AS (SELECT *, max(bottom) OVER (PARTITION BY page ORDER BY top, word_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM words)
SELECT page, word_id, CAST(sum(CASE WHEN low IS NULL OR top - low > 14 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY top, word_id ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS block FROM a""")
def running_blocks(spark, sf_dir):
    return N.running_blocks(A.points(spark, sf_dir).withColumn("seq", F.col("word_id")), ["page"]).select("page", "word_id", "block")


@query(f"""WITH {A.POINTS_SQL}, h AS (SELECT page, list_reduce(list(CAST(top AS DOUBLE) ORDER BY top), lambda a, x: CASE WHEN len(a) = 0 OR x - a[len(a)] > 6 THEN list_append(a, x) ELSE a END, CAST([] AS DOUBLE[])) AS heads FROM words GROUP BY page)
SELECT page, word_id, CAST(len(list_filter(heads, lambda y: y <= CAST(top AS DOUBLE))) - 1 AS INTEGER) AS "group" FROM words JOIN h USING (page)""")
def anchored_bands(spark, sf_dir):
    """Bands anchored to their first word: an ordered fold."""
    return N.anchored_groups(A.points(spark, sf_dir), ["page"], ["top", "x0", "word_id"], "top", 6.0).select("page", "word_id", "group")


@query(f"""WITH {A.WORDS_SQL}, ln AS (SELECT doc_id, line_no, string_agg(text, ' ' ORDER BY word_id) AS text, min(top) AS top FROM words GROUP BY doc_id, line_no),
a AS (SELECT *, lag(text) OVER w AS pt, lag(top + 10) OVER w AS pb FROM ln WINDOW w AS (PARTITION BY doc_id ORDER BY top, line_no))
SELECT doc_id, line_no, CAST(sum(CASE WHEN pb IS NULL OR top - pb > 14 OR (regexp_matches(pt, '[.:;?!]$') AND regexp_matches(text, '^[\\p{{Lu}}«"'']')) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY top, line_no ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS paragraph FROM a""")
def paragraphs(spark, sf_dir):
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_id", "text"))), lambda x: x["text"]), " ")
    lines = A.words(spark, sf_dir).groupBy("doc_id", "line_no").agg(text.alias("text"), F.min("top").alias("top"), F.max("bottom").alias("bottom"), F.max("size").alias("size")).withColumn("line", F.col("line_no"))
    return N.paragraphs(lines, ["doc_id"]).select("doc_id", "line_no", "paragraph")


_SIGNALS = f"""WITH {A.CELLS_SQL}, c AS (SELECT *, {SEE} AS see, {numeric('text')} AS num, {value('text')} AS val, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM cells),
s AS (SELECT table_key, row, count(*) AS width, CAST(sum(CASE WHEN see THEN 1 ELSE 0 END) AS BIGINT) AS filled, CAST(sum(CASE WHEN see AND num THEN 1 ELSE 0 END) AS BIGINT) AS numbers,
  CAST(sum(CASE WHEN see AND NOT num THEN 1 ELSE 0 END) AS BIGINT) AS texts, CAST(sum(CASE WHEN see AND NOT num AND length(t) > 50 AND regexp_matches(t, '[.;»]$') THEN 1 ELSE 0 END) AS BIGINT) AS sentences,
  coalesce(bool_or(see AND regexp_full_match(t, '\\d{{4}}')), FALSE) AND coalesce(bool_or(see AND (val OR t IN ('Х', 'X', 'х', 'x', '-', '—'))), FALSE)
    OR coalesce(bool_or(see AND t IN ('Х', 'X', 'х', 'x')), FALSE) AND coalesce(bool_or(see AND val), FALSE)
    OR coalesce(bool_or(see AND col = 0 AND {LETTER}), FALSE) AND coalesce(bool_or(see AND col > 0 AND (num OR val)), FALSE)
    OR coalesce(max(CASE WHEN see AND (num OR val) THEN col END) > min(CASE WHEN see AND regexp_matches(text, '[A-Za-zА-Яа-яЁё]{{2,}}') THEN col END), FALSE)
    OR coalesce(bool_or(see AND regexp_matches(text, '\\d') AND regexp_matches(text, '[A-Za-zА-Яа-я-]')), FALSE) AS data,
  coalesce(bool_or(see AND col = 0 AND {LETTER}), FALSE) AS lab, coalesce(bool_or(see AND col > 0 AND (num OR val)), FALSE) AS num_right,
  sum(CASE WHEN see THEN length(t) ELSE 0 END) AS chars, max(CASE WHEN col = 0 THEN length(t) END) AS head_chars, coalesce(bool_or(see AND contains(text, '•')), FALSE) AS bullet
  FROM c GROUP BY table_key, row),
sig AS (SELECT *, CASE WHEN filled > 0 THEN numbers / filled ELSE 0.0 END AS numeric_ratio, filled >= 2 AND data AS tabular FROM s)"""


@query(f"{_SIGNALS} SELECT table_key, row, filled, numbers, texts, sentences, numeric_ratio, tabular FROM sig")
def row_signals(spark, sf_dir):
    return G.row_signals(A.cells(spark, sf_dir), KEY).select("table_key", "row", "filled", "numbers", "texts", "sentences", "numeric_ratio", "tabular")


#: The same over the tables of forms, where both outcomes occur.
_FORM_SIGNALS = _SIGNALS.replace(A.CELLS_SQL, f"{A.FORM_BASE}, cells AS ({A.FORM_CELLS})")


@query(f"""{_FORM_SIGNALS}, f AS (SELECT *, min(CASE WHEN tabular OR (filled >= 4 AND numeric_ratio < 0.15 AND texts >= 4 AND sentences >= 2) OR NOT (numeric_ratio < 0.3 AND filled >= 1) THEN row END) OVER (PARTITION BY table_key) AS first FROM sig)
SELECT table_key, row, CASE WHEN row < coalesce(first, 2147483647) AND row < 6 THEN 'HEADER' ELSE 'DATA' END AS kind FROM f""")
def header_rows(spark, sf_dir):
    return N.header_rows(G.row_signals(A.form_cells(spark, sf_dir).repartition(*KEY), KEY), KEY).select("table_key", "row", "kind")


@query(f"""{_FORM_SIGNALS}, t AS (SELECT table_key, count(*) AS n_rows, max(width) AS n_cols, CAST(sum(filled) AS BIGINT) AS filled, CAST(sum(numbers) AS BIGINT) AS numbers, count(*) FILTER (filled = 1) AS blobs, count(*) FILTER (lab AND num_right) AS tab, count(*) FILTER (bullet) AS bullets,
  count(*) FILTER (filled >= 2 AND NOT num_right) AS text_rows, count(*) FILTER (filled = 1 AND coalesce(head_chars, 0) >= 55) AS long_rows, sum(chars) AS chars FROM sig GROUP BY table_key),
r AS (SELECT *, blobs / n_rows AS blob, numbers / filled AS num FROM t)
SELECT table_key, n_rows, n_cols, filled, CASE WHEN filled = 0 THEN FALSE WHEN tab >= 4 THEN FALSE WHEN bullets >= 2 AND num < 0.22 THEN TRUE WHEN tab < 2 AND text_rows >= greatest(4, floor(n_rows / 3)) AND num < 0.22 THEN TRUE
  WHEN n_cols >= 4 AND tab < 3 AND num < 0.18 AND n_rows >= 8 AND filled / n_rows >= 2.2 THEN TRUE WHEN tab < 2 AND blob >= 0.48 AND num < 0.3 AND n_rows >= 6 THEN TRUE WHEN n_cols <= 3 AND blob >= 0.55 AND num < 0.28 THEN TRUE
  WHEN blob >= 0.8 AND num < 0.12 AND n_rows >= 3 THEN TRUE WHEN blob >= 0.7 AND num < 0.18 AND n_rows >= 4 THEN TRUE WHEN long_rows >= 4 AND num < 0.24 THEN TRUE
  WHEN n_cols >= 4 AND blob >= 0.48 AND num < 0.22 AND n_rows >= 8 AND chars / filled >= 32 THEN TRUE ELSE FALSE END AS prose FROM r""")
def prose_tables(spark, sf_dir):
    return G.prose_tables(A.form_cells(spark, sf_dir), KEY).select("table_key", "n_rows", "n_cols", "filled", "prose")


@query(f"""{_SIGNALS}, p AS (SELECT *, filled <= 3 AS is_prose FROM sig), a AS (SELECT *, CASE WHEN is_prose IS DISTINCT FROM lag(is_prose) OVER (PARTITION BY table_key ORDER BY row) THEN 1 ELSE 0 END AS s FROM p),
g AS (SELECT *, sum(s) OVER (PARTITION BY table_key ORDER BY row ROWS UNBOUNDED PRECEDING) - 1 AS block FROM a)
SELECT table_key, CAST(block AS BIGINT) AS block, bool_and(is_prose) AS is_prose, min(row) AS first_row, max(row) AS last_row, CAST(sum(filled) AS BIGINT) AS filled FROM g GROUP BY table_key, block HAVING bool_and(is_prose) OR sum(filled) >= 2""")
def mixed_split(spark, sf_dir):
    rows = G.row_signals(A.cells(spark, sf_dir), KEY).withColumn("is_prose", F.col("filled") <= 3)
    return N.alternate_blocks(rows, KEY).select("table_key", "block", "is_prose", "first_row", "last_row", "filled")


@query(f"""{_SIGNALS}, m AS (SELECT *, max(filled) OVER (PARTITION BY table_key ORDER BY row ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS wide FROM sig)
SELECT table_key, min(CASE WHEN row >= 3 AND wide >= 5 AND filled <= 4 AND lab THEN row END) AS split_row FROM m GROUP BY table_key""")
def movement_split(spark, sf_dir):
    rows = G.row_signals(A.cells(spark, sf_dir), KEY)
    first = A.cells(spark, sf_dir).groupBy("table_key", "row").agg(F.bool_or(G.visible() & (F.col("col") == 0) & T.has_letter(F.col("text"))).alias("header_word"))
    return N.movement_split(rows.join(first, ["table_key", "row"]), KEY, 5, 4)


@query(f"WITH {A.PAGES_SQL} SELECT doc, page, coalesce(last_value(own_type IGNORE NULLS) OVER (PARTITION BY doc ORDER BY page ROWS UNBOUNDED PRECEDING), 'unknown') AS carried FROM pg")
def doc_type_locf(spark, sf_dir):
    return N.carry_forward(A.form_pages(spark, sf_dir), ["doc"], ["page"], "own_type", "unknown").select("doc", "page", "carried")


@query(f"WITH {A.PAGES_SQL}, a AS (SELECT *, id % 3 <> 0 AS ok FROM pg) SELECT doc, page, CASE WHEN ok THEN first_value(coalesce(own_type, 'unknown')) OVER (PARTITION BY doc, ok ORDER BY page) END AS reused FROM a")
def sheet_type_first(spark, sf_dir):
    pages = A.form_pages(spark, sf_dir).withColumn("kind", F.coalesce("own_type", F.lit("unknown")))
    return N.reuse_first(pages, ["doc"], ["page"], "kind", F.col("id") % 3 != 0).select("doc", "page", "reused")


@query(f"""WITH {A.CELLS_SQL}, b2 AS (SELECT table_key, row, sum(CASE WHEN {SEE} AND {numeric('text')} THEN 1 ELSE 0 END) >= 1 AND NOT bool_or({SEE} AND {LETTER}) AS bare FROM cells GROUP BY table_key, row),
l AS (SELECT *, max(CASE WHEN bare THEN row END) OVER (PARTITION BY table_key) AS last FROM b2),
g AS (SELECT *, sum(CASE WHEN bare THEN 0 ELSE 1 END) OVER (PARTITION BY table_key ORDER BY row DESC ROWS UNBOUNDED PRECEDING) AS gone FROM l WHERE row <= last)
SELECT table_key, row, CAST(row_number() OVER (PARTITION BY table_key ORDER BY row DESC) - 1 AS INTEGER) AS place FROM g WHERE gone = 0""")
def totals_tail(spark, sf_dir):
    return N.tail_run(G.bare_totals(A.cells(spark, sf_dir), KEY), KEY, F.col("bare")).select("table_key", "row", "place")


@query(f"""WITH {A.POINTS_SQL}, i AS (SELECT page, top AS lo, bottom AS hi FROM words), r AS (SELECT *, max(hi) OVER (PARTITION BY page ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM i),
g AS (SELECT *, sum(CASE WHEN m IS NULL OR lo - m > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM r)
SELECT page, min(lo) AS lo, max(hi) AS hi, count(*) AS parts FROM g GROUP BY page, run""")
def interval_merge(spark, sf_dir):
    return N.merge_intervals(A.points(spark, sf_dir).select("page", F.col("top").alias("lo"), F.col("bottom").alias("hi")), ["page"], 3.0)


@query(f"""WITH {A.POINTS_SQL}, r AS (SELECT page, x0, lag(x0) OVER (PARTITION BY page ORDER BY x0) AS p FROM words), g AS (SELECT *, sum(CASE WHEN p IS NULL OR x0 - p > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY x0 RANGE UNBOUNDED PRECEDING) - 1 AS cluster FROM r)
SELECT page, CAST(cluster AS BIGINT) AS cluster, avg(x0) AS centre, min(x0) AS lo, max(x0) AS hi, count(*) AS n FROM g GROUP BY page, cluster""")
def coordinate_clusters(spark, sf_dir):
    return N.cluster_values(A.points(spark, sf_dir), ["page"], "x0", 2.0)


@query(f"""WITH {A.POINTS_SQL}, r AS (SELECT *, lag(x0) OVER (PARTITION BY page ORDER BY x0, word_id) AS p FROM words), g AS (SELECT *, sum(CASE WHEN p IS NULL OR x0 - p > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY x0, word_id ROWS UNBOUNDED PRECEDING) AS run FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY page, run ORDER BY size DESC, x0, word_id) AS i FROM g) SELECT page, word_id, x0, size FROM b WHERE i = 1""")
def parallel_dedupe(spark, sf_dir):
    return N.dedupe_parallel(A.points(spark, sf_dir).withColumn("seq", F.col("word_id")), ["page"], "x0", F.col("size"), 3.0).select("page", "word_id", "x0", "size")


# ---- joins ----
_HOLDS = "w.page = t.page AND (w.x0 + w.x1) / 2 BETWEEN bx0 - {0} AND bx1 + {0} AND (w.top + w.bottom) / 2 BETWEEN btop - {0} AND bbottom + {0}"


@query(f"WITH {A.POINTS_SQL}, {A.BOXES_SQL} SELECT t.page, table_id, word_id FROM boxes t LEFT JOIN words w ON {_HOLDS.format(0)}")
def word_in_box(spark, sf_dir):
    return J.words_in_slots(A.points(spark, sf_dir), A.boxes(spark, sf_dir), ["page"]).select("page", "table_id", "word_id")


@query(f"WITH {A.POINTS_SQL}, {A.BOXES_SQL} SELECT word_id FROM words w WHERE EXISTS (SELECT 1 FROM boxes t WHERE {_HOLDS.format(1)})")
def table_words(spark, sf_dir):
    return J.words_of_tables(A.points(spark, sf_dir), A.boxes(spark, sf_dir), ["page"], 1.0).select("word_id")


@query(f"""WITH {A.POINTS_SQL}, {A.BOXES_SQL}, u AS (SELECT DISTINCT page, round_even(x0, 1) AS a, round_even(top, 1) AS b, round_even(x1, 1) AS c, text AS d FROM words w WHERE EXISTS (SELECT 1 FROM boxes t WHERE {_HOLDS.format(2)}))
SELECT word_id FROM words w WHERE trim(text) <> '' AND NOT EXISTS (SELECT 1 FROM u WHERE u.page = w.page AND a = round_even(w.x0, 1) AND b = round_even(w.top, 1) AND c = round_even(w.x1, 1) AND d = w.text)""")
def free_words(spark, sf_dir):
    words, boxes = A.points(spark, sf_dir), A.boxes(spark, sf_dir)
    inside = J.words_of_tables(words, boxes, ["page"], 0.0)
    return J.free_words(words, J.used_words(words, inside, boxes, ["page"]), ["page"]).select("word_id")


@query(f"""WITH {A.BOXES_SQL}, o AS (SELECT i.page, i.table_id, greatest(0, least(i.bx1, o.bx1) - greatest(i.bx0, o.bx0)) * greatest(0, least(i.bbottom, o.bbottom) - greatest(i.btop, o.btop)) AS x, (i.bx1 - i.bx0) * (i.bbottom - i.btop) AS ai, (o.bx1 - o.bx0) * (o.bbottom - o.btop) AS ao, o.table_id AS oid
  FROM boxes i JOIN boxes o ON i.page = o.page AND i.table_id <> o.table_id)
SELECT page, table_id FROM boxes b WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.page = b.page AND o.table_id = b.table_id AND x >= 0.85 * ai AND ai > 0 AND (NOT x >= 0.85 * ao OR oid < o.table_id))""")
def nested_tables(spark, sf_dir):
    return J.drop_nested(A.boxes(spark, sf_dir), ["page"]).select("page", "table_id")


@query(f"""WITH {A.BOXES_SQL}, x AS (SELECT a.page, a.table_id AS box_id, max((a.bx1 - a.bx0) * (a.bbottom - a.btop)) AS area, sum(greatest(0, least(a.bx1, b.bx1) - greatest(a.bx0, b.bx0)) * greatest(0, least(a.bbottom, b.bbottom) - greatest(a.btop, b.btop))) AS s
  FROM boxes a JOIN boxes b ON a.page = b.page AND b.table_id < 2 GROUP BY a.page, a.table_id) SELECT page, box_id, CAST(greatest(0, 1 - s / area) AS DOUBLE) AS uncovered FROM x""")
def uncovered_share(spark, sf_dir):
    boxes = A.boxes(spark, sf_dir)
    return J.uncovered_share(boxes.withColumnRenamed("table_id", "box_id"), boxes.where("table_id < 2"), ["page"])


_MERGES = "SELECT DISTINCT table_key, 0 AS r0, CAST(table_key % 3 AS INT) AS c0, CAST(table_key % 2 AS INT) AS r1, CAST(table_key % 3 + 2 AS INT) AS c1 FROM cells"


@query(f"""WITH {A.CELLS_SQL}, m AS ({_MERGES}) SELECT c.table_key, row, col, CASE WHEN row = r0 AND col = c0 THEN r1 - r0 + 1 ELSE 1 END AS rowspan, CASE WHEN row = r0 AND col = c0 THEN c1 - c0 + 1 ELSE 1 END AS colspan,
  r0 IS NOT NULL AND NOT (row = r0 AND col = c0) AS covered FROM cells c LEFT JOIN m ON c.table_key = m.table_key AND row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1""")
def merge_expand(spark, sf_dir):
    cells = A.cells(spark, sf_dir)
    merges = A.relation(spark, sf_dir, _MERGES.replace("FROM cells", "FROM {cells}"), cells=cells)
    return J.expand_merges(cells.select("table_key", "row", "col"), merges, KEY)


# ---- aggregates and rewrites ----
@query(f"WITH {A.CELLS_SQL} SELECT table_key, col, min_by(x0, (x1 - x0) * 1000000 + row) AS x0, min_by(x1, (x1 - x0) * 1000000 + row) AS x1 FROM cells GROUP BY table_key, col")
def column_bounds(spark, sf_dir):
    return G.column_bounds(A.cells(spark, sf_dir), KEY)


@query(f"WITH {A.CELLS_SQL} SELECT table_key, row, min(CASE WHEN {value('text')} THEN top END) AS top, max(CASE WHEN {value('text')} THEN bottom END) AS bottom FROM cells GROUP BY table_key, row")
def value_bands(spark, sf_dir):
    return G.row_bounds(A.cells(spark, sf_dir), KEY, T.data_value(F.col("text")))


@query(f"WITH {A.POINTS_SQL} SELECT page, min(x0) AS x0, min(top) AS top, max(x1) AS x1, max(bottom) AS bottom FROM words GROUP BY page")
def bbox_union(spark, sf_dir):
    return G.bbox_union(A.points(spark, sf_dir), ["page"])


@query(f"WITH {A.POINTS_SQL}, c AS (SELECT page, fontname, count(*) AS n, min(word_id) AS f FROM words GROUP BY page, fontname), r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY n DESC, f) AS i FROM c) SELECT page, fontname, n FROM r WHERE i = 1")
def dominant_font(spark, sf_dir):
    return G.dominant(A.points(spark, sf_dir), ["page"], "fontname", "word_id")


_STATS = f"""WITH {A.CELLS_SQL}, sp AS (SELECT table_key, any_value(doc_type) AS doc_type, count(*) FILTER (NOT covered AND (colspan > 1 OR rowspan > 1)) AS span_cells, count(*) FILTER (NOT covered AND colspan > 1) AS colspan_cells, count(*) FILTER (NOT covered AND rowspan > 1) AS rowspan_cells,
  CAST(sum(CASE WHEN covered THEN 0 ELSE colspan + rowspan - 2 END) AS BIGINT) AS absorbed, max(CASE WHEN covered THEN 1 ELSE colspan END) AS max_colspan, max(CASE WHEN covered THEN 1 ELSE rowspan END) AS max_rowspan,
  count(DISTINCT row) AS n_rows, 6 AS n_cols, count(*) FILTER (NOT covered) AS n_cells FROM cells GROUP BY table_key)"""


@query(f"{_STATS} SELECT table_key, span_cells, colspan_cells, rowspan_cells, absorbed, max_colspan, max_rowspan FROM sp")
def span_stats(spark, sf_dir):
    return G.span_stats(A.cells(spark, sf_dir), KEY)


@query(f"{_STATS} SELECT table_key, n_rows, CAST(n_cols AS BIGINT) AS n_cols, n_cells FROM sp")
def size_stats(spark, sf_dir):
    return G.size_stats(A.cells(spark, sf_dir), KEY)


@query(f"""WITH {A.CELLS_SQL}, h AS (SELECT table_key, col, count(*) AS n FROM cells WHERE NOT covered AND regexp_full_match(text, '\\d{{4}}') GROUP BY table_key, col), r AS (SELECT *, row_number() OVER (PARTITION BY table_key ORDER BY n DESC, col) AS i FROM h)
SELECT table_key, col AS code_col, greatest(0, col - 1) AS label_col, n AS hits FROM r WHERE i = 1 AND n >= 3""")
def code_column(spark, sf_dir):
    return G.code_column(A.cells(spark, sf_dir), KEY)


@query(f"""WITH {A.CELLS_SQL}, h AS (SELECT table_key, col, count(*) AS n FROM cells WHERE col < 3 AND {SEE} AND {LETTER} GROUP BY table_key, col), r AS (SELECT *, row_number() OVER (PARTITION BY table_key ORDER BY n DESC, col) AS i FROM h)
SELECT table_key, col AS label_col, n AS labels FROM r WHERE i = 1""")
def label_column(spark, sf_dir):
    return G.label_column(A.cells(spark, sf_dir), KEY)


@query(f"WITH {A.CELLS_SQL} SELECT table_key, count(*) FILTER (regexp_full_match(trim(text), '\\d{{4}}')) >= 4 AS financial FROM cells GROUP BY table_key")
def financial_tables(spark, sf_dir):
    return G.financial_statement(A.cells(spark, sf_dir), KEY)


_INDEX = "SELECT table_key, row, col, CASE WHEN row = table_key % 3 THEN CASE WHEN table_key % 10 = 0 AND col = 5 THEN '7' ELSE CAST(col + 1 AS VARCHAR(9)) END ELSE text END AS text, 1 AS rowspan, 1 AS colspan, FALSE AS covered FROM cells"


@query(f"""WITH {A.CELLS_SQL}, x AS ({_INDEX}) SELECT table_key, row, coalesce(count(*) FILTER ({SEE} AND NOT text IN ('А', 'A')) >= 6 AND
  list(trim(text) ORDER BY col) FILTER ({SEE} AND NOT text IN ('А', 'A')) = list_transform(range(1, count(*) FILTER ({SEE} AND NOT text IN ('А', 'A')) + 1), lambda i: CAST(i AS VARCHAR)), FALSE) AS index_header FROM x GROUP BY table_key, row""")
def index_header(spark, sf_dir):
    return G.index_header(A.relation(spark, sf_dir, _INDEX.replace("FROM cells", "FROM {cells}"), cells=A.cells(spark, sf_dir)), KEY)


@query(f"""WITH {A.CELLS_SQL}, p AS (SELECT a.table_key, a.col AS boundary, b.x0 + 5 - (a.x0 + 5 * length(a.text)) AS gap, {numeric('a.text')} AND {numeric('b.text')} AS keep FROM cells a JOIN cells b ON a.table_key = b.table_key AND a.row = b.row AND b.col = a.col + 1)
SELECT table_key, boundary, avg(CASE WHEN gap <= 20 THEN 1.0 ELSE 0.0 END) AS support, bool_or(keep) AS keep, avg(CASE WHEN gap <= 20 THEN 1.0 ELSE 0.0 END) >= 0.35 AND NOT bool_or(keep) AS phantom FROM p GROUP BY table_key, boundary""")
def phantom_boundaries(spark, sf_dir):
    cells = A.cells(spark, sf_dir).withColumns({"text_x0": F.col("x0") + 5, "text_x1": F.col("x0") + 5 * F.length("text")})
    return G.phantom_boundaries(cells, KEY)


@query(f"""WITH {A.CELLS_SQL}, g AS (SELECT table_key, row, col - (CASE WHEN col >= 1 AND table_key % 2 = 0 THEN 1 ELSE 0 END) - (CASE WHEN col >= 5 THEN 1 ELSE 0 END) AS new_col, col, trim(text) AS t FROM cells)
SELECT table_key, row, CAST(new_col AS INTEGER) AS new_col, coalesce(string_agg(CASE WHEN t <> '' THEN t END, ' ' ORDER BY col), '') AS text FROM g GROUP BY table_key, row, new_col""")
def phantom_merge(spark, sf_dir):
    cells = A.cells(spark, sf_dir)
    phantom = cells.select("table_key").distinct().select("table_key", F.explode(F.array(F.struct(F.lit(0).alias("boundary"), (F.col("table_key") % 2 == 0).alias("phantom")), F.struct(F.lit(4).alias("boundary"), F.lit(True).alias("phantom")))).alias("x")).select("table_key", "x.boundary", "x.phantom")
    return G.merge_phantom_columns(cells, phantom, KEY)


@query(f"""WITH {A.CELLS_SQL}, k AS (SELECT table_key, row, dense_rank() OVER (PARTITION BY table_key ORDER BY row) - 1 AS nr FROM (SELECT table_key, row FROM cells WHERE {SEE} AND col IN (0, 4, 5) GROUP BY table_key, row)),
c AS (SELECT table_key, col, dense_rank() OVER (PARTITION BY table_key ORDER BY col) - 1 AS nc FROM (SELECT table_key, col FROM cells WHERE {SEE} AND col IN (0, 4, 5) GROUP BY table_key, col))
SELECT table_key, CAST(nr AS INTEGER) AS row, CAST(nc AS INTEGER) AS col, text FROM cells JOIN k USING (table_key, row) JOIN c USING (table_key, col)""")
def drop_empty(spark, sf_dir):
    return G.drop_empty(A.cells(spark, sf_dir).where("col IN (0, 4, 5)"), KEY).select("table_key", "row", "col", "text")


@query(f"WITH {A.CELLS_SQL} SELECT table_key, row - 1 AS row, col, text, least(rowspan, 3 - row) AS rowspan FROM cells WHERE row BETWEEN 1 AND 2")
def slice_rows(spark, sf_dir):
    return G.slice_rows(A.cells(spark, sf_dir), 1, 2).select("table_key", "row", "col", "text", "rowspan")


_MATRIX = f"""WITH {A.CELLS_SQL}, f AS (SELECT table_key, row, col AS at, trim(text) AS text FROM cells WHERE NOT covered), mx AS (SELECT r.table_key, r.row, c.at AS col, coalesce(f.text, '') AS text
  FROM (SELECT DISTINCT table_key, row FROM cells) r CROSS JOIN (SELECT unnest(range(6)) AS at) c LEFT JOIN f ON f.table_key = r.table_key AND f.row = r.row AND f.at = c.at)"""


@query(f"{_MATRIX} SELECT table_key, row, CAST(col AS INTEGER) AS col, text FROM mx")
def grid_matrix(spark, sf_dir):
    return G.matrix(A.cells(spark, sf_dir), KEY)


@query(f"""{_MATRIX}, l AS (SELECT table_key, row, '| ' || string_agg(replace(replace(text, '|', '\\|'), chr(10), ' '), ' | ' ORDER BY col) || ' |' || CASE WHEN row = 0 THEN chr(10) || '|' || repeat(' --- |', 6) ELSE '' END AS line FROM mx GROUP BY table_key, row)
SELECT table_key, string_agg(line, chr(10) ORDER BY row) AS markdown FROM l GROUP BY table_key""")
def markdown_table(spark, sf_dir):
    return R.markdown_table(G.matrix(A.cells(spark, sf_dir), KEY), KEY)


@query(f"""WITH {A.CELLS_SQL}, l AS (SELECT table_key, row, '<tr>' || string_agg('<' || CASE WHEN row = 0 THEN 'th' ELSE 'td' END || '>' || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</' || CASE WHEN row = 0 THEN 'th' ELSE 'td' END || '>', '' ORDER BY col) || '</tr>' AS tr FROM cells GROUP BY table_key, row)
SELECT table_key, '<table>' || string_agg(tr, '' ORDER BY row) || '</table>' AS html FROM l GROUP BY table_key""")
def plain_table(spark, sf_dir):
    return R.plain_table(A.cells(spark, sf_dir), KEY)


@query()
def render_table(spark, sf_dir):
    """Tables as HTML with heads, spans and alignment; tested on small grids."""
    return R.table_html(A.cells(spark, sf_dir), KEY)


@query(f"WITH {A.CELLS_SQL} SELECT table_key, coalesce(string_agg(CASE WHEN {SEE} THEN trim(text) END, ' ' ORDER BY row, col), '') AS text FROM cells GROUP BY table_key")
def flatten_tables(spark, sf_dir):
    return G.flatten(A.cells(spark, sf_dir), KEY)


# ---- classifiers and reports ----
B0, B1 = "(^|[^0-9A-Za-zА-Яа-яЁё_])", "($|[^0-9A-Za-zА-Яа-яЁё_])"
_DUCK = {r"\b071000[1-5]\b": f"{B0}071000[1-5]{B1}", r"\bКС-?2\b": f"{B0}КС-?2{B1}", r"\bКС-?3\b": f"{B0}КС-?3{B1}", r"\b330212\b": f"{B0}330212{B1}", r"\bУПД\b": f"{B0}УПД{B1}"}


def _duck(pattern: str) -> str:
    flags, p = ("(?i)" if "i" in pattern[: pattern.find(")")] and pattern.startswith("(?") else ""), pattern
    if p.startswith("(?"):
        p = p[p.find(")") + 1 :] if p[2] != ":" else p
    p = p.replace(r"\bТОРГ", f"{B0}ТОРГ").replace(r"\bУПД\b", f"{B0}УПД{B1}").replace(r"2\b", f"2{B1}").replace(r"3\b", f"3{B1}")
    for a, b in _DUCK.items():
        p = p.replace(a, b)
    return (flags + p.replace(r"\b", "")).replace("'", "''")


def _type_sql() -> str:
    def score(kind):
        return " + ".join(f"CASE WHEN regexp_matches(text, '{_duck(p)}') THEN {w} ELSE 0.0 END" for k, w, p in C.TYPE_SIGNALS if k == kind)

    s = ", ".join(f"CAST({score(k)} AS DOUBLE) AS {k}" for k in C.TYPES[:-1])
    path = "CASE " + " ".join(f"WHEN regexp_matches(path, '{_duck(p)}') THEN '{k}'" for k, p in C.PATH_HINTS) + " END"
    d = C.Detection()
    return f"""WITH {A.PAGES_SQL}, s0 AS (SELECT doc, page, text, {s}, {path} AS pt, regexp_matches(text, '{_duck(C.UPD_EVIDENCE)}') AS ue, regexp_matches(text, '{_duck(C.KS3_EVIDENCE)}') AS e3, regexp_matches(text, '{_duck(C.KS2_EVIDENCE)}') AS e2 FROM pg),
s1 AS (SELECT doc, page, pt, rsbu, torg12, CASE WHEN invoice_sf > 0 AND ue THEN upd + {d.upd_bonus} WHEN invoice_sf > 0 AND upd > 0 THEN upd * {d.upd_factor} ELSE upd END AS upd, CASE WHEN invoice_sf > 0 AND ue THEN invoice_sf * {d.invoice_factor} ELSE invoice_sf END AS invoice_sf,
  CASE WHEN ks2 > 0 AND ks3 > 0 AND e3 THEN ks3 + 0.5 WHEN ks2 > 0 AND ks3 > 0 AND e2 THEN ks3 * 0.5 ELSE ks3 END AS ks3, CASE WHEN ks2 > 0 AND ks3 > 0 AND e3 THEN ks2 * 0.5 WHEN ks2 > 0 AND ks3 > 0 AND e2 THEN ks2 + 0.5 ELSE ks2 END AS ks2 FROM s0),
s2 AS (SELECT doc, page, pt, {", ".join(f"{k} + CASE WHEN pt = '{k}' THEN {d.path_bonus} ELSE 0.0 END AS {k}" for k in C.TYPES[:-1])} FROM s1),
s3 AS (SELECT doc, page, pt, rsbu, ks2, ks3, torg12, CASE WHEN pt = 'upd' AND invoice_sf > 0 THEN upd + {d.path_upd_bonus} ELSE upd END AS upd, CASE WHEN pt = 'upd' AND invoice_sf > 0 THEN invoice_sf * {d.path_invoice_factor} ELSE invoice_sf END AS invoice_sf FROM s2),
u AS ({" UNION ALL ".join(f"SELECT doc, page, pt, '{k}' AS k, {i} AS i, {k} AS s FROM s3" for i, k in enumerate(C.TYPES[:-1]))}),
r AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY s DESC, i) AS n FROM u),
t AS (SELECT doc, page, any_value(pt) AS pt, max(CASE WHEN n = 1 THEN CASE WHEN s > 0 THEN k ELSE 'unknown' END END) AS k, max(CASE WHEN n = 1 THEN s END) AS b, max(CASE WHEN n = 2 THEN s END) AS c FROM r GROUP BY doc, page),
z AS (SELECT *, CASE WHEN b - c < {d.close} AND coalesce(pt = k, FALSE) THEN greatest(least(1, b / (b + c + 0.5)), 0.55) ELSE least(1, b / (b + c + 0.5)) END AS sure FROM t)
SELECT doc, page, CASE WHEN b < 0.8 THEN CASE WHEN coalesce(pt = k, FALSE) AND b >= 0.5 THEN k ELSE 'unknown' END WHEN sure < 0.45 THEN CASE WHEN coalesce(pt = k, FALSE) THEN k ELSE 'unknown' END ELSE k END AS doc_type,
  CAST(CASE WHEN b < 0.8 THEN CASE WHEN coalesce(pt = k, FALSE) AND b >= 0.5 THEN 0.55 ELSE 0.0 END WHEN sure < 0.45 THEN CASE WHEN coalesce(pt = k, FALSE) THEN 0.5 ELSE sure END ELSE sure END AS DOUBLE) AS confidence FROM z"""


@query(_type_sql())
def doc_types(spark, sf_dir):
    return K.detect_types(A.form_pages(spark, sf_dir)).select("doc", "page", "doc_type", "confidence")


_MIXED = "CASE WHEN doc_id % 3 = 0 THEN translate(text, 'abehiorst', 'авенюорст') ELSE text END"


@query(f"""WITH d AS (SELECT doc_id, n_chars, {_MIXED} AS text FROM documents), n AS (SELECT doc_id, n_chars, length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS latin, length(regexp_replace(text, '[^\\x{{0400}}-\\x{{04FF}}]', '', 'g')) AS cyrillic FROM d)
SELECT doc_id, letters, latin, cyrillic, n_chars >= 50 AND letters >= 80 AND latin >= 0.55 * letters AND cyrillic <= 0.2 * letters AS latin_page FROM n""")
def letter_shares(spark, sf_dir):
    """Letters of two alphabets; a third of the texts mixes them."""
    docs = A.relation(spark, sf_dir, f"SELECT doc_id, n_chars, {_MIXED} AS text FROM documents")
    n = K.letter_counts(F.col("text"))
    latin = (F.col("n_chars") >= 50) & (n["letters"] >= 80) & (n["latin"] >= 0.55 * n["letters"]) & (n["cyrillic"] <= 0.2 * n["letters"])
    return docs.select("doc_id", *[n[k].alias(k) for k in ("letters", "latin", "cyrillic")], latin.alias("latin_page"))


@query()
def broken_fonts(spark, sf_dir):
    """Pages whose text doesn't mean what it shows; tested on literal cases."""
    docs = A.table(spark, sf_dir, "documents").withColumns({"n_ocr_chars": F.when(F.col("doc_id") % 11 == 0, 25).otherwise(0), "cover": F.lit(0.0)})
    return K.precheck(docs).select("doc_id", "suitable", "reasons")


@query("""SELECT doc_id, n_chars < 200 AND length(trim(text, ' ' || chr(10) || chr(9))) < 200 AND least(1, doc_id % 10 / 10.0) >= 0.35 AS scan FROM documents""")
def image_scans(spark, sf_dir):
    how = C.Suitability(scan_chars=200)
    return A.table(spark, sf_dir, "documents").select("doc_id", K.image_scan(F.col("text"), F.col("n_chars"), K.image_cover(F.col("doc_id") % 10, F.lit(10.0)), how).alias("scan"))


@query(f"""{_STATS}, p AS (SELECT *, doc_type IN ('unknown') AS large, doc_type IN ('rsbu', 'ks2', 'ks3', 'unknown') AS spans, doc_type IN ('ks2', 'ks3') AS keep, table_key % 2 = 0 AS raster, table_key % 3 = 0 AS items FROM sp)
SELECT table_key % 500 AS page, bool_or(raster AND NOT (keep AND items) AND (spans AND (span_cells >= 4 OR absorbed >= 7 OR (span_cells >= 3 AND greatest(max_colspan, max_rowspan) >= 5)) OR large AND n_cols >= 5 AND (n_cells >= 200 OR (n_rows >= 15 AND n_cells >= 120)))) AS routed, count(*) AS tables FROM p GROUP BY table_key % 500""")
def unmarked_routing(spark, sf_dir):
    cells = A.cells(spark, sf_dir)
    kinds = cells.groupBy("table_key").agg(F.max("doc_type").alias("doc_type"))
    tables = G.span_stats(cells, KEY).join(G.size_stats(cells, KEY), KEY).join(kinds, KEY).withColumns({"page": F.col("table_key") % 500, "raster": F.col("table_key") % 2 == 0, "line_items": F.col("table_key") % 3 == 0})
    return K.unmarked_routing(tables, ["page"])


_UNITS = "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN 'some text here' ELSE c_name || ' and some more text than forty characters' END AS text, CAST(c_custkey % 12 AS INT) AS n_tables, CAST(c_custkey % 4 AS INT) AS n_images, 0 AS n_embedded, CAST(c_custkey % 500 AS INT) AS n_rows, 25 AS n_cols, CAST(c_custkey % 90 AS INT) AS n_nonempty, CAST(c_custkey % 70 AS INT) AS total_cells, c_custkey % 10 = 0 AS form_like, CASE WHEN c_custkey % 2 = 0 THEN 'sheet' ELSE 'page' END AS unit_kind, 'f' || CAST(c_nationkey AS VARCHAR(9)) AS file FROM customer"


def _units(spark, sf_dir):
    return K.office_checks(A.relation(spark, sf_dir, _UNITS))


_UNIT_SQL = f"""WITH u AS ({_UNITS}), r AS (SELECT *, list_filter([
  CASE WHEN (length(text) < 8 AND n_tables = 0 AND n_images > 0) OR (length(text) < 40 AND n_images >= 2 AND n_tables = 0) THEN 'embedded_only' END, CASE WHEN length(text) < 8 AND n_tables = 0 AND n_images = 0 THEN 'empty_document' END,
  CASE WHEN unit_kind = 'sheet' AND n_rows >= 200 AND n_nonempty < 80 AND n_nonempty < 0.02 * n_rows * n_cols THEN 'sheet_too_sparse' END,
  CASE WHEN unit_kind = 'page' AND NOT form_like AND n_tables >= 8 AND total_cells > 0 AND total_cells <= 6 * n_tables AND n_nonempty < 0.25 * total_cells AND length(text) < 200 THEN 'layout_table_abuse' END], lambda x: x IS NOT NULL) AS reasons FROM u)"""


@query(f"{_UNIT_SQL} SELECT id, reasons, len(reasons) = 0 AS suitable FROM r")
def office_checks(spark, sf_dir):
    return _units(spark, sf_dir).select("id", "reasons", "suitable")


@query(f"{_UNIT_SQL} SELECT file, count(*) AS total, count(*) FILTER (len(reasons) = 0) AS accepted, count(*) FILTER (len(reasons) > 0) AS rejected, round_even(count(*) FILTER (len(reasons) > 0) / count(*), 4) AS rejection_rate FROM r GROUP BY file")
def suitability_rollup(spark, sf_dir):
    return K.roll_up(_units(spark, sf_dir), ["file"])


@query(f"{_UNIT_SQL}, e AS (SELECT unnest(reasons) AS reason FROM r) SELECT reason, count(*) AS n FROM e GROUP BY reason")
def reason_counts(spark, sf_dir):
    return K.reason_counts(_units(spark, sf_dir))


@query(f"""{_UNIT_SQL}, t AS (SELECT count(*) AS n, count(*) FILTER (len(reasons) = 0) AS ok, count(*) FILTER (len(reasons) > 0) AS bad FROM r), e AS (SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM r) GROUP BY reason)
SELECT 0 AS part, '' AS place, printf('total %d accepted %d rejected %d', n, ok, bad) AS line FROM t UNION ALL SELECT 1, lpad(CAST(1000000000000000 - n AS VARCHAR), 16, '0') || ' ' || reason, reason || ': ' || n FROM e
UNION ALL SELECT 2, file, printf('%s: %d accepted, %d rejected', file, count(*) FILTER (len(reasons) = 0), count(*) FILTER (len(reasons) > 0)) FROM r GROUP BY file
UNION ALL SELECT 3, file || ' ' || lpad(CAST(id AS VARCHAR), 12, '0'), file || ' ' || id || ': ' || array_to_string(reasons, ', ') FROM r WHERE len(reasons) > 0 AND (SELECT bad FROM t) <= 1000""")
def suitability_report(spark, sf_dir):
    """The report's lines; details where a thousand units at most are rejected."""
    return K.report(_units(spark, sf_dir), 1000)


_INVOICES = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN concat('(1) ', CAST(o_orderkey AS VARCHAR(12)), ' (2) ООО Альфа  ', CAST(o_custkey AS VARCHAR(12)), ' (2а) Москва (2б) 7701/77')
  WHEN o_orderkey % 3 = 1 THEN concat('(1) ', CAST(o_orderkey AS VARCHAR(12)), ' (2) ООО Бета') ELSE concat(o_orderpriority, ' Итого 34 Х ', CAST(o_orderkey % 900 AS VARCHAR(9)), ',00 Х 16 996,00 111 419,00') END AS text FROM orders"""


@query("""SELECT o_orderkey AS id, CAST(seq AS INTEGER) AS seq, code, label, replace(replace(value, '$1', CAST(o_orderkey AS VARCHAR)), '$2', CAST(o_custkey AS VARCHAR)) AS value
FROM orders, (VALUES (0, '1', 'Номер и дата счёта-фактуры', '$1'), (1, '2', 'Продавец', 'ООО Альфа $2'), (2, '2а', 'Адрес продавца', 'Москва'), (3, '2б', 'ИНН/КПП продавца', '7701/77')) AS t(seq, code, label, value) WHERE o_orderkey % 3 = 0""")
def invoice_fields(spark, sf_dir):
    """Orders as texts of invoices; those with two fields give none."""
    return FO.invoice_fields(A.relation(spark, sf_dir, _INVOICES), ["id"])


@query("""SELECT o_orderkey AS id, CAST(seq AS INTEGER) AS seq, label, replace(value, '$1', CAST(o_orderkey % 900 AS VARCHAR)) AS value
FROM orders, (VALUES (0, 'Количество мест', '34'), (1, 'Количество (масса)', 'Х'), (2, 'Сумма без НДС', '$1,00'), (3, 'Ставка НДС', 'Х'), (4, 'Сумма НДС', '16 996,00'), (5, 'Сумма с НДС', '111 419,00')) AS t(seq, label, value) WHERE o_orderkey % 3 = 2""")
def torg_totals(spark, sf_dir):
    """Orders as texts of delivery notes; other texts have no totals."""
    return FO.torg_totals(A.relation(spark, sf_dir, _INVOICES), ["id"])


@query(f"WITH {A.BOXES_SQL} SELECT page, table_id, (bx1 - bx0) * (bbottom - btop) AS area, row_number() OVER (PARTITION BY page ORDER BY round_even(btop / 4, 0) * 4, round_even(bx0, 0), table_id) AS place FROM boxes")
def reading_order(spark, sf_dir):
    from pyspark.sql import Window

    b = A.boxes(spark, sf_dir)
    order = Window.partitionBy("page").orderBy(F.bround(F.col("bbox.top") / 4) * 4, F.bround("bbox.x0"), "table_id")
    return b.select("page", "table_id", GEO.area(F.col("bbox")).alias("area"), F.row_number().over(order).alias("place"))


# ---- rewrites that fold over a table's rows; tested on literal grids ----
def _grid(spark, sf_dir):
    return A.cells(spark, sf_dir).select("table_key", "row", "col", "text", "rowspan", "colspan", "covered")


@query()
def wrapped_rows(spark, sf_dir):
    return D.rewrite(_grid(spark, sf_dir), KEY, D.merge_wrapped_rows)


@query()
def leading_texts(spark, sf_dir):
    return D.rewrite(_grid(spark, sf_dir), KEY, D.merge_leading_texts)


@query()
def restored_spans(spark, sf_dir):
    return D.rewrite(_grid(spark, sf_dir), KEY, D.restore_colspans, D.restore_label_rowspans, D.restore_rowspans, D.trim_rowspans)


@query()
def balance_shift(spark, sf_dir):
    return D.rewrite(_grid(spark, sf_dir), KEY, D.shift_balance_sections)


@query(f"""WITH {A.CELLS_SQL}, v AS (SELECT * FROM cells WHERE {SEE}), u AS (SELECT DISTINCT table_key, unnest(range(col, col + greatest(colspan, 1))) AS col FROM v), uc AS (SELECT *, row_number() OVER (PARTITION BY table_key ORDER BY col) - 1 AS nc FROM u),
ur AS (SELECT table_key, row, row_number() OVER (PARTITION BY table_key ORDER BY row) - 1 AS nr FROM (SELECT DISTINCT table_key, row FROM v) AS z), h AS (SELECT table_key, count(*) AS h FROM ur GROUP BY table_key)
SELECT c.table_key, CAST(nr AS INTEGER) AS row, CAST(nc AS INTEGER) AS col, text, CAST(least(rowspan, h - nr) AS INTEGER) AS rowspan, CAST((SELECT count(*) FROM u WHERE u.table_key = c.table_key AND u.col >= c.col AND u.col < c.col + c.colspan) AS INTEGER) AS colspan
FROM cells c JOIN ur USING (table_key, row) JOIN uc ON c.table_key = uc.table_key AND c.col = uc.col JOIN h ON c.table_key = h.table_key""")
def compact_grid(spark, sf_dir):
    return G.compact(A.cells(spark, sf_dir), KEY).select("table_key", "row", "col", "text", "rowspan", "colspan")


@query()
def type_heuristics(spark, sf_dir):
    """Every table by the rules of its type."""
    cells = A.cells(spark, sf_dir).select("table_key", "row", "col", "text", "rowspan", "colspan", "covered", "doc_type")
    return FO.default_heuristics().apply(cells, KEY)


@query(f"""WITH {A.FORMS_SQL}, r AS (SELECT table_key, row, bool_or({SEE} AND regexp_full_match(trim(text), '\\d{{1,3}}\\.?') AND col = 0) AND bool_or({SEE} AND col > 0 AND {LETTER} AND length(trim(text)) >= 4) AND bool_or({SEE} AND col > 1 AND {numeric('text')}) AS item FROM forms WHERE {SEE} GROUP BY table_key, row),
x AS (SELECT table_key, bool_or(t = list_transform(range(1, len(t) + 1), lambda i: CAST(i AS VARCHAR)) AND len(t) >= 6) AS by_index FROM (SELECT table_key, row, list(trim(text) ORDER BY col) FILTER ({SEE} AND NOT text IN ('А', 'A')) AS t FROM forms WHERE row < 6 GROUP BY table_key, row) GROUP BY table_key)
SELECT table_key, CAST(sum(CASE WHEN item THEN 1 ELSE 0 END) AS BIGINT) AS items, coalesce(any_value(by_index), FALSE) AS by_index, coalesce(any_value(by_index), FALSE) OR sum(CASE WHEN item THEN 1 ELSE 0 END) >= 3 AS line_items FROM r LEFT JOIN x USING (table_key) GROUP BY table_key""")
def line_item_tables(spark, sf_dir):
    return G.line_item_table(A.form_cells(spark, sf_dir), KEY)


@query(f"WITH {A.FORMS_SQL}, r AS (SELECT table_key, row, bool_or({SEE} AND {LETTER}) AS l, bool_or({SEE} AND regexp_full_match(trim(text), '\\d{{2,10}}')) AS c, count(*) AS w FROM forms WHERE kind % 2 = 0 OR col < 3 GROUP BY table_key, row) SELECT table_key, count(*) >= 3 AND max(w) <= 4 AND count(*) FILTER (l AND c) >= 3 AS code_stack FROM r GROUP BY table_key")
def code_stacks(spark, sf_dir):
    """All tables of forms; those of odd kinds have three columns."""
    return G.code_stack(A.form_cells(spark, sf_dir).where("kind % 2 = 0 OR col < 3"), KEY)


@query(f"""WITH {A.CELLS_SQL}, c AS (SELECT table_key, row, col, trim(text) AS t, {SEE} AS see FROM cells), h AS (SELECT table_key, col, count(*) AS n FROM cells WHERE NOT covered AND regexp_full_match(text, '\\d{{4}}') GROUP BY table_key, col),
k AS (SELECT table_key, col AS cc FROM (SELECT *, row_number() OVER (PARTITION BY table_key ORDER BY n DESC, col) AS i FROM h) WHERE i = 1 AND n >= 3)
SELECT table_key, row, coalesce(string_agg(CASE WHEN col <> cc THEN t END, ' ' ORDER BY col), '') AS label, max(CASE WHEN col = cc THEN t END) AS code FROM c JOIN k USING (table_key) WHERE see AND t <> '-' GROUP BY table_key, row""")
def peeled_codes(spark, sf_dir):
    cells = A.cells(spark, sf_dir)
    return G.peel_codes(cells.where("text <> '-'"), G.code_column(cells, KEY), KEY)


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN c_name WHEN c_custkey % 4 = 2 THEN c_name || ' — x — y' WHEN c_custkey % 4 = 1 THEN c_name || ': ' || CAST(c_custkey AS VARCHAR) ELSE c_name || '. — ' || CAST(c_custkey AS VARCHAR) END AS line FROM customer")
def prose_lines(spark, sf_dir):
    c, n = spark.read.parquet(f"{sf_dir}/customer.parquet"), F.col("c_custkey")
    parts = F.when(n % 4 == 3, F.array("c_name", F.lit(" "))).when(n % 4 == 2, F.array(F.col("c_name"), F.lit("x"), F.lit("y"))).when(n % 4 == 1, F.array(F.col("c_name"), n.cast("string"))).otherwise(F.array(F.concat("c_name", F.lit(".")), n.cast("string")))
    return c.select("c_custkey", R.prose_line(parts).alias("line"))


@query("SELECT CASE l_suppkey % 4 WHEN 0 THEN 'lines' WHEN 1 THEN 'camelot' WHEN 2 THEN 'text' ELSE 'none' END AS source, count(*) AS pages, avg(l_quantity) AS mean_seconds FROM lineitem GROUP BY 1")
def source_stats(spark, sf_dir):
    source = "CASE l_suppkey % 4 WHEN 0 THEN 'lines' WHEN 1 THEN 'camelot' WHEN 2 THEN 'text' ELSE 'none' END AS source"
    return K.source_stats(A.table(spark, sf_dir, "lineitem").selectExpr(source, "l_quantity AS seconds"))


@query()
def page_documents(spark, sf_dir):
    """All documents as pages of words, converted to HTML."""
    from .. import pipeline as P

    # whole texts are dealt out by path, so that none of their words is shuffled
    docs = A.dealt(A.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "source", "text", "n_chars"), "path")
    words = A.words(spark, sf_dir, "path", docs).select("path", F.lit(1).alias("unit"), "word_id", "text", "x0", "x1", "top", "bottom", "size")
    pages = docs.select("path", F.lit(1).alias("unit"), "text", "n_chars", F.lit(0).alias("n_ocr_chars"), F.lit(0.0).alias("cover"))
    return P.pages_to_documents(pages, words)[0]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each source: documents, lines, and how many documents read as prose."""
    lines = line_stats(spark, sf_dir)
    docs = lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.avg(F.col("prose").cast("double")).alias("prose_share"), F.avg("clusters").alias("clusters"))
    meta = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "n_chars")
    reasons = K.reasons((F.coalesce("prose_share", F.lit(0.0)) < 0.2, "few_prose_lines"), (F.col("n_chars") < 40, "short"))
    units = meta.join(docs, "doc_id", "left").withColumn("reasons", reasons).withColumn("suitable", F.size("reasons") == 0)
    return K.roll_up(units, ["source"])
