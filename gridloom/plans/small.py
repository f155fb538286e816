"""Queries of single rules and joins, with DuckDB SQL of the same results."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import geometry as GEO
from ..functions import text as T
from ..operators import classify as K
from ..operators import grid as G
from ..operators import joins as J
from ..operators import ordered as N
from ..operators import render as R
from ..operators import shapes as S
from ..operators import statements as ST
from ..sources import raster
from . import adapters as A
from .catalog import KEY, LETTER, SEE, numeric, query

_BANDS = "SELECT l_orderkey, l_linenumber, l_partkey % 40 * 1.0 AS a, l_partkey % 40 + 2.0 + l_suppkey % 9 AS b, l_suppkey % 45 * 1.0 AS c, l_suppkey % 45 + 1.0 + l_partkey % 11 AS d, l_partkey, l_suppkey FROM lineitem"


@query(f"""WITH x AS ({_BANDS}) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(greatest(least(b, d) - greatest(a, c), 0) / greatest(b - a, 1) AS DOUBLE) AS overlap, abs(a - c) <= 3 OR abs(b - d) <= 3 OR abs((a + b) / 2 - (c + d) / 2) <= 3 AS aligned,
  CAST(least(greatest((a - c) / 20, 0), 1) AS DOUBLE) AS clamped, CAST(least(c, d) - greatest(a, b) AS DOUBLE) AS gap FROM x""")
def bands_of_rows(spark, sf_dir):
    """How far two bands overlap, whether they are on one height, and the gap between two sides."""
    x = A.relation(spark, sf_dir, _BANDS).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.col(c).cast("double").alias(c) for c in "abcd"])
    a, b, c, d = (F.col(n) for n in "abcd")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", GEO.row_overlap(a, b, c, d).alias("overlap"), GEO.y_aligned(a, b, c, d, 3.0).alias("aligned"), GEO.clamp((a - c) / 20).alias("clamped"), GEO.cross_gap(F.array(c, d), F.array(a, b)).alias("gap"))


@query(f"""WITH {A.POINTS_SQL}, g AS (SELECT *, x0 - lag(x1) OVER w > greatest(14, 1.2 * lag(size) OVER w) AS jump FROM words WINDOW w AS (PARTITION BY page ORDER BY x0, word_id)) SELECT page, word_id, CAST(sum(CASE WHEN jump THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY x0, word_id) AS BIGINT) AS cluster FROM g""")
def word_groups(spark, sf_dir):
    """Words of a page in groups by the gaps between them."""
    return N.word_clusters(A.points(spark, sf_dir), ["page"]).select("page", "word_id", "cluster")


@query(f"""WITH {A.POINTS_SQL}, f AS (SELECT *, CASE WHEN regexp_matches(fontname, '(?i)courier') THEN 1 WHEN regexp_matches(fontname, '(?i)arial') THEN 2 ELSE 3 END AS style FROM words),
g AS (SELECT *, coalesce(x0 - lag(x1) OVER w > 1.5 * lag(size) OVER w OR style <> lag(style) OVER w OR size <> lag(size) OVER w, TRUE) AS st FROM f WINDOW w AS (PARTITION BY page ORDER BY x0, word_id)), r AS (SELECT *, sum(CASE WHEN st THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY x0, word_id) AS run FROM g)
SELECT page, word_id FROM r QUALIFY run = max(run) OVER (PARTITION BY page)""")
def nearest_runs(spark, sf_dir):
    """Of the words at a page's left side the run nearest to its inside."""
    return N.cohesive_side(A.points(spark, sf_dir), ["page"], "left").select("page", "word_id")


_LINES = "SELECT o_custkey AS page, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS line, o_orderkey % 3 = 0 AS prose, o_orderkey % 5 < 2 AS tabular, o_orderkey % 11 = 0 AS company, CAST(o_orderkey % 400 AS DOUBLE) AS jitter FROM orders"


@query(f"""WITH l AS ({_LINES}), m AS (SELECT *, line * 60.0 + jitter / 10 AS top, NOT prose AND (company OR count(*) FILTER (tabular) OVER (PARTITION BY page ORDER BY line ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) >= 2) AS hit FROM l),
f AS (SELECT *, min(CASE WHEN hit THEN line END) OVER (PARTITION BY page) AS first, lead(top) OVER (PARTITION BY page ORDER BY line) - top AS gap FROM m), s AS (SELECT *, max(CASE WHEN line < first AND (prose OR gap > 95) THEN line END) OVER (PARTITION BY page) AS stop FROM f WHERE line <= first)
SELECT page, CAST(coalesce(max(stop), 0) + 1 AS INTEGER) AS start_line FROM s GROUP BY page""")
def tabular_starts(spark, sf_dir):
    """Where tables without rules begin."""
    lines = A.relation(spark, sf_dir, _LINES).withColumn("top", (F.col("line") * 60.0 + F.col("jitter") / 10).cast("double"))
    return N.tabular_start(lines, ["page"]).select("page", F.col("start_line").cast("int").alias("start_line"))


@query(f"""WITH {A.FORMS_SQL}, r AS (SELECT table_key, row, max(k) AS k FROM forms GROUP BY table_key, row), a AS (SELECT *, coalesce(max(CASE WHEN k % 13 = 0 THEN row END) OVER (PARTITION BY table_key), -1) AS anchor FROM r)
SELECT table_key, min(CASE WHEN k % 5 = 0 AND k % 3 > 0 AND row > anchor AND row >= 3 THEN row END) AS cut_row FROM a GROUP BY table_key""")
def trailing_footers(spark, sf_dir):
    """Where a form's footer begins, behind its last anchor."""
    rows = A.form_cells(spark, sf_dir).groupBy("table_key", "row").agg(F.max("k").alias("k"))
    k = F.col("k")
    return N.trailing_chrome(rows, KEY, k % 13 == 0, k % 5 == 0, k % 3 == 0)


@query(f"""WITH {A.CELLS_SQL}, w AS (SELECT *, max(col) OVER (PARTITION BY table_key) AS mc FROM cells), h AS (SELECT table_key, col, count(*) FILTER (regexp_full_match(replace(text, ' ', ''), '\\d{{5,8}}')) AS n, count(*) FILTER ({SEE}) AS f FROM (SELECT table_key, col, row, covered, mc, CASE WHEN col = 4 AND row % 3 > 0 THEN CAST(70000 + row AS VARCHAR) ELSE text END AS text FROM w) AS z WHERE col > mc - 3 GROUP BY table_key, col)
SELECT table_key, arg_max(col, n * 100 + col) AS code_col, max(n) AS hits FROM h WHERE n >= 2 AND n >= 0.4 * f GROUP BY table_key""")
def right_codes(spark, sf_dir):
    """The column of codes at a table's right side."""
    text = F.when((F.col("col") == 4) & (F.col("row") % 3 > 0), (F.col("row") + 70000).cast("string")).otherwise(F.regexp_replace("text", " ", ""))
    return G.right_code_column(A.cells(spark, sf_dir).withColumn("text", text), KEY)


@query("SELECT o_orderkey, NOT (o_orderkey % 5 >= 2 AND o_orderkey % 7 / 100.0 >= 0.02) AND (o_custkey % 10 / 10.0 >= 0.45 OR (o_custkey % 10 / 10.0 >= 0.05 AND o_orderkey % 4 < 3 AND o_orderkey % 9 > 0 AND o_orderkey % 2 > 0)) AS needed FROM orders")
def vectorizing_needed(spark, sf_dir):
    """Pages whose ruled lines may only be in their image."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pages = A.table(spark, sf_dir, "orders").select("o_orderkey", (k % 5).alias("ruled_rows"), (k % 7 / 100.0).alias("ruled_share"), (c % 10 / 10.0).alias("cover"), (k % 4).alias("n_lines"), (k % 9).alias("n_chars"), (k % 2).alias("text_tables"))
    return pages.select("o_orderkey", K.needs_vectorizing().alias("needed"))


_EXTENTS = "SELECT l_orderkey AS page, l_linenumber AS extent_id, l_partkey, l_suppkey, CAST(l_partkey % 300 AS DOUBLE) AS lo, CAST(l_partkey % 300 + l_suppkey % 120 AS DOUBLE) AS hi FROM lineitem"
_COLUMNS = "SELECT o_orderkey AS page, i AS col, CAST(i * 50 AS DOUBLE) AS x0, CAST(i * 50 + 30 + o_custkey % 20 AS DOUBLE) AS x1 FROM orders CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) AS v(i)"


@query(f"WITH e AS ({_EXTENTS}), c AS ({_COLUMNS}) SELECT e.page, extent_id, l_partkey, l_suppkey, lo, hi, col FROM e JOIN c ON e.page = c.page AND (x0 + x1) / 2 BETWEEN lo AND hi")
def columns_of_extents(spark, sf_dir):
    """Columns whose middle lies within an extent."""
    return J.columns_under(A.relation(spark, sf_dir, _EXTENTS), A.relation(spark, sf_dir, _COLUMNS), ["page"]).select("page", "extent_id", "l_partkey", "l_suppkey", "lo", "hi", "col")


@query(f"""WITH {A.POINTS_SQL}, c AS (SELECT page, CAST(30 + page % 50 AS DOUBLE) AS code_x0, CAST(page % 7 * 100 AS DOUBLE) AS date_top FROM (SELECT DISTINCT page FROM words WHERE page % 4 > 0) AS p)
SELECT word_id FROM words LEFT JOIN c USING (page) WHERE (code_x0 IS NULL OR x0 < code_x0 - 3) AND NOT coalesce(abs(top - date_top) <= 4, FALSE)""")
def left_of_codes(spark, sf_dir):
    """Words left of a code box, without its date line."""
    words = A.points(spark, sf_dir)
    codes = words.where("page % 4 > 0").select("page").distinct().select("page", (F.col("page") % 50 + 30).cast("double").alias("code_x0"), (F.col("page") % 7 * 100).cast("double").alias("date_top"))
    return J.strip_right_of_code(words, codes, ["page"]).select("word_id")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'открыт' WHEN 'F' THEN 'закрыт' ELSE 'неизвестно' END AS label FROM orders")
def looked_up_labels(spark, sf_dir):
    """A column by a small fixed table."""
    return J.lookup(A.table(spark, sf_dir, "orders"), "o_orderstatus", {"O": "открыт", "F": "закрыт"}, "label", "неизвестно").select("o_orderkey", "label")


@query(f"""WITH {A.CELLS_SQL}, f AS (SELECT *, count(*) FILTER ({SEE} AND col > 0) OVER (PARTITION BY table_key, row) AS n, max(col) OVER (PARTITION BY table_key) AS w FROM (SELECT table_key, row, col, CASE WHEN row % 2 = 0 AND col > 1 THEN '' ELSE text END AS text, covered, colspan FROM cells) AS z)
SELECT table_key, row, col, CAST(CASE WHEN n = 1 AND {SEE} AND col > 0 THEN greatest(w, 1) ELSE colspan END AS INTEGER) AS colspan FROM f""")
def single_values(spark, sf_dir):
    """A row's only value over all value columns."""
    cells = A.cells(spark, sf_dir).withColumn("text", F.when((F.col("row") % 2 == 0) & (F.col("col") > 1), "").otherwise(F.col("text")))
    return G.value_colspan(cells, KEY).select("table_key", "row", "col", F.col("colspan").cast("int").alias("colspan"))


@query("""WITH p AS (SELECT c_custkey, list_filter([trim(c_name), CASE WHEN c_custkey % 3 = 0 THEN '' ELSE trim(c_mktsegment) END, CASE WHEN c_custkey % 5 = 0 THEN repeat('длинный текст ', 7) ELSE CAST(c_nationkey AS VARCHAR) END], lambda x: trim(x) <> '') AS t FROM customer)
SELECT c_custkey, array_to_string(list_transform(CASE WHEN len(t) <= 1 THEN t WHEN len(list_filter(t, lambda x: length(trim(x)) >= 80)) = 0 THEN [array_to_string(list_transform(t, lambda x: trim(x)), ' | ')] ELSE t END, lambda x: trim(x)), chr(10)) AS lines FROM p""")
def sheet_texts(spark, sf_dir):
    """A sheet's rows as lines."""
    k = F.col("c_custkey")
    texts = F.array(F.col("c_name"), F.when(k % 3 == 0, "").otherwise(F.col("c_mktsegment")), F.when(k % 5 == 0, "длинный текст " * 7).otherwise(F.col("c_nationkey").cast("string")))
    return A.table(spark, sf_dir, "customer").select("c_custkey", F.array_join(R.sheet_lines(texts), "\n").alias("lines"))


@query(f"""WITH {A.POINTS_SQL} SELECT word_id, 'font-family: ' || CASE WHEN contains(fontname, 'Courier') THEN 'monospace' WHEN contains(fontname, 'Arial') THEN 'sans-serif' ELSE 'serif' END || CASE WHEN contains(fontname, 'Bold') THEN '; font-weight: bold' ELSE '' END || CASE WHEN contains(fontname, 'Oblique') THEN '; font-style: italic' ELSE '' END || '; font-size: ' || printf('%.1f', size) || 'pt' AS style FROM words""")
def run_styles(spark, sf_dir):
    """Styles of words."""
    return A.points(spark, sf_dir).select("word_id", T.run_style(F.col("fontname"), F.col("size")).alias("style"))


@query(f"""WITH {A.FORMS_SQL}, x AS (SELECT table_key, row, col, trim(text) AS t, text FROM forms) SELECT table_key, row, col, t = '' OR regexp_matches(t, '^[-—–xXхХ]+$') OR {numeric('text')} OR regexp_matches(t, '^(19|20)\\d\\d(\\s*г\\.?)?$') AS forbidden,
  length(t) >= 2 AND {LETTER} AND NOT (t = '' OR regexp_matches(t, '^[-—–xXхХ]+$') OR {numeric('text')} OR regexp_matches(t, '^(19|20)\\d\\d(\\s*г\\.?)?$')) AS label,
  (length(t) > 45 AND regexp_matches(t, '[.;:]$') AND len(string_split(t, ' ')) >= 6) OR (length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) >= 18 AND length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) >= 0.85 * length(regexp_replace(t, '[^\\p{{L}}]', '', 'g'))) AS stray,
  regexp_matches(t, '(?i)^(коды|форма по окуд|\\d{{5,8}})$') AS chip FROM x""")
def label_rules(spark, sf_dir):
    """What may not go down, what labels a row, what strayed into a table, and chips of codes."""
    t = F.col("text")
    return A.form_cells(spark, sf_dir).select("table_key", "row", "col", T.forbidden_rowspan(t).alias("forbidden"), T.row_label(t).alias("label"), T.stray_text(t).alias("stray"), T.codes_chip(t).alias("chip"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey * 0.24 AS x0, l_suppkey * 0.24 AS y0, l_partkey * 0.24 + 2.4 AS x1, l_suppkey * 0.24 AS y1 FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS DOUBLE) AS l_partkey, CAST(l_suppkey AS DOUBLE) AS l_suppkey FROM lineitem) AS z")
def segments_in_points(spark, sf_dir):
    """Segments of images in points."""
    a, b = F.col("l_partkey").cast("double"), F.col("l_suppkey").cast("double")
    s = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", a.alias("l_partkey"), b.alias("l_suppkey"), a.alias("x0"), b.alias("y0"), (a + 10).alias("x1"), b.alias("y1"), F.lit(0.24).alias("scale"))
    return raster.to_points(s).drop("scale")


@query(f"""WITH {A.FORM_WORDS_SQL}, m AS (SELECT table_key, line AS row, word_id, text, CASE WHEN x1 <= 190 THEN 'left' WHEN x0 >= 800 THEN 'right' ELSE 'inside' END AS side, greatest(190 - x1, x0 - 800) <= 180 AS near FROM words),
i AS (SELECT DISTINCT table_key, row FROM m WHERE side = 'inside') SELECT table_key, word_id, side, text, row FROM m SEMI JOIN i USING (table_key, row) WHERE side <> 'inside' AND near""")
def words_beside(spark, sf_dir):
    """Words beside a grid that stand on a row's height."""
    words = A.form_words(spark, sf_dir)
    rows = words.select("table_key", F.col("line").alias("row")).distinct().select("table_key", "row", (F.col("row") * 12.0 + 2.5).alias("top"), (F.col("row") * 12.0 + 7.5).alias("bottom"), F.lit(190.0).alias("left"), F.lit(800.0).alias("right"))
    return J.side_labels(words, rows, KEY, 600.0).select("table_key", "word_id", "side", "text", "row")


@query(f"""WITH {A.FORMS_SQL}, x AS (SELECT table_key, row, bool_or({SEE} AND col = 0 AND {LETTER}) AND NOT bool_or({SEE} AND col > 0) AS lo, bool_or({SEE} AND col > 0 AND {numeric('text')}) AS hv FROM forms GROUP BY table_key, row)
SELECT l.table_key, l.row AS label_row, min(v.row) AS value_row FROM x l JOIN x v ON l.table_key = v.table_key AND abs(l.row - v.row) = 1 WHERE l.lo AND v.hv GROUP BY l.table_key, l.row""")
def labels_of_values(spark, sf_dir):
    """Rows of a label alone beside rows of values."""
    see = G.visible()
    rows = A.form_cells(spark, sf_dir).groupBy("table_key", "row").agg((F.bool_or(see & (F.col("col") == 0) & T.has_letter(F.col("text"))) & ~F.bool_or(see & (F.col("col") > 0))).alias("label_only"), F.bool_or(see & (F.col("col") > 0) & T.looks_numeric(F.col("text"))).alias("has_values"))
    return J.label_to_values(rows.withColumns({"top": F.col("row") * 12.0, "bottom": F.col("row") * 12.0 + 10}), KEY)


@query(f"WITH {A.FORMS_SQL}, x AS (SELECT table_key, max(kind) AS kind, CAST(count(*) FILTER ({SEE}) AS BIGINT) AS filled FROM forms GROUP BY table_key) SELECT table_key, '{{\"table_key\":' || table_key || ',\"kind\":' || kind || ',\"filled\":' || filled || '}}' AS json FROM x")
def json_results(spark, sf_dir):
    """Results as JSON objects."""
    each = A.form_cells(spark, sf_dir).groupBy("table_key").agg(F.max("kind").alias("kind"), F.sum(G.visible().cast("int")).alias("filled"))
    return R.result_json(each, KEY)


_SLID = "CASE WHEN col = 0 AND row % 3 = 0 AND text <> '' THEN concat(text, ' Код строки Наименование за период') ELSE text END"


@query(f"""WITH {A.FORMS_SQL}, f AS (SELECT table_key, row, col, covered, {_SLID} AS text FROM forms), r AS (SELECT table_key, row, list(trim(text) ORDER BY col) FILTER ({SEE}) AS t FROM f GROUP BY table_key, row),
m AS (SELECT table_key, row, len(list_filter(t, lambda x: regexp_full_match(x, '[0-9]{{4}}'))) > 0 AND ({" + ".join(f"CAST(contains(lower(t[1]), '{w}') AS INT)" for w in C.MASHED)}) >= 3 AS mashed FROM r)
SELECT table_key, row, col, CASE WHEN col = 0 AND coalesce(mashed, FALSE) THEN '' ELSE text END AS text FROM f JOIN m USING (table_key, row)""")
def blanked_headers(spark, sf_dir):
    """Code rows without the header that slid into their first cell."""
    cells = A.form_cells(spark, sf_dir).withColumn("text", F.expr(_SLID))
    return ST.blank_mashed_headers(cells, KEY).select("table_key", "row", "col", "text")


_ENDS = "CASE WHEN row % 3 = 0 THEN concat(j, ' 2.1. Наличие и движение запасов') ELSE j END"


@query(f"""WITH {A.FORMS_SQL}, r AS (SELECT table_key, row, array_to_string(coalesce(list(trim(text) ORDER BY col) FILTER ({SEE}), CAST([] AS VARCHAR[])), ' ') AS j FROM forms GROUP BY table_key, row), x AS (SELECT table_key, row, {_ENDS} AS j FROM r), y AS (SELECT *, regexp_extract(j, '(\\d+\\.\\d+(?:\\.\\d+)?\\.?\\s+\\p{{Lu}}[^.]{{4,119}})', 1) AS title FROM x)
SELECT table_key, row, title, CASE WHEN title <> '' THEN trim(replace(j, title, '')) ELSE j END AS joined FROM y""")
def stripped_titles(spark, sf_dir):
    """Rows without the section titles that they end in."""
    rows = S.rows_of(A.form_cells(spark, sf_dir), KEY).withColumn("j", F.col("joined")).withColumn("joined", F.expr(_ENDS))
    return ST.strip_titles(rows).select("table_key", "row", "title", "joined")
