"""Findings of the third round: gaps of just a tolerance, and tables that are dealt out once."""

import re
from datetime import datetime, timedelta
from pathlib import Path

import duckdb
import pytest

from gridloom.operators import pages as P
from gridloom.operators import spans as SP
from gridloom.plans import adapters as A
from gridloom.plans import catalog, finders, small, tables

DATA = Path("/root/testdata/sf0.001")
assert tables and finders and small
here = pytest.mark.skipif(not DATA.exists(), reason="no tables here")


@pytest.fixture(scope="module")
def exact_gaps(tmp_path_factory):
    """Events whose words stand apart by just 3, 13 and 24 points: doubles and decimals differ there."""
    folder = tmp_path_factory.mktemp("gaps")
    day = datetime(2024, 1, 1)
    rows = [(page * 10000 + i, page, day + timedelta(seconds=page + i * step), "view", 7.5) for page, step in ((1, 300), (2, 1300), (3, 2400), (4, 300)) for i in range((86400 - page) // step)]
    with duckdb.connect() as db:
        db.execute("CREATE TABLE events (event_id BIGINT, user_id BIGINT, ts TIMESTAMP, event_type VARCHAR, value DOUBLE)")
        db.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?)", rows)
        db.execute(f"COPY events TO '{folder}/events.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", ["interval_merge", "running_blocks", "styled_pages", "word_lines"])
def test_gaps_of_just_the_tolerance(spark, exact_gaps, name):
    df = catalog.QUERIES[name](spark, str(exact_gaps))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW events AS SELECT * FROM '{exact_gaps}/events.parquet'")
        want = db.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.SQL[name]})").fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)


@here
def test_cells_are_as_in_sql(spark):
    for made, sql in ((A.cells, f"WITH {A.BASE} {A.CELLS}"), (A.form_cells, f"WITH {A.FORM_BASE} {A.FORM_CELLS}")):
        got, want = made(spark, str(DATA)), A.relation(spark, str(DATA), sql)
        assert got.dtypes == want.dtypes and not got.exceptAll(want).count() and not want.exceptAll(got).count()


def exchanges(spark, name) -> list[str]:
    plan = catalog.QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    return [x.strip() for x in plan.splitlines() if "Exchange hashpartitioning" in x]


@here
@pytest.mark.parametrize("name", ["balance_shift", "compact_grid", "grid_matrix", "leading_texts", "markdown_table", "phantom_merge", "prose_rows", "render_table", "rendered_forms", "restored_spans", "row_roles", "sheet_index_headers", "type_heuristics", "wrapped_rows"])
def test_tables_are_dealt_out_once(spark, name):
    """Only line items (by o or tk) and aggregates of whole tables are shuffled, never the six cells of each again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exchanges(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found and not [x for x in found if "REPARTITION_BY_COL" in x or re.search(r"hashpartitioning\(\w+#\d+L?, \w+#", x)], found


@here
@pytest.mark.parametrize("name", ["built_cells", "realigned_rows"])
def test_words_stay_with_their_tables(spark, name):
    """Only line items are shuffled, neither their words nor cells."""
    found = exchanges(spark, name)
    assert found and not [x for x in found if not re.search(r"hashpartitioning\(tk#\d+L?, 3\)", x)], found


def test_spans_by_boxes_shuffle_nothing(spark):
    """Cells of pages that were dealt out are neither joined nor shuffled on their way to spans, with tables of a page apart."""
    rows = [(k, t, r, c, "Запасы" if c == 0 and r == 0 else "", (0.0, 0.0, 99.0, 99.0) if c == 0 and r == 0 else (c * 50.0, r * 50.0, c * 50.0 + 40, r * 50.0 + 40)) for k in (1, 2) for t in (0, 1) for r in (0, 1) for c in (0, 1)]
    df = spark.createDataFrame(rows, "k int, table_id int, row int, col int, text string, bbox struct<x0:double,top:double,x1:double,bottom:double>").repartition(3, "k")
    got = SP.box_spans(df, ["k", "table_id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert sorted((r.k, r.table_id, r.row, r.col, r.rowspan, r.colspan, r.covered) for r in got.collect()) == [(k, t, r, c, 2 - r if c == 0 and r == 0 else 1, 2 if c == 0 and r == 0 else 1, (r, c) != (0, 0)) for k in (1, 2) for t in (0, 1) for r in (0, 1) for c in (0, 1)]


@here
def test_regions_of_sheets_are_found_in_one_pass(spark):
    """Rows are made once and never joined to their regions."""
    plan = catalog.QUERIES["sheet_regions"](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan parquet") == 1


@here
@pytest.mark.parametrize("name", ["merged_segments", "ruled_slots"])
def test_rules_are_dealt_out_by_page(spark, name):
    """Rules and crossings meet where their page is: no join, and no shuffle by more than the page."""
    found, plan = exchanges(spark, name), catalog.QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert found and "Join" not in plan and "Scan parquet" in plan and "crossings" not in plan and not [x for x in found if not re.search(r"hashpartitioning\(\w+#\d+L?, 3\)", x)], found


def test_slots_without_a_page_or_box(spark):
    """A slot without a page or box has no words, but comes."""
    words = spark.createDataFrame([(1, 1, "a", 1.0, 9.0, 1.0, 9.0, 8.0), (None, 2, "b", 1.0, 9.0, 1.0, 9.0, 8.0)], "k int, word_id int, text string, x0 double, x1 double, top double, bottom double, size double")
    slots = spark.createDataFrame([(k, 0, 0, c, b) for k, c, b in ((1, 0, (0.0, 0.0, 99.0, 99.0)), (1, 1, None), (None, 0, (0.0, 0.0, 99.0, 99.0)))], "k int, table_id int, row int, col int, bbox struct<x0:double,top:double,x1:double,bottom:double>")
    got = P.build_cells(words, slots, ["k"]).collect()
    assert sorted((r.k or 0, r.col, r.text) for r in got) == [(0, 0, ""), (1, 0, "a"), (1, 1, "")]


@here
def test_cases_of_numbers_come_from_orders(spark):
    """One text for each order, of all eleven kinds."""
    found = catalog.QUERIES["numeric_text_cases"](spark, str(DATA))
    assert found.count() == A.table(spark, str(DATA), "orders").count()
    assert found.selectExpr("o_orderkey % 11").distinct().count() == 11


@here
@pytest.mark.parametrize("name", ["augmented_rows", "built_cells", "code_stack_rows", "codes_near"])
def test_exploded_rows_are_not_broadcast(spark, name):
    """The estimate of rows made from line items is that of their file: a join must not send them through the driver."""
    assert "BroadcastExchange" not in catalog.QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()


def test_large_tables_are_not_broadcast(spark):
    from gridloom.storage import spool_large

    joined = spark.range(9).join(spool_large(spark.range(3), "large").groupBy("id").count(), "id")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 3


@here
@pytest.mark.parametrize("name, scans", [("codes_near", 1), ("code_stack_rows", 3)])
def test_words_near_codes_are_found_without_their_tables(spark, name, scans):
    """each word brings its block's box; words aren't made again to be joined with it."""
    plan = catalog.QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == scans and plan.count("Join") == scans // 2, plan


def test_words_bring_their_block(spark):
    """The same words, whether boxes are joined or brought."""
    words = spark.createDataFrame([(k, i, i, x, x + 8.0, y, y + 8.0) for k in (1, 2) for i, (x, y) in enumerate([(5.0, 5.0), (50.0, 5.0), (5.0, 60.0), (50.0, 60.0), (300.0, 60.0), (50.0, 300.0)])], "k int, word_id int, line int, x0 double, x1 double, top double, bottom double")
    box = "named_struct('x0', 40.0D, 'top', 50.0D, 'x1', 90.0D, 'bottom', 90.0D)"
    joined = P.codes_above(words, words.selectExpr("k", f"{box} AS bbox").distinct(), ["k"])
    brought = P.codes_above(words.selectExpr("*", f"{box} AS block"), None, ["k"])
    got = sorted((r.k, r.word_id, r.side) for r in brought.collect())
    assert got == sorted((r.k, r.word_id, r.side) for r in joined.collect()) == [(k, i, s) for k in (1, 2) for i, s in ((1, "above"), (2, "left"))]


def test_titles_in_all_letters(spark):
    """Folded without a flag: capitals and the rounded forms of letters are titles as before; others aren't."""
    from gridloom.operators import shapes as S

    texts = ["КОЛИЧЕСТВО", "Количество товара", "единица измерения", "е\u1c81иница измерения", "\u1c81ата оплаты", "Масса Брутто", "№", "ДОЛЯ, %", "2024 г.", "вид\nупаковки", "Болт стальной 12", "", "12", "ß", "наименование"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.h for r in df.select(S.column_header(df.text).alias("h")).collect()]
    assert got == [True, True, True, True, True, True, True, True, True, True, False, False, False, False, True]


def test_tables_without_work_pass_as_they_are(spark):
    """types without steps, and tables that a step can't change, needn't become grids; nulls, doubled places and keys that go on in the next batch are treated as before."""
    from gridloom.operators import folds as D

    rows = [(k, r, c, t, 1, 1, False, kind) for k, kind, top in ((1, "upd", "a"), (2, "rsbu", "b"), (3, "rsbu", "I. ВНЕОБОРОТНЫЕ АКТИВЫ Запасы"), (4, "odd", None)) for r in range(3) for c, t in ((0, top if r == 0 else "c"), (1, "1150"))]
    rows.append((1, 0, 0, "a", 1, 1, False, "upd"))
    df = spark.createDataFrame(rows, "k long, " + D.SCHEMA + ", doc_type string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = [tuple(r) for r in D.rewrite(df, ["k"], by_type=D.BY_TYPE).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    texts = {k: [t for q, _, _, t, *_ in sorted(got) if q == k] for k in (1, 2, 3, 4)}
    assert texts == {1: ["a", "1150", "c", "1150", "c", "1150"], 2: ["b", "1150", "c", "1150", "c", "1150"], 3: ["I. ВНЕОБОРОТНЫЕ АКТИВЫ", "", "Запасы", "1150", "c", "1150", "c", "1150"], 4: ["", "1150", "c", "1150", "c", "1150"]}
    assert D.IDLE[D.shift_balance_sections](["b", None]) and not D.IDLE[D.shift_balance_sections]([" i. Запасы"])


@here
def test_numbering_rows_are_read_only_where_likely(spark):
    """rows without enough texts or a 1 aren't read text by text; those with 01 or a 1 among spaces still are, and nothing is sorted by a lambda."""
    from pyspark.sql import functions as F

    from gridloom.operators import statements as ST

    rows = [(["1", "2", "3", "4", "5", "6"], True), (["01", "2", "3", "4", "5", "6"], True), (["x", "1", "2", "3", "4", "5", "6"], True), (["А", " 1", "1а", "2", "3", "4"], True), (["1", "2", "3"], False), (["11", "2", "3", "4", "5", "6"], False), ([], False)]
    df = spark.createDataFrame(rows, "t array<string>, want boolean")
    assert [r.got for r in df.select(ST.sheet_index_header(F.col("t")).alias("got")).collect()] == [want for _, want in rows]
    plan = catalog.QUERIES["sheet_index_headers"](spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and "sort_array" in plan


@here
def test_columns_are_sorted_without_lists(spark):
    """what stands right of a slot is known before columns are sorted, twice only: with rows in order, and by label."""
    plan = catalog.QUERIES["label_spans"](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    sorts = re.findall(r"Sort \[[^\]]*\]", plan)
    assert len([s for s in sorts if "col#" in s and "row#" not in s.split("col#")[0]]) == 2, sorts


def test_values_by_count_of_digits(spark):
    """three digits need a plain number, four are a value unless they are a year; letters never are."""
    from pyspark.sql import functions as F

    from gridloom.functions import text as T

    want = {"123": True, "12": False, "1 2 3": True, "1a23": False, "1/2/3": False, "(500)": True, "2024": False, "1900": False, "1899": True, "2100": False, "2101": True, "20.24": False, "12.03.2024": True, "123 456,00": True, "1-2-3-4": True, "«1234»": False, "-": False, "Х": False, "": False, "12%3": False}
    df = spark.createDataFrame([(t,) for t in want], "t string")
    assert {r.t: r.v for r in df.select("t", T.data_value(F.col("t")).alias("v")).collect()} == want


@here
def test_tables_texts_are_folded_once(spark):
    """patterns have no flag that folds each letter again, and lists are sorted without a lambda."""
    plan = catalog.QUERIES["form_signals"](spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert "(?iu)" not in plan and "array_sort" not in plan


@here
def test_cells_are_rendered_without_a_window_by_row(spark):
    """a cell's place in its row comes from the row's own cells."""
    plan = catalog.QUERIES["rendered_forms"](spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and not [x for x in plan.splitlines() if re.search(r"Window \[.*_at#", x)]
