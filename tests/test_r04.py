"""Findings of the fourth round: ties at the start of a run, and pages whose words aren't shuffled again."""

import re
from pathlib import Path

import pytest

from gridloom.operators import ordered as N
from gridloom.operators import pages as P
from gridloom.plans import catalog, finders, small, tables

DATA = Path("/root/testdata/sf0.001")
assert tables and finders and small
here = pytest.mark.skipif(not DATA.exists(), reason="no tables here")


def test_equal_intervals_begin_one_run(spark):
    """of equal intervals that begin a run none falls to the run before, however many and wherever they come from; merged ones lie further apart than the gap."""
    rows = [(p, lo, lo + 10.0) for p in (1, 2) for lo in (0.0, 5.0, 5.0, 40.0, 40.0, 40.0, 53.0, 66.01) for _ in range(60)]
    df = spark.createDataFrame(rows, "page int, lo double, hi double")
    want = [(p, *x) for p in (1, 2) for x in ((0.0, 15.0, 180), (40.0, 63.0, 240), (66.01, 76.01, 60))]
    for n in (1, 7):
        assert sorted((r.page, r.lo, r.hi, r.parts) for r in N.merge_intervals(df.repartition(n), ["page"], 3.0).collect()) == want


WORD = "k int, word_id int, text string, x0 double, x1 double, top double, bottom double, size double"


def test_words_of_one_number_stay_apart(spark):
    """words aren't grouped by their number: those of one number stay two, and runs of four digits are one, with the first one's height."""
    digits = [(1, 10 + i, str(i), 12.0 * i, 12.0 * i + 5, i / 9, 10.0, 10.0) for i in range(4)]
    df = spark.createDataFrame([*digits, (1, 1, "a", 90.0, 95.0, 0.0, 9.0, 8.0), (1, 1, "b", 190.0, 195.0, 0.0, 9.0, 8.0), (1, 2, "7", 290.0, 295.0, 0.0, 9.0, 8.0)], WORD)
    got = sorted((r.word_id, r.text, r.x0, r.x1, r.top, r.size) for r in N.merge_split_digits(df, ["k"]).collect())
    assert got == [(1, "a", 90.0, 95.0, 0.0, 8.0), (1, "b", 190.0, 195.0, 0.0, 8.0), (2, "7", 290.0, 295.0, 0.0, 8.0), (10, "0123", 0.0, 41.0, 0.0, 10.0)]


def test_lines_of_a_cell(spark):
    """a cell's words are joined by lines, which begin where a word stands further than 3 points from the one before by top; within a line they are in order of x."""
    words = [(1, i, t, x, x + 8.0, y, y + 8.0, 8.0) for i, (t, x, y) in enumerate([("c", 30.0, 0.0), ("a", 10.0, 2.0), ("b", 20.0, 4.0), ("e", 20.0, 12.0), ("d", 10.0, 14.0), ("z", 110.0, 0.0), ("y", 105.0, 3.0)])]
    slots = [(1, 0, 0, c, (c * 100.0, 0.0, c * 100.0 + 60, 40.0)) for c in (0, 1, 2)]
    df = spark.createDataFrame(slots, "k int, table_id int, row int, col int, bbox struct<x0:double,top:double,x1:double,bottom:double>")
    built = P.build_cells(spark.createDataFrame(words, WORD), df, ["k"])
    assert sorted((r.col, r.text) for r in built.collect()) == [(0, "a b c\nd e"), (1, "y z"), (2, "")]


@here
def test_cells_are_built_without_an_order_of_their_words(spark):
    """words are sorted for split digits only; cells come from one grouping, without windows or sorts by lambda."""
    plan = catalog.QUERIES["built_cells"](spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and not re.search(r"Window [^\n]*\[[^\]]*table_id#", plan), plan


@here
def test_words_of_texts_are_not_shuffled(spark):
    """texts are dealt out by path, and from words to pages nothing is shuffled again; words are those by number."""
    from gridloom import pipeline as PL
    from gridloom.plans import adapters as A

    docs = A.dealt(A.table(spark, str(DATA), "documents").selectExpr("CAST(doc_id AS STRING) AS path", "source", "text"), "path")
    words = A.words(spark, str(DATA), "path", docs)
    plan = PL.page_html(words.selectExpr("*", "1 AS unit"), ["path", "unit"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(path") == plan.count("Exchange ") == 1, plan
    plain = A.words(spark, str(DATA)).withColumn("doc_id", catalog.F.col("doc_id").cast("string"))
    assert words.count() == plain.count() and not words.exceptAll(plain).count()


@here
def test_crossings_are_gone_along_once(spark):
    """the next point of a line is not looked for in all of its rest, and only corners that look for their opposite bring their lines' points."""
    plan = catalog.QUERIES["ruled_slots"](spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert "RowFrame, 1, unboundedfollowing" not in plan and "RowFrame, unboundedpreceding$(), -1" in plan, plan


def test_groups_of_many_lines():
    """rectangles that share a corner are one table, whatever their lines' numbers; those of another page or line aren't."""
    import pyarrow as pa

    from gridloom.operators import finders as FI

    big = 2**31 - 9
    rows = [(0, big, 1, big + 1, 2), (0, big + 1, 2, big + 2, 3), (0, 1, big, 2, big + 1), (1, big, 1, big + 1, 2)]
    table = pa.table({n: pa.array([r[i] for r in rows], pa.int32()) for i, n in enumerate(("p", "h", "v", "h2", "v2"))})
    table = table.append_column("top", pa.array([float(r[1]) for r in rows])).append_column("x0", pa.array([float(r[2]) for r in rows]))
    assert FI._groups(table, FI._runs(table, ["p"])).tolist() == [1, 1, 0, 0]
