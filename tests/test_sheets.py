"""Sheets cut into tables and lines when converted."""

import random

from gridloom import pipeline as P
from gridloom.operators import statements as ST

CELL = "path string, unit int, row int, col int, text string, rowspan int, colspan int, covered boolean, borders int, doc_type string"


def sheet(rows, merges=(), bordered=()):
    """Cells of one sheet; merges (r0, c0, r1, c1); bordered: rows whose cells have borders."""
    width, out = max(map(len, rows)), []
    for r, row in enumerate(rows):
        for c in range(width):
            m = next((x for x in merges if x[0] <= r <= x[2] and x[1] <= c <= x[3]), None)
            first = m and (r, c) == m[:2]
            out.append(("a.xlsx", 1, r, c, row[c] if c < len(row) else "", m[2] - m[0] + 1 if first else 1, m[3] - m[1] + 1 if first else 1, bool(m) and not first, 4 if r in bordered else 0, "unknown"))
    return out


GOODS = [["№ п/п", "Наименование товара", "Единица измерения", "Количество", "Цена, руб.", "Сумма"], [str(i) for i in range(1, 7)]]
ITEM = lambda i: [str(i), f"Болт стальной М{i}", "шт", f"{i}0", "5,50", f"{i}55,00"]


def test_title_tables_and_lines_between(spark):
    rows = [["Накладная номер семь"], [], *GOODS, ITEM(1), ITEM(2), [], ["Передал: Иванов", "Принял: Петров"], *GOODS, ITEM(3), ITEM(4), ITEM(5)]
    df = spark.createDataFrame(sheet(rows, merges=[(5, 1, 9, 1)], bordered=[2, 3, 4, 5, 8, 9, 10, 11, 12]), CELL)
    tables, texts = P.sheet_parts(df)
    found = {}
    for r in tables.collect():
        found.setdefault(r.seq, {})[r.row, r.col] = (r.text, r.rowspan, r.covered)
    assert sorted(found) == [2, 8] and found[2][0, 1][0] == "Наименование товара" and max(found[8])[0] == 4
    assert found[2][3, 1] == ("Болт стальной М2", 1, False)  # the merge ends with its region (the row between keeps what isn't under it)
    assert found[8][0, 1][1:] == (2, False) and found[8][1, 1][2]  # and begins anew in the next
    assert sorted((r.seq, r.html) for r in texts.collect()) == [(0, "<p>Накладная номер семь</p>"), (7, "<p>Передал: Иванов</p>")]


def test_a_sheet_without_regions_is_one_table(spark):
    df = spark.createDataFrame(sheet([["a", "b"], ["1", "2"]]), CELL)
    tables, texts = P.sheet_parts(df)
    assert {(r.seq, r.row, r.col, r.text) for r in tables.collect()} == {(0, 0, 0, "a"), (0, 0, 1, "b"), (0, 1, 0, "1"), (0, 1, 1, "2")} and texts.count() == 0


def plain_regions(rows):
    """rows: {row: (has_value, borders, merges, score)}; row by row, as one reads a sheet."""
    last = max(rows)
    on = {r: s >= 1.5 or (b >= 2 and v) for r, (v, b, m, s) in rows.items()}
    before = dict(on)
    for r in range(last + 1):
        if r in rows and not on[r]:
            v, b, m, _ = rows[r]
            on[r] = v and (b >= 1 or m >= 1) and (on.get(r - 1, False) or before.get(r + 1, False))
    out, r = [], 0
    while r <= last:
        if on.get(r):
            end = r
            while on.get(end + 1):
                end += 1
            b, v = (sum(rows[i][j] for i in range(r, end + 1)) for j in (1, 0))
            if not (r == end and b < 2 and v <= 1) and not (v == 0 and b < 4):
                out.append((r, end))
            r = end
        r += 1
    return out


def test_regions_against_a_loop(spark):
    rng = random.Random(3)
    rows, want = [], set()
    for k in range(40):
        own = {r: (rng.random() < 0.6, rng.choice([0, 0, 1, 2, 4]), rng.choice([0, 0, 1]), rng.choice([0.0, 1.0, 1.8, 3.0])) for r in range(14) if rng.random() < 0.85}
        own[14] = (True, 0, 0, 0.0)
        rows += [(k, r, *x) for r, x in own.items()]
        want |= {(k, a, b) for a, b in plain_regions(own)}
    got = ST.table_regions(spark.createDataFrame(rows, "k int, row int, has_value boolean, borders int, merges int, score double"), ["k"])
    assert {(r.k, r.first_row, r.last_row) for r in got.collect()} == want


def test_border_scores_have_a_floor(spark):
    rows = [(1, r, c, 4 if r == 0 else 0, False, True, r == 1 and c > 0) for r in range(2) for c in range(9)]
    got = ST.row_borders(spark.createDataFrame(rows, "k int, row int, col int, borders int, inside_h boolean, inside_v boolean, covered boolean"), ["k"]).collect()
    assert {r.row: r.borders for r in got} == {0: 36, 1: 4}
