import random

from pyspark.sql import functions as F

from gridloom import pipeline as P
from gridloom.operators import folds as D
from gridloom.operators import lines as L
from gridloom.operators import pages as PG
from gridloom.operators import shapes as S
from gridloom.operators import statements as ST

CELLS = "k int, row int, col int, text string, rowspan int, colspan int, covered boolean"


def cells(spark, *tables):
    rows = [(k, r, c, t, 1, 1, False) for k, table in enumerate(tables) for r, line in enumerate(table) for c, t in enumerate(line)]
    return spark.createDataFrame(rows, CELLS)


def test_texts(spark):
    rows = [("Код", True), ("Наименование товара", True), ("на 31 декабря", True), ("2024 г.", True), ("Болт стальной", False), ("", False), ("ИНН КПП", True), ("Стоимость работ", True), ("1 500", False)]
    df = spark.createDataFrame(rows, "t string, want boolean")
    assert [r.t for r in df.where(S.column_header(F.col("t")) != F.col("want")).collect()] == []
    spaced = {"Сумма 1 9 8 8 0 0 руб": "Сумма 198 800 руб", "1 2 3": "1 2 3", "1 2 3 4 и 5 6 7 8 9": "1 234 и 56 789", "": ""}
    got = spark.createDataFrame([(x,) for x in spaced], "t string").select("t", S.normalize_digits(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in got} == spaced


def test_rows(spark):
    long = "Общество обязуется передать товар в срок, который указан в договоре,"
    table = [["Код", "Наименование работ", "Количество"], [long, "а покупатель обязуется его оплатить полностью.", ""], ["ООО «Альфа»", "10 000,00", ""], ["ОТЧЕТ О ДВИЖЕНИИ СРЕДСТВ", "", ""], ["1", "Болт стальной оцинкованный", "5"], ["x" * 80 + " ИНН", "", ""]]
    r = {x.row: x for x in S.row_shapes(S.rows_of(cells(spark, table), ["k"])).collect()}
    assert r[0].header and not r[0].prose and r[1].prose and not r[1].header and r[2].company and r[3].section_title and not r[3].prose and r[5].intro


def test_tables(spark):
    goods = [["№ п/п", "Наименование товара", "Ед. изм.", "Количество", "Цена, руб.", "Сумма"], ["1", "2", "3", "4", "5", "6"], ["1", "Болт стальной", "шт", "5", "10,00", "50,00"]]
    chrome = [["Грузополучатель", "ООО"], ["По доверенности", ""]]
    empty = [["", ""], ["Страница 3", ""]]
    got = {r.k: (r.line_items, r.chrome, r.kind) for r in S.table_shapes(cells(spark, goods, chrome, empty), ["k"]).collect()}
    assert got == {0: (True, False, "table"), 1: (False, True, "prose"), 2: (False, True, "drop")}


def test_words_of_candidates(spark):
    prose = [f"Общество ведет учет по правилам которые приняты на год номер {i}." .split() for i in range(14)]
    table = [["Товар", f"арт{i}", "", str(100 + i), f"{i}00,50"] for i in range(14)]
    words = []
    for k, lines in enumerate((prose, table)):
        for line, parts in enumerate(lines):
            for i, t in enumerate(parts):
                if t:
                    words.append((k, line, line * 100 + i, t, i * (15.0 if k == 0 else 120.0), i * (15.0 if k == 0 else 120.0) + 12))
    df = spark.createDataFrame(words, "k int, line int, word_id long, text string, x0 double, x1 double")
    grids = spark.createDataFrame([(0, 14, 14, 0.5), (1, 14, 0, 0.5)], "k int, grid_rows int, grid_single int, share double")
    measured = L.table_measures(df, grids, ["k"], 300.0)
    assert [r.k for r in L.not_prose(measured).collect()] == [1]
    assert {r.k: r.words_tabular for r in measured.collect()} == {0: False, 1: True}


def test_cells_from_words(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for r in range(4):
        for c in range(3):
            parts = [[f"w{rng.randrange(99)}" for _ in range(rng.randint(0, 3))] for _ in range(2)]
            want[r, c] = "\n".join(" ".join(p) for p in parts if p)
            for line, p in enumerate(parts):
                rows += [(1, t, c * 100.0 + 20 * i, c * 100.0 + 20 * i + 15, r * 40.0 + line * 12, r * 40.0 + line * 12 + 10, 10.0) for i, t in enumerate(p)]
    rng.shuffle(rows)
    words = spark.createDataFrame([(*x, i) for i, x in enumerate(rows)], "k int, text string, x0 double, x1 double, top double, bottom double, size double, word_id long")
    slots = spark.createDataFrame([(1, 0, r, c, (c * 100.0, r * 40.0, c * 100.0 + 99, r * 40.0 + 39), "unknown") for r in range(4) for c in range(3)] + [(1, 0, 4, 0, None, "unknown")], "k int, table_id int, row int, col int, bbox struct<x0:double,top:double,x1:double,bottom:double>, doc_type string")
    got = {(r.row, r.col): r.text for r in PG.build_cells(words, slots, ["k"]).collect()}
    assert got == want | {(4, 0): ""}
    free = spark.createDataFrame([(1, "Итоги", 0.0, 40.0, 300.0, 310.0, 10.0, 900)], words.schema)
    body = P.page_bodies(words.union(free), slots, ["k"]).first().body
    assert body.endswith("Итоги</p>") and all(w in body for t in want.values() for w in t.split())


def test_choice_of_finders(spark):
    box = lambda top: (0.0, top, 1.0, top + 1)
    rows = [(1, 0, "lines", box(5.0), False), (1, 1, "supplementary", box(1.0), False), (1, 2, "camelot", box(0.0), False), (2, 0, "lines", box(0.0), True), (2, 1, "camelot", box(0.0), False), (2, 2, "text", box(0.0), False), (3, 0, "text", box(0.0), False), (4, 0, "lines", box(0.0), False), (4, 1, "supplementary", box(1.0), False), (5, 0, "text", box(0.0), False)]
    found = PG.choose_tables(spark.createDataFrame(rows, "k int, table_id int, source string, bbox struct<x0:double,top:double,x1:double,bottom:double>, prose boolean"), spark.createDataFrame([(1, True, True), (2, True, True), (3, True, True), (4, False, True), (5, True, False)], "k int, known boolean, second boolean"), ["k"]).collect()
    assert sorted((r.k, r.place, r.source, r.page_source) for r in found) == [(1, 1, "supplementary", "lines"), (1, 2, "lines", "lines"), (2, 1, "camelot", "camelot"), (3, 1, "text", "text"), (4, 1, "lines", "lines")]


def test_regions_of_sheets(spark):
    rng = random.Random(6)
    rows, want = [], set()
    for k in range(12):
        scores = [rng.choice([0.0, 0.5, 2.0]) for _ in range(14)]
        edges = [rng.random() < 0.4 for _ in range(14)]
        rows += [(k, i, s, b) for i, (s, b) in enumerate(zip(scores, edges, strict=True))]
        want |= {(k, a, b) for a, b in D.sheet_regions(scores, edges)}
    got = ST.sheet_regions(spark.createDataFrame(rows, "k int, row int, score double, bordered boolean"), ["k"]).collect()
    assert {(r.k, r.first_row, r.last_row) for r in got} == want


def test_index_headers(spark):
    rows = [(["1", "2", "3", "4", "5", "6"], True), (["А", "1", "1а", "2", "3", "4"], True), (["1", "2", "3", "4", "5"], False), (["Код", "1", "2", "3", "4", "5", "6", "x"], True), (["1", "3", "2", "4", "5", "6"], False), ([], False)]
    df = spark.createDataFrame(rows, "t array<string>, want boolean")
    assert df.where(ST.sheet_index_header(F.col("t")) != F.col("want")).count() == 0


def test_kernels_by_type():
    grid = lambda rows: {(r, c): {"text": t, "rowspan": 1, "colspan": 1, "covered": False} for r, line in enumerate(rows) for c, t in enumerate(line)}
    g = grid([["a", "", "5"], ["", "", ""], ["b", "", "6"]])
    D.compact(g)
    assert {p: x["text"] for p, x in g.items()} == {(0, 0): "a", (0, 1): "5", (1, 0): "b", (1, 1): "6"}
    g = grid([["Работы", "10"], ["", "20"], ["", "30"]])
    D.totals_labels(("Итого", "НДС", "Всего с НДС"))(g)
    assert [g[r, 0]["text"] for r in range(3)] == ["Работы", "НДС", "Всего с НДС"]
    g = grid([["1 Демонтаж", ""], ["x", "y"]])
    D.split_numbers(g)
    assert (g[0, 0]["text"], g[0, 1]["text"]) == ("1", "Демонтаж")
    g = grid([[str(i) for i in range(1, 9)], ["a"] * 8])
    D.canonical_titles(g)
    assert g[0, 0]["text"] == "№ п/п" and g[1, 0]["text"] == "a"
