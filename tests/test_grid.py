import io
import random
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom import pipeline as P
from gridloom.operators import folds as D
from gridloom.operators import forms as FO
from gridloom.operators import grid as G
from gridloom.operators import joins as J
from gridloom.operators import ordered as N
from gridloom.operators import render as R
from gridloom.sources import ooxml
from gridloom.sources import raster as I


def grid(spark, rows, **spans):
    cells = [(1, r, c, t, spans.get(f"r{r}c{c}", (1, 1))[0], spans.get(f"r{r}c{c}", (1, 1))[1], False) for r, row in enumerate(rows) for c, t in enumerate(row)]
    return spark.createDataFrame(cells, "k int, row int, col int, text string, rowspan int, colspan int, covered boolean")


def texts(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.row, {})[r.col] = r.text
    return [[out[r][c] for c in sorted(out[r])] for r in sorted(out)]


def kernel(step, rows):
    cells = {(r, c): {"text": t, "rowspan": 1, "colspan": 1, "covered": False} for r, row in enumerate(rows) for c, t in enumerate(row)}
    step(cells)
    return cells


def test_row_kinds(spark):
    df = grid(spark, [["Наименование", "Код", "Сумма"], ["", "", "тыс. руб."], ["Активы", "1110", "1 500"], ["Прочее", "", "2"]])
    kinds = N.header_rows(G.row_signals(df, ["k"]), ["k"]).orderBy("row").collect()
    assert [r.kind for r in kinds] == ["HEADER", "HEADER", "DATA", "DATA"]


def test_span_measures(spark):
    df = grid(spark, [["a", "b", "c"], ["d", "e", "f"]], r0c0=(1, 3), r1c0=(2, 1), r1c1=(2, 2))
    r = G.span_stats(df, ["k"]).first()
    assert (r.span_cells, r.colspan_cells, r.rowspan_cells, r.absorbed, r.max_colspan, r.max_rowspan) == (3, 2, 2, 5, 3, 2)


def test_anchored_bands_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(p, float(rng.randint(0, 60)), i) for p in range(5) for i in range(40)]
    got = {(r.p, r.i): r.group for r in N.anchored_groups(spark.createDataFrame(rows, "p int, top double, i int"), ["p"], ["top", "i"], "top", 3.0).collect()}
    for p in range(5):
        group, head = -1, None
        for top, i in sorted((t, i) for q, t, i in rows if q == p):
            if head is None or abs(top - head) > 3:
                group, head = group + 1, top
            assert got[p, i] == group


def test_split_digits(spark):
    word = lambda i, t, x: (1, i, t, float(x), x + 5.0, 0.0, 10.0, 10.0)
    schema = "p int, word_id int, text string, x0 double, x1 double, top double, bottom double, size double"
    got = N.merge_split_digits(spark.createDataFrame([word(i, t, 12 * i) for i, t in enumerate("1988")] + [word(9, "x", 90)], schema), ["p"]).orderBy("x0").collect()
    assert [r.text for r in got] == ["1988", "x"]
    three = N.merge_split_digits(spark.createDataFrame([word(i, t, 12 * i) for i, t in enumerate("198")], schema), ["p"]).collect()
    assert len(three) == 3


def test_intervals_and_blocks(spark):
    got = N.merge_intervals(spark.createDataFrame([(1, 0.0, 10.0), (1, 12.0, 20.0), (1, 40.0, 50.0)], "k int, lo double, hi double"), ["k"], 3.0).orderBy("lo").collect()
    assert [(r.lo, r.hi) for r in got] == [(0, 20), (40, 50)]
    rows = spark.createDataFrame([(1, 0, 0.0, 10.0), (1, 1, 12.0, 22.0), (1, 2, 40.0, 50.0)], "k int, seq int, top double, bottom double")
    assert [r.block for r in N.running_blocks(rows, ["k"]).orderBy("seq").collect()] == [0, 0, 1]


def test_side_labels(spark):
    words = spark.createDataFrame([(1, 1, "left", 0.0, 20.0, 10.0, 20.0), (1, 2, "in", 60.0, 80.0, 10.0, 20.0), (1, 3, "far", 0.0, 20.0, 50.0, 60.0)], "p int, word_id int, text string, x0 double, x1 double, top double, bottom double")
    rows = spark.createDataFrame([(1, 0, 8.0, 22.0, 50.0, 100.0), (1, 1, 48.0, 62.0, 50.0, 100.0)], "p int, row int, top double, bottom double, left double, right double")
    got = J.side_labels(words, rows, ["p"], 300.0).collect()
    assert [(r.word_id, r.side, r.row) for r in got] == [(1, "left", 0)]


def test_index_header_and_titles(spark):
    assert [r.index_header for r in G.index_header(grid(spark, [["1", "2", "3", "4", "5", "6"], ["А", "1", "2", "3", "4", "5"], ["А", "1", "2", "3", "4", "5"]]), ["k"]).orderBy("row").collect()] == [True, False, False]
    out = texts(FO.ks2_titles(grid(spark, [[str(i) for i in range(1, 9)], ["x"] * 8]), ["k"]))
    assert out[0][0] == "№ п/п" and out[0][7] == "Стоимость, руб." and out[1] == ["x"] * 8


def test_totals(spark):
    rows = [["Работа", "1 000"], ["", "200"], ["", "1 200"]]
    assert texts(FO.label_totals(grid(spark, rows), ["k"], ("Итого", "НДС", "Всего с НДС"))) == [["Работа", "1 000"], ["НДС", "200"], ["Всего с НДС", "1 200"]]
    assert texts(FO.label_totals(grid(spark, [["x", "1"], ["", "5"]]), ["k"], ("Итого", "НДС")))[1] == ["Итого", "5"]


def test_number_and_name(spark):
    assert texts(G.split_number_name(grid(spark, [["1 Демонтаж", "", "5"], ["2 Монтаж", "x", "6"]]), ["k"])) == [["1", "Демонтаж", "5"], ["2 Монтаж", "x", "6"]]


def test_folds():
    wrapped = kernel(D.merge_wrapped_rows, [["Основные", ""], ["средства", "5"], ["Прочее", "6"]])
    assert [wrapped[r, 0]["text"] for r in range(2)] == ["Основные средства", "Прочее"] and wrapped[0, 1]["text"] == "5"
    lead = kernel(D.merge_leading_texts, [["Сумма,", "руб", "5"]])
    assert (lead[0, 0]["text"], lead[0, 0]["colspan"], lead[0, 1]["covered"]) == ("Сумма, руб", 2, True)
    down = kernel(D.restore_label_rowspans, [["Группа", "a", "1"], ["", "b", "2"], ["Другая", "c", "3"]])
    assert down[0, 0]["rowspan"] == 2 and down[1, 0]["covered"] and down[2, 0]["rowspan"] == 1
    balance = kernel(D.shift_balance_sections, [["I. ВНЕОБОРОТНЫЕ АКТИВЫ Основные средства", "1150", "5"], ["Прочие", "1160", "6"], ["Итого", "1100", "7"]])
    assert [balance[r, 0]["text"] for r in range(4)] == ["I. ВНЕОБОРОТНЫЕ АКТИВЫ", "Основные средства", "Прочие", "Итого"] and balance[1, 1]["text"] == "1150"
    assert D.sheet_regions([0, 2, 0, 2, 2, 0, 0, 0, 1.6], [False] * 9) == [(1, 4)]
    assert D.merge_inline([{"top": 0, "x0": 0, "x1": 50}, {"top": 2, "x0": 60, "x1": 90}, {"top": 2, "x0": 400, "x1": 420}], 600) == [[0, 1], [2]]


def test_html_and_markdown(spark):
    df = grid(spark, [["Наименование", "Код", "Сумма"], ["Активы", "1110", "1 500"]], r0c0=(1, 2)).withColumn("covered", (F.col("row") == 0) & (F.col("col") == 1))
    html = R.table_html(df, ["k"]).first().html
    assert html.startswith('<table><thead><tr><th colspan="2" style="text-align: left">Наименование</th>') and '<td style="text-align: right">1 500</td></tr></tbody></table>' in html
    assert R.markdown_table(G.matrix(df, ["k"]), ["k"]).first().markdown.split("\n")[1] == "| --- | --- | --- |"


def office_files():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    cell = lambda t, more="": f"<w:tc><w:tcPr>{more}</w:tcPr><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    body = f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Title</w:t></w:r></w:p><w:p><w:r><w:t>Some text of the document</w:t></w:r></w:p><w:tbl><w:tr>{cell("Name", "<w:gridSpan w:val=\"2\"/>")}{cell("Sum")}</w:tr><w:tr>{cell("Goods")}{cell("a")}{cell("1 500")}</w:tr></w:tbl></w:body></w:document>'
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    sheet = f'<worksheet {s}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>Name of goods</t></is></c><c r="B1" t="s"><v>0</v></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>5.50</v></c></row></sheetData><mergeCells><mergeCell ref="A3:B3"/></mergeCells></worksheet>'
    parts = {"xl/workbook.xml": f'<workbook {s}><sheets><sheet name="One" sheetId="1" r:id="r1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>', "xl/sharedStrings.xml": f"<sst {s}><si><t>Sum</t></si><si><t>Bolts</t></si></sst>", "xl/worksheets/sheet1.xml": sheet}

    def packed(files):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for k, v in files.items():
                z.writestr(k, v)
        return out.getvalue()

    return {"a.docx": packed({"word/document.xml": body}), "b.xlsx": packed(parts), "c.xls": b"\xd0\xcf\x11\xe0rest", "d.docx": b"no zip"}


def test_office(spark, tmp_path):
    for name, data in office_files().items():
        (tmp_path / name).write_bytes(data)
    documents, units = P.office_html(ooxml.discover(spark, f"file://{tmp_path}"))
    html = {r.path.rsplit("/", 1)[1]: r.html for r in documents.collect()}
    assert "<h1>Title</h1><p>Some text of the document</p>" in html["a.docx"] and 'colspan="2"' in html["a.docx"] and "1 500" in html["a.docx"]
    assert "Bolts" in html["b.xlsx"] and ">5.5<" in html["b.xlsx"]
    assert 'data-reasons="legacy_format"' in html["c.xls"] and 'data-reasons="unreadable"' in html["d.docx"]
    assert {r.path.rsplit("/", 1)[1]: r.accepted for r in P.results(units).collect()} == {"a.docx": 1, "b.xlsx": 1, "c.xls": 0, "d.docx": 0}
    found = P.to_html(spark, f"file://{tmp_path}/a.docx")
    assert (found.accepted, found.rejected, found.cells_left_out) == (1, (), 0) and found.html == html["a.docx"]
    with pytest.raises(ValueError):
        P.to_html(spark, "x.pdf")
    P.write_documents(documents, f"file://{tmp_path}/out", "html")
    assert (tmp_path / "out" / "file=a.docx").is_dir()


def test_what_a_sheet_leaves_out_is_counted(spark, tmp_path):
    (tmp_path / "b.xlsx").write_bytes(office_files()["b.xlsx"])
    rows = ooxml.read_office(ooxml.discover(spark, f"file://{tmp_path}"), ooxml.Limits(rows=1)).where("kind = 'left_out'").collect()
    assert [r.text for r in rows] == ["2"]


def test_segments():
    image = np.full((200, 300), 255, np.uint8)
    image[50:52, 20:280] = 0
    image[20:180, 100:102] = 0
    found = I.detect_segments(image)
    assert any(abs(y - 50.5) <= 2 and x1 - x0 > 240 for x0, y, x1, _ in found) and any(abs(x - 100.5) <= 2 and y1 - y0 > 140 for x, y0, _, y1 in found)
    assert I.support(I.binarize(image), (20, 50.5, 280, 50.5)) > 0.9


def test_segments_of_both_directions(spark):
    rows = [(1, 0.0, 10.0, 50.0, 10.0), (1, 55.0, 11.0, 90.0, 11.0), (1, 20.0, 0.0, 20.0, 40.0), (1, 21.0, 45.0, 21.0, 80.0), (1, 300.0, 60.0, 310.0, 60.0)]
    found = I.merge_all_segments(spark.createDataFrame(rows, "page int, x0 double, y0 double, x1 double, y1 double"), ["page"]).collect()
    assert sorted((r.flat, r.x0, r.y0, r.x1, r.y1) for r in found) == [(False, 20.5, 0.0, 20.5, 80.0), (True, 0.0, 10.5, 90.0, 10.5)]
    image = np.full((60, 60), 100, np.uint8)
    image[32] = 255
    assert I.snap_to_gutter(image, (5, 30, 50, 30)) == (5, 32.0, 50, 32.0) and I.snap_to_gutter(image.T, (30, 5, 30, 50)) == (32.0, 5, 32.0, 50)


class State:
    """A stand-in for a stream's state."""

    exists, get, hasTimedOut = False, (), False

    def update(self, value):
        self.exists, self.get = True, value

    def setTimeoutDuration(self, ms):
        pass


def test_stream_state():
    from gridloom.streaming.pages import _carry

    state = State()
    frame = lambda *rows: iter([pd.DataFrame(rows, columns=["path", "unit", "own_type"])])
    first = pd.concat(_carry(("f",), frame(("f", 4, "ks3"), ("f", 2, None), ("f", 1, "ks2")), state))
    then = pd.concat(_carry(("f",), frame(("f", 3, None), ("f", 5, None), ("f", 0, None)), state))
    assert list(first["doc_type"]) == ["ks2", "ks2", "ks3"] and list(then["doc_type"]) == ["unknown", "ks2", "ks3"]


def test_stream(spark, tmp_path):
    from gridloom.streaming.pages import carry_types, windowed_reasons

    source, schema = f"file://{tmp_path}/in", "path string, unit int, own_type string"
    for i, rows in enumerate(([("f", 1, "ks2"), ("f", 3, "upd"), ("g", 1, None)], [("f", 2, None), ("f", 4, None), ("g", 2, "ks3")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = carry_types(spark.readStream.schema(schema).parquet(source)).writeStream.format("parquet").option("path", f"file://{tmp_path}/out").outputMode("append")
        stream.option("checkpointLocation", f"file://{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
        got = {(r.path, r.unit, r.doc_type) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
        first = {("f", 1, "ks2"), ("f", 3, "upd"), ("g", 1, "unknown")}
        assert got == (first, first | {("f", 2, "ks2"), ("f", 4, "upd"), ("g", 2, "ks3")})[i]
    units = spark.createDataFrame([(i, ["empty_document"] if i % 2 else []) for i in range(6)], "n int, reasons array<string>").selectExpr("timestamp_seconds(n * 400) AS at", "reasons")
    assert sorted((r.reason, r.n) for r in windowed_reasons(units).collect()) == [("empty_document", 1)] * 3


