import pytest
from pyspark.sql import functions as F

from gridloom import config as C
from gridloom.functions import text as T
from gridloom.operators import classify as K
from gridloom.operators import render as R


def values(spark, rows, *columns, names="a"):
    df = spark.createDataFrame(rows, names)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_numbers(spark):
    cases = {"1 234,56": (True, True), "(1 500)": (True, True), "123": (True, True), "12": (True, False), "2024": (True, False), "12.03.2024": (False, True), "ООО 123": (False, False), "-": (False, False), "Х": (False, False), "": (False, False), "12%": (False, False), "1e5": (True, False), "nan": (False, False), None: (False, False)}
    got = values(spark, [(k,) for k in cases], T.looks_numeric(F.col("a")), T.data_value(F.coalesce("a", F.lit(""))), names="a string")
    assert got == list(cases.values())


def test_thousands_and_labels(spark):
    cases = {"198800": "198 800", "1234567": "1 234 567", "123": "123", "(5000)": "(5 000)", "x12345": "x12345"}
    assert values(spark, [(k,) for k in cases], T.format_thousands(F.col("a")), names="a string") == list(cases.values())
    assert values(spark, [(["при-", " мер ", "", "да"],), ([],)], T.join_labels(F.col("a")), names="a array<string>") == ["при-мер да", ""]
    assert values(spark, [(["Сумма,", "руб"],), (["Сумма", "Руб"],), (["x"],)], T.label_chain(F.col("a")), names="a array<string>") == [True, False, True]


def test_html(spark):
    html = "<style>p{}</style><p>A &amp; B<br>c&nbsp;d</p><script>x</script><div> e </div>"
    assert values(spark, [(html,)], T.plain_text(F.col("a")), T.html_lines(F.col("a")), names="a string") == [("A & B c d e", ["A & B", "c d", "e"])]


def test_fonts_and_styles(spark):
    got = values(spark, [("ABCDEF+Arial-BoldItalic", 10.3)], T.font_name(F.col("a")), T.is_bold(F.col("a")), T.is_italic(F.col("a")), T.half_points(F.col("b")), T.run_style(F.col("a"), F.col("b")), names="a string, b double")
    assert got == [("Arial-BoldItalic", True, True, 10.5, "font-family: sans-serif; font-weight: bold; font-style: italic; font-size: 10.5pt")]


def test_cells_as_text(spark):
    rows = [("1", "b"), ("0", "b"), ("5.0", "n"), ("2.50", "n"), (" x ", "s")]
    assert values(spark, rows, T.format_cell(F.col("a"), F.col("b")), names="a string, b string") == ["да", "нет", "5", "2.5", "x"]


@pytest.mark.parametrize(
    ("text", "path", "fallback", "want", "confidence"),
    [
        ("Бухгалтерский баланс Форма по ОКУД 0710001", None, None, "rsbu", 3.0 / 3.5),
        ("УПД Счет-фактура", None, None, "upd", 2.3 / 3.15),
        ("КС-2 КС-3", None, None, "ks3", 1.6 / 2.65),
        ("Счет-фактура", "/упд/a.pdf", None, "upd", 0.6),
        ("", "/РСБУ/x.pdf", None, "rsbu", 0.55),
        ("ТОВАРНАЯ НАКЛАДНАЯ", None, None, "unknown", 0.0),
        ("ТОВАРНАЯ НАКЛАДНАЯ", None, "torg12", "torg12", 0.55),
    ],
)
def test_types(spark, text, path, fallback, want, confidence):
    df = spark.createDataFrame([(text, path, fallback)], "text string, path string, fallback string")
    r = K.detect_types(df, fallback="fallback").first()
    assert r.doc_type == want and abs(r.confidence - confidence) < 1e-6


def test_broken_fonts(spark):
    word = "Приложение приказу министерства финансов российской федерации форма бухгалтерского баланса декабря наименование показателя"
    cases = [(word, 200, 0, False), (" ".join(w[::-1] for w in word.split()), 200, 0, True), (word, 200, 25, True), (word, 10, 25, False), ("plain latin words " * 9, 200, 0, True), ("", 200, 0, False), ("сло5во mиxеd " * 20 + "да " * 300, 900, 0, False)]
    df = spark.createDataFrame([c[:3] for c in cases], "text string, n int, o int")
    assert [r[0] for r in df.select(K.broken_fonts(F.col("text"), F.col("n"), F.col("o"))).collect()] == [c[3] for c in cases]


def test_strictness():
    how = C.Suitability()
    assert [how.at(s, how.span_limits, how.span_floor) for s in (0.25, 0.5, 0.75, 1.0)] == [(44, 77, 33, 55), (4, 7, 3, 5), (2, 4, 2, 4), (1, 1, 1, 2)]
    assert [how.at(s, how.size_limits, how.size_floor) for s in (0.25, 0.5, 0.75, 1.0)] == [(55, 165, 1320, 2200), (5, 15, 120, 200), (4, 9, 70, 120), (2, 3, 20, 40)]


def test_lines_of_rows(spark):
    rows = [(["Итого:", "5"],), (["Да.", "5"],), (["a", "b", "c"],), (["x" * 60, "b"],), ([" ", None],)]
    got = values(spark, rows, R.prose_line(F.col("a")), R.sheet_lines(F.col("a")), names="a array<string>")
    assert [g[0] for g in got[:4]] == ["Итого: 5", "Да. — 5", "a — b — c", "x" * 60 + ": b"]
    assert [g[1] for g in got] == [["Итого: | 5"], ["Да. | 5"], ["a | b | c"], ["x" * 60 + " | b"], []]
