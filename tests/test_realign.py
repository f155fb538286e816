"""Realigned rows, styled runs, code pairs and lines of images against plain loops."""

import random
import re

import numpy as np

from gridloom.operators import pages as P
from gridloom.operators import render as R
from gridloom.sources import raster as I

WORDS = "k int, row int, word_id long, text string, x0 double, x1 double, top double, bottom double, size double"


def statement(rng, k):
    """Rows of a label and right-aligned numbers; some numbers are missing, some rows are headings."""
    edges = [300.0, 380.0, 460.0, 540.0][: rng.randint(2, 4)]
    rows = []
    for r in range(rng.randint(3, 8)):
        label = rng.choice(["Запасы", "Основные средства", "Прочие активы, всего", "Итого"])
        kept = edges if rng.random() < 0.6 else [e for e in edges if rng.random() < 0.7]
        rows.append((r, label, [(str(rng.randrange(100, 99999)), e + rng.choice([-2.0, 0.0, 2.0])) for e in kept]))
    words = []
    for r, label, numbers in rows:
        x = 40.0
        for t in label.split():
            words.append((k, r, len(words), t, x, x + 6 * len(t), 20.0 * r, 20.0 * r + 10, 10.0))
            x += 6 * len(t) + 4
        words += [(k, r, len(words) + i, t, e - 6 * len(t), e, 20.0 * r + 1, 20.0 * r + 11, 10.0) for i, (t, e) in enumerate(numbers)]
    return rows, words


def plain(rows):
    """{(row, col): text} of the data rows."""
    data = [x for x in rows if len(x[2]) >= 2]
    counts = [len(n) + 1 for _, _, n in data]
    if len(data) < 2:
        return {}
    modal = max(set(counts), key=lambda c: (counts.count(c), c))
    if modal < 3:
        return {}
    edges = [[n[j][1] for _, _, n in data if len(n) + 1 == modal] for j in range(modal - 1)]
    edges = [sum(e) / len(e) for e in edges]
    out = {}
    for r, label, numbers in data:
        cells = {c: [] for c in range(modal)}
        cells[0] = [label]
        for t, x in numbers:
            cells[min(range(modal - 1), key=lambda j: (abs(edges[j] - x), j)) + 1].append(t)
        out |= {(r, c): " ".join(v) for c, v in cells.items()}
    return out


def test_realigned_rows(spark):
    rng = random.Random(5)
    made = [statement(rng, k) for k in range(40)]
    df = spark.createDataFrame([w for _, words in made for w in words], WORDS).repartition(3)
    got = {}
    for r in P.realign_rows(df, ["k"]).collect():
        got.setdefault(r.k, {})[r.row, r.col] = r.text
    want = {k: w for k, (rows, _) in enumerate(made) if (w := plain(rows))}
    assert got == want and any("" in w.values() for w in want.values())
    glued = [(1, r, r * 10 + i, t, x, x + 6 * len(t), 20.0 * r, 20.0 * r + 10, 10.0) for r in range(2) for i, (t, x) in enumerate([("Запасы", 40.0), ("1210", 80.0), ("500", 200.0), ("700", 300.0)])]
    assert {(r.row, r.col): r.text for r in P.realign_rows(spark.createDataFrame(glued, WORDS), ["k"]).collect()} == {(r, c): t for r in range(2) for c, t in enumerate(["Запасы", "1210", "500", "700"])}


def test_styled_runs(spark):
    rows = [(1, 1, "a", 0.0, 6.0, 0.0, 10.0, "X-Bold"), (1, 2, "b", 8.0, 14.0, 0.5, 10.0, "X-Bold"), (1, 3, "c<", 16.0, 22.0, 0.0, 10.0, "X"), (1, 4, "d", 90.0, 96.0, 0.0, 10.0, "X"), (1, 5, "e", 0.0, 6.0, 20.0, 10.0, None)]
    html = R.styled_html(spark.createDataFrame(rows, "k int, word_id long, text string, x0 double, x1 double, top double, size double, fontname string"), ["k"]).first().html
    assert [re.sub("<[^>]*>", "", x) for x in html.split("<br>")] == ["a b c&lt; d", "e"]
    assert html.count("<span") == 4 and html.count("font-weight: bold") == 1


def test_codes_and_their_labels(spark):
    rows = [(1, 0, "Форма", 0.0, 0.0), (1, 1, "по", 40.0, 0.0), (1, 2, "0710001", 90.0, 1.0), (1, 3, "Организация", 0.0, 20.0), (1, 4, "7701", 90.0, 30.0), (1, 5, "12", 60.0, 50.0), (1, 6, "384", 90.0, 50.0), (2, 0, "нет", 0.0, 0.0)]
    df = spark.createDataFrame([(k, i, t, x, x + 30, y, y + 10) for k, i, t, x, y in rows], "k int, word_id long, text string, x0 double, x1 double, top double, bottom double")
    got = P.code_pairs(df, ["k"]).orderBy("k", "seq").collect()
    assert [(r.k, r.label, r.code) for r in got] == [(1, "Форма по", "0710001"), (1, "Организация", "7701"), (1, "12", "384")]


def test_lines_of_images(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for k in range(12):
        image = np.full((300, 400), 255, np.uint8)
        flats, talls = sorted(rng.sample(range(30, 280, 30), 3)), sorted(rng.sample(range(30, 380, 50), 3))
        for y in flats:
            image[y : y + 2, 20:380] = 0
        for x in talls:
            image[20:280, x : x + 2] = 0
        image[200:208, 150:190] = 0  # a word
        want[k] = (flats, talls)
        rows.append((k, 400, 300, bytearray(image.tobytes()), 0.5, [(75.0, 100.0, 95.0, 104.0)]))
    rows += [(90, 400, 300, bytearray(b"short"), 0.5, None), (91, None, None, None, 0.5, None)]
    images = spark.createDataFrame(rows, "page int, width int, height int, pixels binary, scale double, boxes array<struct<x0:double,y0:double,x1:double,y1:double>>").repartition(2)
    own = spark.createDataFrame([(0, 0.0, float(y), 190.0, float(y)) for y in (10, 50, 90)] + [(1, 0.0, 10.0, 190.0, 10.0)], "page int, x0 double, y0 double, x1 double, y1 double")
    found = {}
    for r in I.page_session(own, images, ["page"]).collect():
        found.setdefault(r.page, ([], [], r.raster))[0 if r.flat else 1].append(r.y0 if r.flat else r.x0)
    assert found[0][0] == [10.0, 50.0, 90.0] and not found[0][2]  # enough lines of its own
    assert set(found) == set(range(12)) and all(found[k][2] for k in range(1, 12))
    for k in range(2, 12):
        for got, lines in zip(found[k], want[k], strict=False):
            got = sorted(set(got))  # the word's mask may part a line that it lies on
            assert len(got) == len(lines) and all(abs(a - (b + 0.5) / 2) <= 1.0 for a, b in zip(got, lines, strict=True)), k


def test_a_mask_that_takes_nearly_all_is_undone():
    image = np.full((100, 100), 255, np.uint8)
    image[50, 10:90] = 0
    assert (I.mask_boxes(image, [(0, 0, 100, 100)]) == image).all()
    assert (I.mask_boxes(image, [(0, 10, 20, 20)]) == 0).sum() == 80
