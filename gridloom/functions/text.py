"""Text functions and predicates: Column -> Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTER = "[A-Za-zА-Яа-яЁё]"
MARKERS = ("-", "—", "Х", "X", "x", "х")
ABBREVIATIONS = ("руб.", "тыс.", "млн.", "г.", "гг.", "ст.", "п.", "пп.", "ул.", "д.", "стр.", "т.д.", "т.п.", "им.", "кв.", "обл.", "р-н.", "инв.")


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends; null as empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")


def is_empty(c: Column) -> Column:
    return strip(c) == ""


def is_number_text(c: Column) -> Column:
    """Plain decimal notation, with an exponent if any; no names of special values."""
    return c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")


def looks_numeric(c: Column) -> Column:
    """A number as statements print it: grouped digits, decimal comma, brackets for negatives."""
    return clean_numeric(strip(c))


def clean_numeric(t: Column) -> Column:
    """looks_numeric of a stripped text."""
    bare = F.translate(F.translate(t, "   ()", ""), ",", ".")
    return t.rlike(r"^[^\p{L}]") & ~t.isin(*MARKERS) & is_number_text(bare)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def data_value(c: Column) -> Column:
    """A value of a table column: three digits at least, no letters, not a year."""
    return clean_value(strip(c))


def clean_value(t: Column) -> Column:
    """data_value of a stripped text: four digits or more but for years, or three in a plain number. Groups of three have four digits at least, markers none."""
    three, four = t.rlike(r"\d\D*+\d\D*+\d"), t.rlike(r"\d\D*+\d\D*+\d\D*+\d")
    year = t.rlike(r"^\D*+(?:1\D*+9\D*+\d\D*+\d|2\D*+0\D*+\d\D*+\d|2\D*+1\D*+0\D*+0)\D*+$")
    compact = F.translate(F.regexp_replace(t, r"[\s  (),-]", ""), ",", ".")
    return ~t.rlike("[A-Za-zА-Яа-яЁё«»]") & three & ((four & ~year) | (~four & is_number_text(compact)))


def format_thousands(c: Column) -> Column:
    """Digits in groups of three; brackets around them stay; other text as it is."""
    bare = F.regexp_replace(c, r"^\((.*)\)$", "$1")
    grouped = F.regexp_replace(c, r"(?<=\d)(?=(\d{3})+\)?$)", " ")
    return F.when(bare.rlike(r"^\d{4,}$"), grouped).otherwise(c)


def starts_capital(c: Column) -> Column:
    return strip(c).rlike("^[\\p{Lu}«\"']")


def line_numeric(c: Column) -> Column:
    """A joined line that is one number of digits, one decimal mark at most."""
    t = F.translate(F.translate(c, " ()", ""), ",", ".")
    return ~c.rlike(r"\p{L}") & t.rlike(r"^\d*\.?\d*$") & t.rlike(r"\d")


def has_letter(c: Column) -> Column:
    return c.rlike(LETTER)


def join_labels(parts: Column) -> Column:
    """Trimmed parts joined by spaces, none after a hyphen; empty ones skipped."""
    clean = F.filter(F.transform(parts, strip), lambda x: x != "")
    return F.aggregate(clean, F.lit(""), lambda a, x: F.when((a == "") | a.endswith("-"), F.concat(a, x)).otherwise(F.concat(a, F.lit(" "), x)))


def plain_text(c: Column) -> Column:
    """HTML as one line of text; the five basic references are decoded."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<script[^>]*>.*?</script>", " ")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", " ")
    t = unescape_basic(F.regexp_replace(t, r"<[^>]+>", " "))
    return strip(F.regexp_replace(t, r"(?U)\s+", " "))


def unescape_basic(c: Column) -> Column:
    pairs = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def html_lines(c: Column) -> Column:
    """HTML as an array of its non-empty lines: blocks and breaks end lines."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<script[^>]*>.*?</script>", "")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", "")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(p|tr|div|li|h[1-6])>", "\n")
    t = unescape_basic(F.regexp_replace(t, r"<[^>]+>", " "))
    lines = F.transform(F.split(t, "\n"), lambda x: strip(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.filter(lines, lambda x: x != "")


def escape_html(c: Column, quotes: bool = True) -> Column:
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")] + [('"', "&quot;")] * quotes
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def half_points(size: Column) -> Column:
    """A font size to the half point, halves to even."""
    return F.bround(F.coalesce(size.cast("double"), F.lit(0.0)) * 2) / 2


def font_name(c: Column) -> Column:
    """A font's name without its subset prefix."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^[A-Z]{6}\+", "")


def is_bold(font: Column) -> Column:
    return font_name(font).rlike(r"(?i)bold|black|heavy|semibold|demi")


def is_italic(font: Column) -> Column:
    return font_name(font).rlike(r"(?i)italic|oblique")


def font_css(font: Column) -> Column:
    name = font_name(font)
    return F.when(name.rlike(r"(?i)courier|mono|consol"), "monospace").when(name.rlike(r"(?i)arial|helvetica|sans|calibri|verdana|tahoma"), "sans-serif").otherwise("serif")


def run_style(font: Column, size: Column) -> Column:
    """CSS of a run of words; names are never quoted inside the attribute."""
    parts = [F.concat(F.lit("font-family: "), font_css(font)), F.when(is_bold(font), F.lit("font-weight: bold")), F.when(is_italic(font), F.lit("font-style: italic")), F.when(half_points(size) > 0, F.format_string("font-size: %.1fpt", half_points(size)))]
    return F.concat_ws("; ", *parts)


def forbidden_rowspan(c: Column) -> Column:
    """Dashes, crosses, numbers and years don't stretch over rows."""
    t = strip(c)
    return clean_forbidden(t, clean_numeric(t))


def clean_forbidden(t: Column, numeric: Column) -> Column:
    """forbidden_rowspan of a stripped text, given whether it is a number."""
    return (t == "") | t.rlike(r"^[-—–xXхХ]+$") | numeric | t.rlike(r"^(19|20)\d\d(\s*г\.?)?$") | t.rlike(r"^2\s*0\s*\d\s*\d$")


def row_label(c: Column) -> Column:
    t = strip(c)
    return clean_label(t, clean_numeric(t))


def clean_label(t: Column, numeric: Column) -> Column:
    """row_label of a stripped text, given whether it is a number."""
    return (F.length(t) >= 2) & has_letter(t) & ~clean_forbidden(t, numeric)


def stray_text(c: Column) -> Column:
    """A sentence, or a shouted title, that strayed into a table."""
    return clean_stray(strip(c))


def clean_stray(t: Column) -> Column:
    """stray_text of a stripped text."""
    letters = F.regexp_replace(t, r"[^\p{L}]+", "")
    upper = F.length(F.regexp_replace(letters, r"[^\p{Lu}]+", ""))
    long = (F.length(t) > 45) & t.rlike(r"[.;:]$") & (F.size(F.split(t, " ")) >= 6)
    return long | ((F.length(letters) >= 18) & (upper >= 0.85 * F.length(letters)))


def label_continues(a: Column, b: Column) -> Column:
    """Whether label b carries on label a: a hyphen or comma before, or a small letter after."""
    x, y = strip(a), strip(b)
    return (x != "") & (y != "") & ~looks_numeric(y) & ~y.rlike(r"^(19|20)\d\d\b") & (x.rlike(r"[-,;]$") | y.rlike(r"^[\p{Ll}]"))


def in_order(parts: Column, field: str) -> Column:
    """A field of collected structs, sorted by their first fields; built-in functions without a lambda, so that all is compiled."""
    return F.sort_array(parts).getField(field)


def label_chain(parts: Column) -> Column:
    """Whether every part of an array carries on the one before."""
    pairs = F.arrays_zip(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))).alias("a"), F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))).alias("b"))
    return F.forall(pairs, lambda p: label_continues(p["a"], p["b"]))


def known_abbreviation(c: Column) -> Column:
    """Ends with a token that has a full stop of its own."""
    return F.lower(F.element_at(F.split(strip(c), r"\s+"), -1)).isin(*ABBREVIATIONS)


def codes_chip(c: Column) -> Column:
    t = strip(c)
    return t.rlike(r"(?iu)^(коды|форма по окуд|\d{5,8})$")


def bigram_score(c: Column, bigrams: tuple[str, ...]) -> Column:
    """How many neighbouring letters form a frequent pair."""
    w = F.translate(F.lower(c), "ё", "е")
    n = F.length(w) - 1
    pairs = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(w, i, F.lit(2)))
    return F.when(n < 1, 0).otherwise(F.size(F.filter(pairs, lambda p: p.isin(*bigrams))))


def section_title(c: Column) -> Column:
    """The title fragment n.n. Title in a row's text; empty if there is none."""
    return F.regexp_extract(c, r"(\d+\.\d+(?:\.\d+)?\.?\s+\p{Lu}[^.]{4,119})", 1)


def text_align(text: Column, col: Column, n_cols: Column) -> Column:
    t = strip(text)
    return clean_align(t == "", clean_numeric(t), t.rlike(r"\d"), col, n_cols)


def clean_align(empty: Column, numeric: Column, digit: Column, col: Column, n_cols: Column) -> Column:
    """text_align of a text of which is known whether it is empty, a number, or has a digit."""
    last = col >= F.greatest(F.lit(1), n_cols - 2)
    return F.when(empty | ((col == 0) & (n_cols > 2)), "left").when(numeric | (last & digit), "right").otherwise("left")


def format_cell(value: Column, kind: Column) -> Column:
    """A sheet's stored value as text: flags as words, whole numbers without a fraction, others to ten places."""
    number = value.try_cast("double")
    whole = F.format_string("%.0f", number)
    other = F.regexp_replace(F.regexp_replace(F.format_string("%.10f", number), r"0+$", ""), r"\.$", "")
    as_number = F.when(number == F.floor(number), whole).otherwise(other)
    return F.when(kind == "b", F.when(value == "1", "да").otherwise("нет")).when((kind == "n") & number.isNotNull(), as_number).otherwise(strip(value))
