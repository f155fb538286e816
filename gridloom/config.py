"""Thresholds and rule tables, as parameters of the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Detection:
    """Deciding a document's type."""

    least_score: float = 0.8
    known: float = 0.45
    path_confidence: float = 0.55
    fallback_confidence: float = 0.55
    tie_confidence: float = 0.5
    path_only: float = 0.5
    path_bonus: float = 0.55
    path_upd_bonus: float = 0.8
    path_invoice_factor: float = 0.4
    upd_bonus: float = 1.2
    invoice_factor: float = 0.35
    upd_factor: float = 0.5
    ks_bonus: float = 0.5
    ks_factor: float = 0.5
    close: float = 0.3
    smooth: float = 0.5
    page_text: int = 40
    invoice_markers: int = 4
    invoice_rows: int = 4
    invoice_value: int = 300
    torg_tokens: int = 3
    index_numbers: int = 6
    line_items: int = 3
    code_hits: int = 3


#: Types in the order that breaks ties.
TYPES = ("rsbu", "ks2", "ks3", "invoice_sf", "torg12", "upd", "unknown")

#: Type, weight, pattern (Java syntax, flags inline).
TYPE_SIGNALS = (
    ("rsbu", 1.2, r"(?iu)Бухгалтерский\s+баланс"),
    ("rsbu", 1.2, r"(?iu)Отч[её]т\s+о\s+финансовых\s+результатах"),
    ("rsbu", 1.0, r"(?iu)Отч[её]т\s+о\s+движении\s+денежных\s+средств"),
    ("rsbu", 1.0, r"(?iu)Форма\s+по\s+ОКУД\s*0710\d{3}"),
    ("rsbu", 0.8, r"(?U)\b071000[1-5]\b"),
    ("rsbu", 0.6, r"(?iu)Итого\s+по\s+разделу\s+[IVX]+"),
    ("ks2", 1.3, r"(?iuU)форма\s*№\s*КС-?2\b"),
    ("ks2", 1.1, r"(?U)\bКС-?2\b"),
    ("ks2", 1.0, r"0322005"),
    ("ks2", 0.9, r"(?iu)ПРИЕМК[ЕА]\s+ВЫПОЛНЕННЫХ\s+РАБОТ"),
    ("ks3", 1.3, r"(?iuU)форма\s*№\s*КС-?3\b"),
    ("ks3", 1.1, r"(?U)\bКС-?3\b"),
    ("ks3", 1.0, r"0322001"),
    ("ks3", 0.9, r"(?iu)СТОИМОСТИ\s+ВЫПОЛНЕННЫХ\s+РАБОТ"),
    ("invoice_sf", 1.0, r"(?iu)Сч[её]т\s*[-–]?\s*фактура"),
    ("invoice_sf", 0.8, r"(?iu)постановлени[юя]\s+Правительства[\s\S]{0,40}1137"),
    ("torg12", 1.3, r"(?iuU)форма\s*№\s*ТОРГ-?12\b"),
    ("torg12", 1.1, r"(?iuU)\bТОРГ-?12\b"),
    ("torg12", 1.0, r"(?U)\b330212\b"),
    ("torg12", 0.7, r"(?iu)ТОВАРНАЯ\s+НАКЛАДНАЯ"),
    ("upd", 1.3, r"(?iu)Универсальный\s+передаточный\s+документ"),
    ("upd", 1.1, r"(?U)\bУПД\b"),
    ("upd", 0.9, r"(?iu)Статус:\s*[12]\s*[–-]\s*(?:счет|передаточн)"),
    ("upd", 0.7, r"(?iu)ММВ-20-3/96"),
)
#: Folders that tell a type.
PATH_HINTS = (
    ("rsbu", r"(?iu)(?:^|[/\\])РСБУ(?:[/\\]|$)"),
    ("ks2", r"(?iu)(?:^|[/\\])кс-?2(?:[/\\]|$)"),
    ("ks3", r"(?iu)(?:^|[/\\])кс-?3(?:[/\\]|$)"),
    ("invoice_sf", r"(?iu)(?:^|[/\\])счет-?фактура(?:[/\\]|$)"),
    ("torg12", r"(?iu)(?:^|[/\\])торг\s*12(?:[/\\]|$)"),
    ("upd", r"(?iu)(?:^|[/\\])упд(?:[/\\]|$)"),
)
#: Further evidence for a type, and words of forms.
UPD_EVIDENCE = r"(?iuU)\bУПД\b|Универсальный\s+передаточн|передаточный\s+документ|Статус\s*:\s*[12]|ММВ-20-3/96|счет-фактура\s+и\s+передаточн"
KS3_EVIDENCE = r"(?iu)КС-?3|0322001|СТОИМОСТИ\s+ВЫПОЛНЕННЫХ"
KS2_EVIDENCE = r"(?iu)КС-?2|0322005|ПРИЕМК"
FORM = r"(?iu)форма\s*№|унифицированн|КС-?[23]|ТОРГ-?12|УПД|сч[её]т\s*[-–]?\s*фактура|бухгалтерский\s+баланс|ОКУД|032200[15]|0330212|071000"

#: Whether large tables and complex spans are routed, and line items kept, by type.
ROUTING = {
    "rsbu": (False, True, False),
    "ks2": (False, True, True),
    "ks3": (False, True, True),
    "invoice_sf": (False, False, False),
    "torg12": (False, False, False),
    "upd": (False, False, False),
    "unknown": (True, True, False),
}

#: Field codes of invoices.
INVOICE_FIELDS = {
    "1": "Номер и дата счёта-фактуры",
    "1а": "Исправление № / дата",
    "2": "Продавец",
    "2а": "Адрес продавца",
    "2б": "ИНН/КПП продавца",
    "3": "Грузоотправитель и его адрес",
    "4": "Грузополучатель и его адрес",
    "5": "К платёжно-расчётному документу",
    "5а": "Документ об отгрузке",
    "6": "Покупатель",
    "6а": "Адрес покупателя",
    "6б": "ИНН/КПП покупателя",
    "7": "Валюта: наименование, код",
    "8": "Идентификатор госконтракта",
}
#: Column titles of work-acceptance forms with 8 and 15 columns.
KS2_TITLES = {
    8: ("№ п/п", "Позиция по смете", "Наименование работ", "Номер единичной расценки", "Единица измерения", "Количество", "Цена за единицу, руб.", "Стоимость, руб."),
    15: ("№ п/п", "Обоснование", "Наименование работ", "Ед. изм.", "Количество", "Всего", "Осн.З", "ЭМ", "З/п мех.", "Всего", "Осн.З", "ЭМ", "З/п мех.", "ЗТ", "ЗТМ"),
}
#: Labels of bare totals rows, by type.
TOTALS = {"ks2": ("Итого", "Всего по акту"), "ks3": ("Итого", "НДС", "Всего с НДС"), "torg12": ("Итого", "Всего по накладной")}


@dataclass(frozen=True)
class Suitability:
    """Which pages can be converted."""

    font_chars: int = 50
    ocr_chars: int = 20
    letters: int = 80
    latin: float = 0.55
    cyrillic: float = 0.20
    garbled: int = 15
    garbled_cyrillic: float = 0.35
    reversed_words: int = 10
    reversed_better: int = 6
    reversed_better_share: float = 0.28
    reversed_known: int = 6
    reversed_known_share: float = 0.12
    margin: int = 2
    scan_chars: int = 40
    scan_cover: float = 0.35
    span_limits: tuple[int, ...] = (4, 7, 3, 5)
    span_floor: tuple[int, ...] = (1, 1, 1, 2)
    size_limits: tuple[int, ...] = (5, 15, 120, 200)
    size_floor: tuple[int, ...] = (2, 3, 20, 40)
    strictness: float = 0.5
    without_raster: float = 0.85
    no_bypass: float = 0.7
    force_large: float = 0.4
    force_spans: float = 0.55
    #: Frequent pairs of letters, and words of financial forms.
    # fmt: off
    bigrams: tuple[str, ...] = (
        "ст", "но", "ен", "ов", "ни", "на", "ра", "то", "ер", "ро", "ан", "ко", "ал", "по", "ол", "ор", "ес", "ос", "те", "ле",
        "ск", "ин", "ль", "во", "ка", "пр", "ре", "не", "ли", "та", "от", "ат", "ии", "ие", "ой", "ый", "ть", "ся", "ци", "че",
        "ва", "де", "го", "ем", "ам", "ом", "ум", "им", "ел", "ла", "ри", "ти", "тр", "за", "из", "ых", "их", "ее",
    )
    words: tuple[str, ...] = (
        "приложение", "приказу", "министерства", "финансов", "российской", "федерации", "форма", "бухгалтерского", "баланса",
        "декабря", "наименование", "показателя", "показатель", "капитал", "уставный", "добавочный", "резервный", "нераспределенная",
        "прибыль", "корректировки", "изменением", "учетной", "политики", "исправлением", "ошибок", "чистые", "активы",
        "дивиденды", "реорганизация", "уменьшение", "количество", "акций", "отчет", "изменениях", "организация", "юридического",
        "лица", "пояснения", "актив", "пассив",
    )
    # fmt: on

    def at(self, strictness: float, limits: tuple[int, ...], floor: tuple[int, ...]) -> tuple[int, ...]:
        """Limits for a strictness from 0 to 1; looser below the default one, down to the floor above it."""
        s, middle = min(1.0, max(0.0, strictness)), self.strictness
        if abs(s - middle) < 1e-9:
            return limits
        if s < middle:
            return tuple(max(1, round(v * (21 - 20 * s / middle))) for v in limits)
        return tuple(max(f, round(v + (f - v) * (s - middle) / (1 - middle))) for v, f in zip(limits, floor, strict=True))


#: Reasons and their messages.
REASONS = {
    "legacy_format": "формат .doc/.xls не обрабатывается (нужен OOXML)",
    "embedded_only": "почти нет текста — контент в OLE/картинках",
    "encrypted": "файл защищён паролем / зашифрован",
    "empty_document": "пустой документ (нет текста и таблиц)",
    "layout_table_abuse": "документ свёрстан декоративными таблицами, сетки данных нет",
    "sheet_too_sparse": "лист Excel почти пустой при огромном диапазоне",
    "broken_fonts": "broken fonts or text recognition garble",
    "image_only_scan": "scan without a text layer",
    "unmarked_table_lines": "tables whose lines are only in the image",
}
#: Headings of balance sections, with and without an item behind them.
SECTION = r"^((?:АКТИВ|ПАССИВ)(?:\s+[IVXLCХ]+\.\s+[А-ЯЁ][А-ЯЁ0-9\-\s«»\"]*[А-ЯЁ])?|[IVXLCХ]+\.\s+[А-ЯЁ][А-ЯЁ0-9\-\s«»\"]*[А-ЯЁ])\s+([А-ЯЁA-Z][а-яё].+)$"
SECTION_ONLY = r"(?i)^(?:АКТИВ|ПАССИВ|(?:АКТИВ|ПАССИВ)\s+[IVXLCХ]+\.\s+.+|[IVXLCХ]+\.\s+[А-ЯЁA-Z].+)$"

#: What column headers, rows of forms and table tails say. Written for any engine: no flags, \\w as [\\p{L}\\d_].
HEADER_EXACT = ("пояснения", "код", "договор", "поступило", "выбыло", "списано", "начислено", "итого", "актив", "пассив", "баланс")
HEADER_WHOLE = r"^(?:переоцен|на\s+31\s+декабря|(?:\d\s*){4}\s*г(?:ода?)?\.?|доля,?\s*%?|№|n|№\s*п/?п)$"
HEADER_PAYMENT = r"п/?п|предмет\s+договора|дата\s+оплаты|сумма\s+оплаты|единица\s+измерения|количество|код\s+вида|цена\s*\(|тариф|стоимость|налоговая\s+ставка|примечание"
HEADER_SECOND = (
    r"условн[\p{L}\d_]*\s*обознач|национальн|цифро[-\s]*в[\p{L}\d_]*\s*код|кратк[\p{L}\d_]*\s*наименов|код\s*по\s*океи|наименов[\p{L}\d_]*\s*,?\s*характерист|масса\s*брутто|масса\s*нетто|"
    r"вид\s*упаков|по\s*поряд|выполнено\s*работ|цена\s*за\s*единиц|стоимост[\p{L}\d_]*,?\s*руб"
)
HEADER_COMPANION = r"условн|обознач|национал|цифро|кратк|наименов|океи|код|измер|количеств|ставк|акциз"
HEADER_PARTS = (
    r"условн[\p{L}\d_]*\s*обознач|национальн|код\s*вида\s*товар|наименован[\p{L}\d_]*\s*товар|единиц[\p{L}\d_]*\s*измер|сумма\s*налог|стоимост[\p{L}\d_]*\s*товар|цифро[-\s]*в|кратк[\p{L}\d_]*\s*наименов|"
    r"без\s*налога|с\s*налогом|номер\s*по\s*поряд|наименован[\p{L}\d_]*\s*работ|выполнено\s*работ"
)
ITEM_HEADERS = (
    r"наименован[\p{L}\d_]*\s+товар",
    r"код\s+товар|код\s+вида",
    r"единиц[\p{L}\d_]*\s+измер",
    r"сумма\s+налог",
    r"стоимост[\p{L}\d_]*\s+товар",
    r"налогов[\p{L}\d_]*\s+ставк|нало-?\s*говая\s+ставка",
    r"номер\s+по\s+поряд",
    r"наименован[\p{L}\d_]*\s+работ",
    r"выполнено\s+работ",
    r"масса\s+брутто|масса\s+нетто",
)
PAYMENT_HEADERS = r"п/?п|предмет\s+договора|сумма|дата\s+оплаты|наименование|единица\s+измерения|количество|примечание"
COLUMN_HEADERS = (
    r"наименование\s+товар|наименован[\p{L}\d_]*\s+работ|количеств|кол-?во|цена\s*\(|цена,|стоимост|ед\.?\s*изм|единица\s+измерен|номенклатур|масса\s+(?:брутто|нетто)|сумма\s*(?:без|с\s*ндс|ндс)?|"
    r"(?:^|[^\p{L}\d_])ндс(?:$|[^\p{L}\d_])|обоснование|выполнено|номер\s+по\s+порядку|№\s*п/?п"
)
FOOTERS = (
    r"по\s+доверенности|отпуск\s+груза\s+разрешил|груз\s+получил|груз\s+принял|главный\s*\(?старший\)?\s*бухгалтер|м\.?\s*п\.?|расшифровка\s+подписи|"
    r"товарная\s+накладная\s+имеет\s+приложение|всего\s+отпущено\s+на\s+сумму"
)
SIGNATURES = r"должность|подпись|расшифровка|прописью"
PARTIES = r"\(\s*\d+[аaбb]?\s*\)|продавец\s*:|покупатель\s*:|инн\s*/?\s*кпп|грузоотправител|грузополучател|статус\s*:|плательщик|поставщик\s*:"
FORM_HEADS = r"грузоотправител|грузополучател|поставщик|плательщик|форма\s+по\s+окуд|унифицированн|товарная\s+накладн"
DATA_WORDS = r"наименование|единица|количество|цена|сумма|ндс|товар|номенклатур|кол-во|масса"
CHROME = (
    r"м\.?\s*п\.?|по\s+доверенности|прописью|приложение\s+на|имеет\s+приложение|унифицированная\s+форма|форма\s+по\s+окуд|товарная\s+накладная\s+имеет|товар\s*\(груз\)\s*передал|"
    r"результаты\s+работ|ответственн[\p{L}\d_]+\s+за\s+правильност|номер\s+документа|дата\s+составл"
)
CHROME_PARTIES = r"грузоотправител|грузополучател|поставщик|плательщик|номер\s+документа|дата\s+составл|по\s+окпо|по\s+окуд"
INTRO_MARKERS = ("Пояснения", "Организация", "ОКПО", "ИНН", "ОКВЭД", "бухгалтерск")
COMPANY = r"(?:ООО|ЗАО|ПАО|АО|ИП)[\s«\"]"
PAGE_ONLY = r"^Страница\s+\d+$"
#: Words of a header that was pressed into one row with the data before it.
MASHED = ("код", "строки", "период", "наименование", "на начало", "изменения за период", "на конец", "затраты за", "обесценение", "принято к учету", "основных", "стоимость")
