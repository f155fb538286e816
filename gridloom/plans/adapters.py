"""Relations of pages, words and cells made from plain tables, so that every operator has input.

Each is SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Line items as cells of one table for each order: label, code, quantity, price, status, mark.
CELLS = """
SELECT o AS table_key, CAST(r AS INT) AS row, col, text, rowspan, colspan, covered,
  col * 50.0 AS x0, col * 50.0 + 40.0 + r % 3 AS x1, r * 12.0 AS top, r * 12.0 + 10.0 AS bottom, doc_type
FROM (
  SELECT o, r, 0 AS col, CASE WHEN k % 5 = 0 THEN '' WHEN k % 11 = 0 THEN concat('Раздел ', flag, ' item.') WHEN k % 29 = 0 THEN concat('Сведения о порядке учета приведены в пояснениях к отчету номер ', CAST(k AS VARCHAR(9)), '.') ELSE concat(flag, ' item ', CAST(k % 97 AS VARCHAR(9))) END AS text, 1 AS rowspan, CASE WHEN k % 7 = 0 THEN 2 ELSE 1 END AS colspan, FALSE AS covered, dt AS doc_type FROM b
  UNION ALL SELECT o, r, 1, CASE WHEN k % 7 = 0 OR k % 13 = 0 THEN '' ELSE CAST(1000 + k % 9000 AS VARCHAR(9)) END, 1, 1, k % 7 = 0, dt FROM b
  UNION ALL SELECT o, r, 2, CASE WHEN k % 17 = 0 THEN '-' ELSE CAST(q AS VARCHAR(9)) END, CASE WHEN k % 19 = 0 THEN 2 ELSE 1 END, 1, FALSE, dt FROM b
  UNION ALL SELECT o, r, 3, concat(CAST(CAST(floor(c / 100000) AS BIGINT) AS VARCHAR(9)), ' ', lpad(CAST(CAST(floor(c / 100) AS BIGINT) % 1000 AS VARCHAR(9)), 3, '0'), ',', lpad(CAST(c % 100 AS VARCHAR(9)), 2, '0')), 1, 1, FALSE, dt FROM b
  UNION ALL SELECT o, r, 4, CASE WHEN k % 3 = 0 THEN '' ELSE status END, 1, 1, FALSE, dt FROM b
  UNION ALL SELECT o, r, 5, CASE WHEN k % 4 = 0 THEN 'Х' WHEN k % 4 = 1 THEN '(12,5)' WHEN k % 4 = 2 THEN ' ' ELSE '2024' END, 1, 1, FALSE, dt FROM b
) AS u
"""
BASE = """
b AS (
  SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag, l_linestatus) - 1 AS r, l_partkey AS k,
    l_returnflag AS flag, l_linestatus AS status, CAST(floor(l_quantity) AS BIGINT) AS q, CAST(floor(l_extendedprice) AS BIGINT) AS c,
    CASE l_orderkey % 5 WHEN 0 THEN 'rsbu' WHEN 1 THEN 'ks2' WHEN 2 THEN 'upd' WHEN 3 THEN 'unknown' ELSE 'ks3' END AS dt
  FROM lineitem)
"""
#: Events as words of one page for each user.
POINTS = """
SELECT user_id AS page, event_id AS word_id, event_type AS text, CAST(floor(value) AS DOUBLE) AS x0, CAST(floor(value) AS DOUBLE) + 6 AS x1,
  (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 100.0 AS top, (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 100.0 + 10 AS bottom,
  CAST(8 + event_id % 5 AS DOUBLE) AS size, CASE WHEN event_id % 3 = 0 THEN 'ABCDEF+Arial-Bold' WHEN event_id % 3 = 1 THEN 'Times' ELSE 'Courier-Oblique' END AS fontname
FROM events
"""
#: Four boxes on each page; the third lies within the second.
BOXES = """
SELECT page, table_id, bx0, btop, bx1, bbottom FROM (SELECT DISTINCT user_id AS page FROM events) AS u,
  (VALUES (0, 0.0, 0.0, 40.0, 400.0), (1, 30.0, 200.0, 90.0, 700.0), (2, 32.0, 210.0, 88.0, 690.0), (3, 5.0, 500.0, 60.0, 800.0)) AS v(table_id, bx0, btop, bx1, bbottom)
"""
#: Orders as pages of one file for each customer, with the words of forms.
PAGES = """
SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS page, o_orderkey AS id,
  CASE o_orderkey % 13 WHEN 0 THEN 'Бухгалтерский баланс. Форма по ОКУД 0710001' WHEN 1 THEN 'УПД Счет-фактура' WHEN 2 THEN 'КС-2 КС-3' WHEN 3 THEN 'Счёт-фактура' WHEN 4 THEN 'ТОВАРНАЯ НАКЛАДНАЯ'
    WHEN 5 THEN 'форма № КС-2, приемка выполненных работ 0322005' WHEN 6 THEN 'Универсальный передаточный документ' WHEN 7 THEN 'Отчет о движении денежных средств' WHEN 8 THEN 'форма № ТОРГ-12' WHEN 9 THEN '' ELSE o_orderpriority END AS text,
  CASE o_orderkey % 7 WHEN 0 THEN '/упд/a.pdf' WHEN 1 THEN '/РСБУ/x.pdf' WHEN 2 THEN '/кс2/b.pdf' ELSE '/other/c.pdf' END AS path,
  CASE WHEN o_orderkey % 4 = 0 THEN 'rsbu' WHEN o_orderkey % 4 = 1 THEN 'ks2' END AS own_type
FROM orders
"""
#: Line items as tables of forms, some sixteen rows each: goods with numbered columns, prose, a form's head, goods, bullets, prose in two columns, a statement, payments.
FORM_BASE = """
fb AS (
  SELECT tk, CAST(rn AS INT) AS r, k, q, c, CAST(tk % 8 AS INT) AS kind, n FROM (
    SELECT CAST(floor(l_orderkey / 4) AS BIGINT) AS tk, l_partkey AS k, CAST(floor(l_quantity) AS BIGINT) AS q, CAST(floor(l_extendedprice) AS BIGINT) AS c,
      row_number() OVER (PARTITION BY CAST(floor(l_orderkey / 4) AS BIGINT) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS rn,
      count(*) OVER (PARTITION BY CAST(floor(l_orderkey / 4) AS BIGINT)) AS n FROM lineitem) AS f0)
"""
FORM_CELLS = """
SELECT tk AS table_key, r AS row, CAST(col AS INT) AS col, kind, k,
  CASE kind
    WHEN 0 THEN CASE WHEN r = 0 THEN CASE col WHEN 0 THEN '№ п/п' WHEN 1 THEN 'Наименование товара' WHEN 2 THEN 'Единица измерения' WHEN 3 THEN 'Количество' WHEN 4 THEN CASE WHEN tk % 16 = 0 THEN 'Налоговая ставка' ELSE 'Цена, руб.' END ELSE 'Сумма без НДС' END
      WHEN r = 1 THEN CAST(col + 1 AS VARCHAR(9)) WHEN r = n - 1 AND n > 5 THEN CASE WHEN col >= 4 THEN concat(CAST(c AS VARCHAR(9)), ',00') ELSE '' END
      ELSE CASE col WHEN 0 THEN CAST(r - 1 AS VARCHAR(9)) WHEN 1 THEN concat('Болт стальной ', CAST(k AS VARCHAR(9))) WHEN 2 THEN 'шт' WHEN 3 THEN CAST(q AS VARCHAR(9)) WHEN 4 THEN concat(CAST(c % 900 AS VARCHAR(9)), ',50') ELSE concat(CAST(c AS VARCHAR(9)), ',00') END END
    WHEN 1 THEN CASE WHEN col > 0 THEN '' WHEN r % 3 = 0 THEN concat('Общество ведет учет по правилам, которые приняты на весь год и хранятся ', CAST(k AS VARCHAR(9)), ' дней.') ELSE 'Сведения о порядке учета раскрыты в пояснениях, приложенных к отчету, и верны;' END
    WHEN 2 THEN CASE WHEN r = 0 AND col = 0 THEN 'Унифицированная форма № ТОРГ-12' WHEN r = 1 AND col = 0 THEN 'Грузополучатель' WHEN r = 1 AND col = 1 THEN 'ООО «Альфа», г. Москва' WHEN col = 0 THEN 'По доверенности' WHEN col = 2 AND k % 2 = 0 THEN CAST(k AS VARCHAR(9)) WHEN col = 4 AND k % 5 = 0 THEN 'подпись' ELSE '' END
    WHEN 3 THEN CASE WHEN r = 0 THEN CASE col WHEN 0 THEN 'Код' WHEN 1 THEN 'Наименование работ' WHEN 2 THEN 'Ед. изм.' WHEN 3 THEN 'Кол-во' WHEN 4 THEN 'Примечание' ELSE '' END
      ELSE CASE col WHEN 0 THEN CAST(k % 90 AS VARCHAR(9)) WHEN 1 THEN concat('Монтаж узла трубы ', CAST(k AS VARCHAR(9))) WHEN 2 THEN 'м' WHEN 3 THEN CAST(q AS VARCHAR(9)) WHEN 4 THEN CASE WHEN k % 4 = 0 THEN 'нет' ELSE concat(CAST(c AS VARCHAR(9)), ',10') END ELSE '' END END
    WHEN 4 THEN CASE WHEN col = 0 THEN concat('• пункт ', CAST(r AS VARCHAR(9)), ' списка') WHEN col = 1 AND k % 3 = 0 THEN 'см. приложение' ELSE '' END
    WHEN 5 THEN CASE WHEN col = 0 THEN concat('Организация обязуется передать товар, указанный в заказе ', CAST(k AS VARCHAR(9)), ',') WHEN col = 1 THEN 'а заказчик обязуется принять его и уплатить 10 тыс. руб. в срок.' WHEN col = 2 AND k % 4 = 0 THEN 'Страница 3' ELSE '' END
    WHEN 6 THEN CASE WHEN r = 0 THEN CASE WHEN col = 0 THEN 'Организация ООО «Альфа», ИНН 7701000000, вид деятельности по ОКВЭД, единица измерения тыс. руб.' ELSE '' END WHEN r = 1 THEN CASE WHEN col = 0 THEN 'ОТЧЕТ О ДВИЖЕНИИ СРЕДСТВ' ELSE '' END
      ELSE CASE col WHEN 0 THEN CASE WHEN k % 3 = 0 THEN 'Запасы' ELSE concat('Основные средства ', CAST(k % 9 AS VARCHAR(9))) END WHEN 1 THEN CAST(1100 + k % 800 AS VARCHAR(9)) WHEN 2 THEN CAST(c AS VARCHAR(9)) WHEN 3 THEN CASE WHEN k % 5 = 0 THEN 'Х' ELSE concat('(', CAST(q AS VARCHAR(9)), '00)') END ELSE '' END END
    ELSE CASE WHEN r = 0 THEN CASE col WHEN 0 THEN 'Договор' WHEN 1 THEN 'Дата оплаты' WHEN 2 THEN 'Сумма оплаты' ELSE '' END
      ELSE CASE col WHEN 0 THEN concat('ООО «Альфа ', CAST(k AS VARCHAR(9)), '»') WHEN 1 THEN concat('0', CAST(1 + k % 9 AS VARCHAR(9)), '.0', CAST(1 + q % 9 AS VARCHAR(9)), '.2024') WHEN 2 THEN concat(CAST(c AS VARCHAR(9)), ',00') ELSE '' END END
  END AS text, 1 AS rowspan, CASE WHEN kind = 2 AND col = 0 AND (r < 2 OR k % 3 = 0) THEN 3 WHEN kind = 6 AND r = 0 AND col = 0 THEN 2 ELSE 1 END AS colspan, (kind = 2 AND col IN (1, 2) AND (r = 0 OR (r > 1 AND k % 3 = 0))) OR (kind = 6 AND r = 0 AND col = 1) AS covered
FROM fb CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) AS cc(col)
"""
#: The words of those cells: 14 points apart, 200 a column, 12 a row.
FORM_WORDS = """
SELECT table_key, row AS line, CAST(row * 10000 + col * 100 + place AS BIGINT) AS word_id, text, col * 200.0 + place * 14.0 AS x0, col * 200.0 + place * 14.0 + 12.0 AS x1, row * 12.0 AS top, row * 12.0 + 10.0 AS bottom FROM {words} WHERE text <> ''
"""
#: The same relations for Spark: each row becomes its cells after the windows, which part the rows by an attribute, so that
#: cells stay where the line items were shuffled to and work by table needs no further shuffle. {lines}: see line_items.
SPARK_BASE = """
b AS (
  SELECT o, row_number() OVER (PARTITION BY o ORDER BY l_linenumber, k, l_suppkey, l_extendedprice, l_quantity, flag, status) - 1 AS r, k, flag, status, q, c,
    CASE o % 5 WHEN 0 THEN 'rsbu' WHEN 1 THEN 'ks2' WHEN 2 THEN 'upd' WHEN 3 THEN 'unknown' ELSE 'ks3' END AS dt
  FROM {lines} AS l0)
"""
SPARK_CELLS = """
SELECT o AS table_key, CAST(r AS INT) AS row, col,
  CASE col
    WHEN 0 THEN CASE WHEN k % 5 = 0 THEN '' WHEN k % 11 = 0 THEN concat('Раздел ', flag, ' item.') WHEN k % 29 = 0 THEN concat('Сведения о порядке учета приведены в пояснениях к отчету номер ', CAST(k AS VARCHAR(9)), '.') ELSE concat(flag, ' item ', CAST(k % 97 AS VARCHAR(9))) END
    WHEN 1 THEN CASE WHEN k % 7 = 0 OR k % 13 = 0 THEN '' ELSE CAST(1000 + k % 9000 AS VARCHAR(9)) END
    WHEN 2 THEN CASE WHEN k % 17 = 0 THEN '-' ELSE CAST(q AS VARCHAR(9)) END
    WHEN 3 THEN concat(CAST(CAST(floor(c / 100000) AS BIGINT) AS VARCHAR(9)), ' ', lpad(CAST(CAST(floor(c / 100) AS BIGINT) % 1000 AS VARCHAR(9)), 3, '0'), ',', lpad(CAST(c % 100 AS VARCHAR(9)), 2, '0'))
    WHEN 4 THEN CASE WHEN k % 3 = 0 THEN '' ELSE status END
    ELSE CASE WHEN k % 4 = 0 THEN 'Х' WHEN k % 4 = 1 THEN '(12,5)' WHEN k % 4 = 2 THEN ' ' ELSE '2024' END
  END AS text,
  CASE WHEN col = 2 AND k % 19 = 0 THEN 2 ELSE 1 END AS rowspan, CASE WHEN col = 0 AND k % 7 = 0 THEN 2 ELSE 1 END AS colspan, col = 1 AND k % 7 = 0 AS covered,
  col * 50.0 AS x0, col * 50.0 + 40.0 + r % 3 AS x1, r * 12.0 AS top, r * 12.0 + 10.0 AS bottom, dt AS doc_type
FROM b LATERAL VIEW explode(array(0, 1, 2, 3, 4, 5)) AS col
"""
SPARK_FORM_BASE = """
fb AS (
  SELECT tk, CAST(rn AS INT) AS r, k, q, c, CAST(tk % 8 AS INT) AS kind, n FROM (
    SELECT tk, k, q, c, row_number() OVER (PARTITION BY tk ORDER BY l_orderkey, l_linenumber, k, l_suppkey, l_extendedprice, l_quantity) - 1 AS rn, count(*) OVER (PARTITION BY tk) AS n
    FROM {lines} AS l0) AS f0)
"""
FORM_COLUMNS = "CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) AS cc(col)"
TABLES = ("lineitem", "orders", "events", "documents", "pages", "customer", "part", "supplier", "nation", "region", "conversations")


SOURCES = re.compile(r"\b(FROM|JOIN) (lineitem|orders|events|documents|pages|customer|part|conversations)\b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def relation(spark: SparkSession, sf_dir: str, sql: str, **more: DataFrame) -> DataFrame:
    """A query over the folder's tables, and over relations given by name as ``{name}``; no view of the session is touched."""
    names = {m[2] for m in SOURCES.finditer(sql)}
    return spark.sql(SOURCES.sub(r"\1 {\2}", sql), **{n: table(spark, sf_dir, n) for n in names}, **more)


def exploded(df: DataFrame) -> DataFrame:
    """Rows that were made several of: Spark estimates them by the files they come from, so joins are told not to send them through the driver."""
    return df.hint("merge")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by keys to as many tasks as the session names: by their size Spark would join these to few, whose cells and words then don't fit its memory."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by order (o), the one shuffle of all work on their cells."""
    return dealt(relation(spark, sf_dir, "SELECT l_orderkey AS o, l_partkey AS k, l_returnflag AS flag, l_linestatus AS status, CAST(floor(l_quantity) AS BIGINT) AS q, CAST(floor(l_extendedprice) AS BIGINT) AS c, l_linenumber, l_suppkey, l_extendedprice, l_quantity FROM lineitem"), "o")


def form_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by form (tk)."""
    return dealt(relation(spark, sf_dir, "SELECT CAST(floor(l_orderkey / 4) AS BIGINT) AS tk, l_partkey AS k, CAST(floor(l_quantity) AS BIGINT) AS q, CAST(floor(l_extendedprice) AS BIGINT) AS c, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity FROM lineitem"), "tk")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploded(relation(spark, sf_dir, f"WITH {SPARK_BASE} {SPARK_CELLS}", lines=line_items(spark, sf_dir)))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 100.0 divides in doubles in DuckDB, but in decimals here: gaps of just the tolerance would fall on different sides
    return relation(spark, sf_dir, POINTS.replace("100.0", "100.0D"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, BOXES).selectExpr("page", "table_id", "named_struct('x0', cast(bx0 AS double), 'top', cast(btop AS double), 'x1', cast(bx1 AS double), 'bottom', cast(bbottom AS double)) AS bbox")


def form_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, PAGES)


def words(spark: SparkSession, sf_dir: str, key: str = "doc_id", docs: DataFrame | None = None) -> DataFrame:
    """Every document as positioned words: 6 points a character, 12 a line. docs: documents by another key, which words keep, so that they stay where those were dealt to."""
    return relation(
        spark, sf_dir,
        f"""
        SELECT {key}, source, line_no, word_no, text, CAST(6 * at AS DOUBLE) AS x0, CAST(6 * (at + length(text)) AS DOUBLE) AS x1,
          CAST(12 * line_no AS DOUBLE) AS top, CAST(12 * line_no + 10 AS DOUBLE) AS bottom, 10.0D AS size, line_no * 1000000L + word_no AS word_id
        FROM (
          SELECT *, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY {key}, line_no ORDER BY word_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at
          FROM (SELECT {key}, source, line_no, posexplode(split(line, ' ')) AS (word_no, text) FROM (SELECT {key}, source, posexplode(split(text, '\\n')) AS (line_no, line) FROM {"documents" if docs is None else "{docs}"})))
        WHERE text <> ''
        """,
        **({} if docs is None else {"docs": docs}),
    )


def form_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploded(relation(spark, sf_dir, f"WITH {SPARK_FORM_BASE} {FORM_CELLS}".replace(FORM_COLUMNS, "LATERAL VIEW explode(array(0, 1, 2, 3, 4, 5)) AS col"), lines=form_items(spark, sf_dir)))


def form_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = form_cells(spark, sf_dir).selectExpr("table_key", "row", "col", "posexplode(split(text, ' ')) AS (place, text)")
    # whole numbers of points: in doubles they are exact, and far cheaper than decimals
    return relation(spark, sf_dir, re.sub(r"(\d+\.0)", r"\1D", FORM_WORDS), words=words)


WORDS_SQL = """
l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
w0 AS (SELECT doc_id, source, line_no, unnest(string_split(line, ' ')) AS text, generate_subscripts(string_split(line, ' '), 1) - 1 AS word_no FROM l),
w1 AS (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id, line_no ORDER BY word_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM w0),
words AS (SELECT doc_id, source, line_no, text, CAST(6 * off AS DOUBLE) AS x0, CAST(6 * (off + length(text)) AS DOUBLE) AS x1, CAST(12 * line_no AS DOUBLE) AS top, 10.0 AS size, line_no * 1000000 + word_no AS word_id FROM w1 WHERE text <> '')
"""
CELLS_SQL = f"{BASE}, cells AS ({CELLS})"
POINTS_SQL = f"words AS ({POINTS})"
BOXES_SQL = f"boxes AS ({BOXES})"
PAGES_SQL = f"pg AS ({PAGES})"
FORMS_SQL = f"{FORM_BASE}, forms AS ({FORM_CELLS})"
FORM_WORDS_SQL = f"{FORMS_SQL}, fw AS (SELECT table_key, row, col, unnest(string_split(text, ' ')) AS text, generate_subscripts(string_split(text, ' '), 1) - 1 AS place FROM forms), words AS ({FORM_WORDS.format(words='fw')})"
