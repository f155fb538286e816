"""Operators that keep other columns leave those alone that are named like their own."""

from gridloom.llm import jaccard_join, quality, secrets

NAMES = ("_spans", "_id", "_hash", "__node__", "__id__", "__hash__", "row", "cuts", "all", "text_hash", "start", "score", "_score", "a", "n", "node", "doc", "label")


def table(spark):
    rows = [(1, "one two three four five six", 5), (2, "one two three four five six", 6), (3, "a token = abcdefgh in seven words here", 7), (4, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, own long")
    return df.select("doc_id", "text", *[(df.own + i).alias(n) for i, n in enumerate(NAMES)])


def others(df):
    return sorted((r.doc_id, *[r[n] for n in NAMES]) for r in df.collect())


def test_redact(spark):
    docs = table(spark)
    got = secrets.redact(docs)
    assert got.columns == docs.columns and others(got) == others(docs)
    assert {r.doc_id: r.text for r in got.collect()}[3] == "a [SECRET] in seven words here"


def test_keep_good(spark):
    docs = table(spark)
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    got = quality.keep_good(docs, labels, 0.0)
    assert got.columns == docs.columns and others(got) == others(docs)


def test_drop_near_copies(spark):
    docs = table(spark)
    got = jaccard_join.drop_near_copies(docs)
    assert got.columns == docs.columns and others(got) == [r for r in others(docs) if r[0] != 2]
