import random

import corpus_pipeline
from gridloom.llm import packing


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    good = [(i, text(60)) for i in range(60)]
    bad = [(100 + i, text(60).upper().replace(" ", "!! ")) for i in range(30)]
    near = [(200, good[0][1] + " more"), (201, good[1][1])]
    secret = [(300, text(50) + " token = abcdefgh12 " + text(5))]
    rows = good + bad + near + secret
    folder = f"file://{tmp_path}"
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good[:40] + bad[:20]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, sizes = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
    kept = {r.doc_id: r for r in docs.collect()}
    assert set(kept) == {i for i, _ in good + secret} and sizes == [63, 61, 61]
    assert "[SECRET]" in kept[300].text and "abcdefgh12" not in kept[300].text and kept[300].n_chars == len(kept[300].text)
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in pieces} == set(kept)
    import public_tokenizers

    encoder = packing.Encoder.of(public_tokenizers.path("word_bpe_49k.json"))
    for r in pieces:
        assert r.doc_tokens == len(encoder.encode([kept[r.doc_id].text.encode()])[0]) // 4 + 1


def test_nulls_no_labels_and_no_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "a b c d e f", "en", "s", 11), (2, "", "en", None, 0), (3, "a b c d e f", "en", "s", 11), (3, "quite another text of some words", "en", "s", 32), (4, "a b c d e f", "en", "s", 11), (4, "a b c d e f", "en", "s", 11)]
    for name, some in (("some", rows), ("none", [])):
        folder = f"file://{tmp_path}/{name}"
        spark.createDataFrame(some, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        pieces = corpus_pipeline.run(spark, folder).collect()
        whole = sorted((r.doc_id or 0, r.doc_tokens) for r in pieces)
        # equal texts are one row; null and empty texts are linked with nothing, and unlike texts of one doc_id both stay
        assert [i for i, _ in whole] == ([0, 1, 2, 3, 4] if some else [])
