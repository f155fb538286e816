import random

from gridloom.llm.quality import Settings, add_score, fit, keep_good, score, train


def corpus(n=240):
    rng = random.Random(6)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "r", "st", "")]
    rows = []
    for i in range(n):
        good = i % 3 > 0
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 80)))
        if not good:
            text = text.upper() + "!!" if i % 2 else " ".join(w + rng.choice(["%%%", "###"]) for w in text.split())
        rows.append((i, text, int(good)))
    return rows


def test_learns_from_a_sample(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (901, "", "x"), (None, "dan ber", "x")], "doc_id long, text string, _score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i < 160] + [(3, None), (None, 1)], "doc_id long, quality int")
    model = fit(docs.drop("_score"), labels, Settings(most=60))
    got = {r.doc_id: r.score for r in add_score(docs, model).collect()}
    assert len(got) == len(rows) + 3 and got[900] == got[901] and all(0 <= s <= 1 for s in got.values())
    assert sum((got[i] >= 0.3) == bool(q) for i, _, q in rows if i >= 160) >= 78
    kept = {r.doc_id for r in keep_good(docs.drop("_score"), labels).collect()}
    assert {i for i, _, q in rows if q} <= kept


def test_long_texts_and_no_labels(spark):
    model = train([("good words here", 1), ("BAD!! BAD!!", 0)])
    assert score(["good words " * 20_000, "x", "", "🙂   é"], model).shape == (4,)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert add_score(empty, model).count() == 0
    none = fit(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert score(["a"], none).tolist() == [0.5]


def test_pieces_of_a_long_text():
    import numpy as np

    from gridloom.llm.quality import score_all

    rows = corpus(60)
    model = train([(t, q) for _, t, q in rows])
    long = " ".join(t + f" x{i}" for i, (_, t, _) in enumerate(rows * 3))
    texts = [rows[0][1], long, "", "y" * 9000, rows[1][1]]
    assert np.allclose(score_all(texts, model, 500), score(texts, model), atol=2e-3) and np.allclose(score_all(texts, model), score(texts, model))


def test_query_on_a_folder(spark, tmp_path):
    import zlib

    from gridloom.llm.quality import op3_quality_classifier

    rows, folder = corpus(), f"file://{tmp_path}"
    docs = [(i, t) for i, t, _ in rows] + [(5, rows[5][1]), (5, "another text"), (700, None), (None, "dan ber")]
    spark.createDataFrame([(i, t, "en", 1.0) for i, t in docs], "doc_id long, text string, lang string, score double").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, q) for i, _, q in rows] + [(3, None), (None, 1), (99_999, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    got = op3_quality_classifier(spark, folder).collect()
    assert got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"} and len(got) == len(docs)
    truth = {i: q for i, _, q in rows}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 30 and sum(r.predicted == truth[r.doc_id] for r in held) > 0.93 * len(held)


def test_doc_ids_of_text(spark):
    rows = corpus(60)
    docs = spark.createDataFrame([(f"d{i}", t) for i, t, _ in rows], "doc_id string, text string")
    assert len(keep_good(docs, spark.createDataFrame([(f"d{i}", q) for i, _, q in rows], "doc_id string, quality int")).collect()) >= 40


def plain_score(text, model):
    """The score by loops over the characters."""
    from gridloom.llm.quality import ODD

    wide = (1 << 64) - 1

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & wide
        x = (x ^ x >> 27) * 0x94D049BB133111EB & wide
        return x ^ x >> 31

    odd, shift, ids = int(ODD), 64 - model.settings.buckets.bit_length() + 1, []
    x = [32, *(32 if c.isspace() else ord(c) for c in text), 32]
    for n in model.settings.grams:
        for i in range(len(x) - n + 1):
            if 32 not in x[i + 1 : i + n - 1]:
                r = x[i]
                for c in x[i + 1 : i + n]:
                    r = (r * 0x100000001B3 + c) & wide
                ids.append(((r + n) * odd & wide) >> shift)
    last = None
    for word in text.split():
        h = mixed(sum(mixed((ord(c) + i * odd) & wide) for i, c in enumerate(word)) & wide)
        ids += [h >> shift] + [0] * (h == last)
        last = h
    z = model.bias + sum(float(model.table[i]) for i in ids) / max(len(ids), 1)
    return 1 / (1 + 2.718281828459045**-z)


def test_scores_like_plain_loops():
    from gridloom.llm.quality import score_all, train

    rows = [("good words in a row " * 3, 1), ("spam spam spam buy buy", 0), ("été 漢字 and more", 1), ("xx xx xx xx", 0)] * 5
    model = train(rows)
    texts = ["", " ", "a", "good spam", "spam spam\tspam\n été", "one two  two 漢字 漢字", *[t for t, _ in rows[:4]]]
    for t, s in zip(texts, score_all(texts, model), strict=True):
        assert abs(s - plain_score(t, model)) < 1e-6, t
