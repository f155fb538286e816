import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from gridloom.llm.resampling import Resampling, _long_row, features, resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def of(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def plain(documents, target, how):
    k = how.buckets
    bucket = lambda f: zlib.crc32(f.encode()) % k
    s, t = Counter(), Counter()
    for _, text in documents:
        s.update(map(bucket, of(text)[1]))
    for text in target:
        t.update(map(bucket, of(text)[1]))
    a, b = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[i] + 1) * (a + k) / ((s[i] + 1) * (b + k)))) for i in range(k)]
    rows = []
    for i, text in documents:
        words, own = of(text)
        weight = sum(gain[bucket(f)] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= how.least])
    order = sorted((r for r in rows if r[-1]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = how.percent * len(order) // 100
    out = [(*r[:4], n if n <= drawn else None) for n, r in enumerate(order, 1)]
    return out + [(*r[:4], None) for r in rows if not r[-1]]


def texts():
    rng = random.Random(3)
    bits = ["the", "The", "été", "漢字", "a1", "x" * 70, "y" * 64, "z" * 65, "don't", "--", "1", "🙂", "\n", "I", "ß", "q" * 300]
    return [None, "", " . ", "one", "word " * 25, *[" ".join(rng.choice(bits) for _ in range(rng.choice([3, 20, 21, 60, 300]))) for _ in range(200)]]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_against_plain_counting(spark):
    rows = list(enumerate(texts()))
    rows += [(7, rows[7][1])] * 3 + [(None, rows[8][1]), (None, rows[8][1]), (50, "another text of the same number " * 9)]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, rank int, place int, score string").repartition(3)
    target = [rows[40][1], None, "", rows[41][1]]
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    for how in (Resampling(), Resampling(buckets=97, percent=60, least=1, seed=1), Resampling(percent=100), Resampling(percent=0)):
        got = [tuple(r) for r in resample(df, aim, how).select("doc_id", "n_features", "weight", "score", "rank").collect()]
        assert sorted(got, key=key) == sorted(plain(rows, target, how), key=key)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    rows = [(i, f"some words {i} " * 12) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert resample(none, df).collect() == []
    assert sorted((tuple(r) for r in resample(df, none).collect()), key=key) == sorted(plain(rows, [], Resampling()), key=key)


def test_long_texts_in_pieces():
    rng = random.Random(5)
    text = " ".join(rng.choice(["ab", "c" * 90, "é", "D-d", "\n\n", "77"]) for _ in range(4000)).encode()
    data = np.frombuffer(text, np.uint8)
    found, _, words, _ = features(data, np.array([0, len(data)]))
    want = np.bincount(found % 1000, minlength=1000)
    for piece in (1, 7, 100, 5000):
        counts, n = _long_row(data, 1000, piece)
        assert (counts == want).all() and n == words[0]
