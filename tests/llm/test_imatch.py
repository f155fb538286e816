import hashlib
import random
from collections import Counter

import numpy as np

from gridloom.llm.imatch import Band, Fingerprints, compare_with_next, lexicon


def corpus(n=300):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    rows = [(i * 7 - 50, " ".join(rng.choice(words[: rng.choice([20, 200, 2000])]) for _ in range(rng.choice([0, 1, 30, 80])))) for i in range(n)]
    return [*rows, (5000, rows[3][1]), (5001, None), (5002, "é" * 999)]


MASK = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def plain_print(text, hashes, terms, band):
    """The fingerprint of a text by plain sets; hashes: of every word."""
    own = sorted({hashes[w] for w in text.split()})
    kept = [x for x in own if x in terms] or own
    packed = lambda xs: b"".join(x.to_bytes(8, "little") for x in xs)
    out = [("i" if own and set(own) & terms else "t") + hashlib.blake2b(packed(kept), digest_size=8).hexdigest()]
    last = lambda x, j: 31 - (plain_mix(x ^ plain_mix(band.seed * 1000 + j)) >> 33 | 1).bit_length()
    sets = {r: {j: s for j in range(band.subsets) if (s := [x for x in kept if last(x, j) >= r])} for r in range(1, 40)}
    if kept:
        first = min(r for r in sets if 2 * len(sets[r]) <= band.subsets)
        for r in range(first, first + band.rates):
            out.append(f"{r}:" + ",".join(f"{j}={hashlib.blake2b(packed(s), digest_size=4).hexdigest()}" for j, s in sorted(sets[r].items())))
    return "/".join(out)


def test_fingerprints_by_plain_sets(spark):
    from gridloom.llm import kernels as K

    rows, band = corpus(), Band(0.02, 0.5)
    texts = [t or "" for _, t in rows]
    counts = Counter(w for t in texts for w in set(t.split()))
    words = sorted(counts)
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = K.words(data, np.array([0, len(data)]))
    hashes = {w: int(h) for w, h in zip(words, K.word_hashes(data, starts, ends), strict=True)}
    terms = {hashes[w] for w, n in counts.items() if 0.02 * len(rows) <= n <= 0.5 * len(rows)}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.fingerprint for r in compare_with_next(df, band).collect()}
    assert found == {i: plain_print(t, hashes, terms, band) for (i, _), t in zip(rows, texts, strict=True)}


def test_likeness_follows_what_is_shared():
    rng = random.Random(2)
    prints = Fingerprints(np.zeros(0, np.uint64), Band())
    for share, low, high in ((1.0, 1.0, 1.0), (0.9, 0.7, 0.95), (0.5, 0.2, 0.5), (0.0, 0.0, 0.02)):
        near = []
        for size in (20, 200, 2000):
            for _ in range(20):
                one = [rng.random() for _ in range(size)]
                other = one[: int(share * size)] + [rng.random() for _ in range(size - int(share * size))]
                a, b = prints.of([" ".join(map(str, one)), " ".join(map(str, other))])
                near.append(Fingerprints.likeness(a, b))
        assert low <= sum(near) / len(near) <= high


def test_a_doc_id_of_very_many_rows_takes_several_tasks(spark):
    rows = [(7, f"a{i} b{i % 5} c") for i in range(400)] + [(i, f"x{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = compare_with_next(df)
    assert found.count() == len(rows)
    sizes = [len(x) for x in found.rdd.glom().collect()]
    assert max(sizes) < 200


def test_against_plain_lists(spark):
    rows, band = corpus(), Band(0.02, 0.5)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, part string").repartition(5)
    terms = lexicon(df, band)
    counts = Counter(w for _, t in rows for w in set((t or "").split()))
    assert len(terms) == sum(0.02 * len(rows) <= n <= 0.5 * len(rows) for n in counts.values())
    prints = Fingerprints(terms, band)
    want = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, after = t or "", after or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = prints.of([t, edited, after])
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, prints.likeness(a, b), prints.likeness(a, c)))
    got = [tuple(r) for r in compare_with_next(df, band).collect()]
    assert sorted(got) == sorted(want)
    assert sum(r[5] for r in want) > 2 * sum(r[6] for r in want)


def test_partitions_with_many_documents(spark):
    rows = [(i, " ".join(f"t{i % m}" for m in (2, 30, 700, 4000))) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    counts = Counter(w for _, t in rows for w in set(t.split()))
    assert len(lexicon(df, Band(0.01, 0.4))) == sum(40 <= n <= 1600 for n in counts.values())


def test_edges(spark):
    schema = "doc_id long, text string"
    assert compare_with_next(spark.createDataFrame([], schema)).count() == 0
    one = compare_with_next(spark.createDataFrame([(4, "a b")], schema)).collect()
    assert [(r.doc_id, r.n_chars, r.near_next) for r in one] == [(4, 3, 1.0)]
    assert one[0].edited_sha256 == hashlib.sha256(b"a a").hexdigest()
    same = compare_with_next(spark.createDataFrame([(None, "x"), (1, None), (1, None)], schema)).collect()
    assert sorted(r.n_chars for r in same) == [0, 0, 1] and len({r.fingerprint for r in same if not r.n_chars}) == 1
    assert np.zeros(0, np.uint64).tolist() == lexicon(spark.createDataFrame([(1, "")], schema), Band()).tolist()
