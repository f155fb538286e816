import random
import re

import pytest

from gridloom.llm.jaccard_join import Similarity, drop_near_copies, link_classes


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, (i, x) in enumerate(sets):
        for j, y in sets[n + 1 :]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return sorted((i, len(x), find(i)) for i, x in sets)


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(n):
        kind = rng.random()
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 12, 40, 120]))]
        if kind < 0.3:
            words = passage + words[:12]
        if kind > 0.5 and rows:
            words = list(rng.choice(rows)[1].split(" "))
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i * 3, " ".join(words)))
    return rows


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 3, 90), (2, 5, 80)])
def test_same_classes_as_all_pairs(spark, seed, k, percent):
    rows = corpus(seed)
    assert got(link_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), Similarity(k, percent))) == brute(rows, k, percent)


@pytest.mark.parametrize(("k", "percent", "n"), [(5, 80, 8)])
def test_the_smallest_sets_that_link_with_a_superset(spark, k, percent, n):
    rng = random.Random(n)
    rows = []
    for i in range(0, 60, 6):
        words = [f"w{rng.randrange(10_000)}" for _ in range(n)]
        # one word more at either end, a chain of both, and the next smaller set, which links with equal ones only
        for j, x in enumerate((words, [*words, "end"], ["start", *words], words[:-1], words)):
            rows.append((i + j, " ".join(x)))
    rng.shuffle(rows)
    rows.sort(key=lambda r: r[0] % 6)
    want = brute(sorted(rows), k, percent)
    assert [c for i, _, c in want if i < 5] == [0, 0, 0, 3, 0]
    assert got(link_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), Similarity(k, percent))) == want


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A b"), (6, "x y z " * 3000), (7, "x y z " * 3000), (9, "é b c d"), (9, "é b c d")]
    df = spark.createDataFrame([(*r, "u") for r in rows], "doc_id long, text string, component_id string")
    assert got(link_classes(df, Similarity(3, 90))) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 3, 6), (7, 3, 6), (9, 1, 9), (9, 1, 9)]
    assert link_classes(df.limit(0), Similarity(3, 90)).count() == 0
    null = link_classes(spark.createDataFrame([(None, "a b c d")], "doc_id long, text string"), Similarity(3, 90)).collect()
    assert [tuple(r) for r in null] == [(None, 2, None)]
    assert sorted(r.doc_id for r in drop_near_copies(df).collect()) == [1, 2, 3, 4, 6, 9]


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (1, 60)])
def test_nested_sets_of_every_size(spark, k, percent):
    rng = random.Random(percent)
    rows = []
    for n in range(1, 41):
        words = [f"{n}w{i}" for i in range(n + k + 11)]
        for more in (0, 1, 2, 4, 10):
            rows.append((len(rows), " ".join(words[: n + k - 1 + more])))
        rows.append((len(rows), " ".join(words[3 : n + k - 1])))
    order = list(range(len(rows)))
    rng.shuffle(order)
    rows = sorted((i, t) for i, (_, t) in zip(order, rows, strict=True))
    assert got(link_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), Similarity(k, percent))) == brute(rows, k, percent)


def test_many_copies_over_many_tasks(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words if i % 3 else [*words, f"x{i}"])) for i in range(400)] + [(1000 + i, "w1 w2 w3 " + " ".join(f"{i}y{j}" for j in range(20))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(link_classes(df, Similarity(5, 80))) == brute(rows, 5, 80)
    assert sorted(r.doc_id for r in drop_near_copies(df).collect()) == [0, *range(1000, 1050)]


def test_unlike_texts_of_one_doc_id(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(1, one), (1, two), (2, two), (3, three), (3, three), (4, one + " more"), (5, None), (5, ""), (None, one)]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, _node int").repartition(3)
    classes = {(r.doc_id, r.component_id) for r in link_classes(df, Similarity(5, 80)).collect()}
    assert classes == {(1, 1), (2, 1), (3, 3), (4, 1), (5, 5), (None, None)}
    found = drop_near_copies(df).collect()
    assert all(rows[r._node] == (r.doc_id, r.text) for r in found)
    kept = sorted(((r.doc_id or 0), r.text or "") for r in found)
    assert kept == sorted([(2, two), (3, three), (4, one + " more"), (5, ""), (0, one)])
