import random
import re
from collections import Counter

import numpy as np

from gridloom.llm.divergence import Audit, audit_sources, frequencies

WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    held, counts, groups = Counter(), {}, {}
    for text, lang, source in rows:
        words = WORD.findall(text.translate(LOWER))
        held.update((lang, w) for w in set(words))
        counts.setdefault((lang, source), Counter()).update(words)
        groups.setdefault(lang, set()).add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [w for (a, w), n in held.items() if a == lang and n >= least]
        whole = Counter()
        for s in sources:
            whole.update({w: counts[lang, s][w] for w in kept})

        def p(c, kept=kept):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 5) // (n + 5 * len(kept)) for w in kept}

        of, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pairs = sorted((-sum(abs(of[s][w] - of[o][w]) for w in kept), o.encode()) for o in sources if o != s)
            terms = sorted((q[w] - of[s][w], w.encode()) for w in kept if counts[lang, s][w] and of[s][w] > q[w])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, o.decode(), -v, i) for i, (v, o) in enumerate(found, 1)}
    return out


def documents(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x", 1, "y") for r in rows], "text string, lang string, source string, slot int, term string, i int, part string")
    return df.repartition(3)


def test_against_plain_counting(spark):
    rng = random.Random(4)
    words = ["the", "THE", "Été", "été", "漢字", "a1b", "don't", "x-y", "🙂", "zz", "ß"] + [f"w{'abcdefghij'[i % 10]}{'klmno'[i % 5]}" for i in range(40)]
    rows = []
    for _ in range(260):
        lang, source = rng.choice(["en", "en", "en", "de", None, "thin"]), rng.choice([None, "", "hot", "hot", "hot", *[f"s{i}" for i in range(9)]])
        if lang == "thin":
            source = rng.choice(["u", "v", "wé"])
        text = " ".join(rng.choice(words[: rng.choice([6, 30, 60])]) for _ in range(rng.choice([0, 1, 9, 60])))
        rows.append((text if rng.random() > 0.05 else None, lang, source))
    rows += [rows[0]] * 5 + [("", "alone", "one"), ("123 456 !", "bare", "p"), (None, "bare", "q"), ("the " * 30_000 + "zz", "en", "s1")]
    for how in (Audit(least=8, top=5, block=2, chunk=4, chunks=2), Audit(least=3), Audit(least=1000)):
        got = audit_sources(documents(spark, rows), how)
        found = [tuple(r) for r in got.collect()]
        assert len(found) == len(set(found))
        assert set(found) == plain(rows, how.least, how.top)


def test_empty_and_exact(spark):
    assert audit_sources(spark.createDataFrame([], "text string, lang string, source string")).collect() == []
    rng = random.Random(1)
    counts = [rng.randrange(10**15) for _ in range(50)] + [0, 1]
    total, terms = sum(counts) // 16, 52
    counts = [c // 16 for c in counts]
    assert frequencies(np.array(counts), np.array([total]), terms).tolist() == [1 + 10**9 * (c + 5) // (total + 5 * terms) for c in counts]
