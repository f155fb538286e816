import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridloom.llm.packing import Encoder, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def direct(texts):
    model = Tokenizer.from_file(PATH)
    model.encode_special_tokens = True
    return [np.array(e.ids, np.uint32) for e in model.encode_batch(texts, add_special_tokens=False)]


ODD = ["", " ", "It's 42 o'clock, don't!\x0b\x1c\x85 a b  x", "é ́e Å ſK", "<|endoftext|> a<|startoftext|>b", "a \x01 b\x01c", "x" * 5000, "!?" * 900, "日本語 テスト 🙂👍🏽", "ΟΔΟΣ İstanbul ß"]


def test_pieces_have_the_same_ids():
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab C.é'1\n\t$漢́") for _ in range(rng.randrange(200))) for _ in range(300)]
    got = Encoder(PATH).encode([t.encode() for t in texts])
    assert [g == w.tobytes() for g, w in zip(got, direct(texts))] == [True] * len(texts)


@pytest.mark.parametrize("parts", [1, 7])
def test_every_id_lies_in_one_piece(spark, parts):
    rng = random.Random(parts)
    texts = [None, *ODD, *[" ".join(rng.choice(["alpha", "beta", "x1"]) for _ in range(rng.choice([0, 3, 50, 700, 9000]))) for _ in range(90)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    rows = pack(df, PATH, windows=4, fan=2).collect()
    ids = [np.append(x, np.uint32(1)) for x in direct([t or "" for t in texts])]
    by_doc, by_sequence = {}, {}
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert (len(piece), zlib.crc32(piece.tobytes()), len(ids[r.doc_id])) == (r.length, r.ids_crc32, r.doc_tokens)
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found, whole in ((by_doc, len(texts)), (by_sequence, len(by_sequence))):
        assert len(found) == whole
        for pieces in found.values():
            at = 0
            for start, length in sorted(pieces):
                assert start == at and length > 0
                at += length
    assert all(sum(n for _, n in by_doc[i]) == len(x) for i, x in enumerate(ids))
    sizes = [sum(n for _, n in v) for v in by_sequence.values()]
    assert max(sizes) <= 2048 and sum(s < 2048 for s in sizes) <= 1


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_words_are_encoded_once_whatever_follows():
    encoder, given = Encoder(PATH), []
    ids = encoder._ids
    encoder._ids = lambda texts: given.extend(texts) or ids(texts)
    texts = ["zzqa, zzqa. zzqa?! zzqa ZZQA;", "zzqa: , zzq'a, é. 1, a.b,"]
    assert [g == w.tobytes() for g, w in zip(encoder.encode([t.encode() for t in texts]), direct(texts))] == [True] * 2
    assert " ".join(given).split().count("zzqa") == 1 and "zzqa" not in {x.rstrip(".,;:!?") for x in " ".join(given).split() if x != "zzqa"}
