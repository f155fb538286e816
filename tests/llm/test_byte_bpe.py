import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest

from gridloom.llm.byte_bpe import Codec, add_digests, decode, encode

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def texts():
    rng = random.Random(3)
    parts = ["word", " word", "  ", "\n\n ", "'s", "'ll ", "12345", "!!!", " ###", "é", "日本", "🙂", " ", "ſ", "\x00", "<|endoftext|>"]
    return [None, "", " ", "a" * 900, " " * 700 + "x", *["".join(rng.choice(parts) for _ in range(rng.choice([3, 40, 900]))) for _ in range(60)]]


@pytest.mark.parametrize(("chunk", "overlap"), [(100, 20), (64, 64), (1 << 16, 1 << 10)])
def test_same_ids_as_whole_texts(spark, chunk, overlap):
    codec, all_texts = Codec.of(PATH, P.PATTERN), texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(all_texts)], "doc_id long, text string, ids string").repartition(3)
    rows = add_digests(decode(encode(df, PATH, P.PATTERN, chunk=chunk, overlap=overlap), PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(all_texts)))
    for r in rows:
        want = codec.encode(all_texts[r.doc_id] or "")
        assert np.frombuffer(r.ids, np.uint32).tolist() == want and r.n_tokens == len(want)
        assert bytes(r.bytes).decode() == (all_texts[r.doc_id] or "")
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((all_texts[r.doc_id] or "").encode()).hexdigest()


def test_repeated_rows_and_lost_ids(spark):
    text = "word and more " * 60
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, "x"), (2, "y")], "doc_id long, text string").repartition(2)
    rows = encode(df, PATH, P.PATTERN, chunk=100, overlap=30).collect()
    want = Codec.of(PATH, P.PATTERN).encode
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == sorted((i, len(want(t))) for i, t in [(1, text), (1, text), (0, text), (0, "x"), (2, "y")])


def test_cutting_is_linear():
    import time

    from gridloom.llm.byte_bpe import _cut

    class Task:
        partitionId = staticmethod(lambda: 0)

    import pyarrow as pa
    import pyspark

    took, before = [], pyspark.TaskContext.get
    pyspark.TaskContext.get = staticmethod(lambda: Task)
    try:
        for n in (1_000_000, 8_000_000):
            batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["ab c" * (n // 4)])], ["doc_id", "text"])
            began = time.time()
            assert sum(b.num_rows for b in _cut(1 << 12, 100)([batch])) == -(-n // (1 << 12))
            took.append(time.time() - began)
    finally:
        pyspark.TaskContext.get = before
    assert took[1] < 30 * took[0] + 0.5


def test_empty(spark):
    assert encode(spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN).count() == 0
