"""Quality classifier: supervised embeddings of words and character n-grams.

Words and character n-grams (within words, with their edges) are hashed to learned vectors; a document is
the mean of its vectors, and a softmax layer over it gives the classes. Training is stochastic gradient
descent in numpy, on a bounded sample of labelled rows (``most`` of each class, by a hash of the doc_id).
Scoring folds vectors and output layer into one number a class for each hash, so a text costs one lookup
for each of its n-grams, whatever the vectors' size.

Edge cases: a null or empty text has no features and scores by the bias alone. Labels that are null are
ignored; a doc_id with several labels gives a training row for each, one with several texts is learned from
one of them. Rows with a null doc_id are scored, and not held out. Without any labels every score is 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, text_of
from .kernels import U, mix


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 8
    grams: tuple[int, ...] = (3, 4)
    epochs: int = 4
    rate: float = 0.5
    #: Labelled rows of each class that training takes at most.
    most: int = 1500
    seed: int = 7


@dataclass
class Model:
    """Folded weights: for each hash its share in class 1's log-odds, and the bias."""

    settings: Settings
    table: np.ndarray
    bias: float
    vectors: np.ndarray = field(repr=False, default=None)


_SPACE = np.zeros(0x3002, bool)
_SPACE[[i for i in range(0x3001) if chr(i).isspace()]] = True
ODD = U(0x9E3779B97F4A7C15)


def features(texts: list[str], how: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashes below how.buckets of all words and n-grams of whole texts, with repeats, and the text of each.

    A word that repeats the one before it has one more feature, the same for all such words.
    """
    shift = U(64 - how.buckets.bit_length() + 1)
    x = np.frombuffer(f" {' '.join(texts)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _SPACE[np.minimum(x, 0x3001)]
    x = np.where(space, 32, x).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in texts])
    out, owners = [], []
    with np.errstate(over="ignore"):
        rolled, inside = x, ~space[1:-1]
        kept = inside
        for n in range(2, max(how.grams) + 1):
            rolled = rolled[:-1] * U(0x100000001B3) + x[n - 1 :]
            if n > 2:  # no space but at the ends
                kept = (kept if n == 3 else kept[:-1]) & inside[n - 3 :]
            if n in how.grams:
                at = np.flatnonzero(kept[: len(rolled)] if n > 2 else np.ones(len(rolled), bool))
                out.append((rolled[at] + U(n)) * ODD >> shift)
                owners.append(owner[at])
        starts, ends = np.flatnonzero(~space[1:] & space[:-1]) + 1, np.flatnonzero(space[1:] & ~space[:-1]) + 1
        if len(starts):
            place = np.arange(len(x)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(x)]])))
            spread = mix(x + place.astype(np.uint64) * ODD)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
            words = mix(total[ends] - total[starts])
            again = np.flatnonzero((words[1:] == words[:-1]) & (owner[starts[1:]] == owner[starts[:-1]])) + 1
            out += [words >> shift, np.zeros(len(again), np.uint64)]
            owners += [owner[starts], owner[starts[again]]]
    return np.concatenate(out).astype(np.int64), np.concatenate(owners)


def train(rows: list[tuple[str, int]], how: Settings = Settings()) -> Model:
    """Fit on (text, class 0 or 1) rows; classes weigh alike."""
    rng = np.random.default_rng(how.seed)
    vectors = rng.uniform(-1 / how.dim, 1 / how.dim, (how.buckets, how.dim)).astype(np.float32)
    out, bias = np.zeros((how.dim, 2), np.float32), np.zeros(2, np.float32)
    bags = [(*np.unique(features([t], how)[0], return_counts=True), y) for t, y in rows]
    sizes = np.bincount([y for _, y in rows], minlength=2)
    weight = len(rows) / np.maximum(2 * sizes, 1)
    steps, done = how.epochs * len(bags), 0
    for _ in range(how.epochs):
        for i in rng.permutation(len(bags)):
            ids, counts, y = bags[i]
            rate, done = how.rate * (1 - done / steps), done + 1
            share = (counts / max(counts.sum(), 1)).astype(np.float32)
            hidden = share @ vectors[ids] if len(ids) else np.zeros(how.dim, np.float32)
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            step = np.float32(rate * weight[y]) * p
            back = out @ step
            out -= np.outer(hidden, step)
            bias -= 0.1 * step
            if len(ids):
                vectors[ids] -= np.sqrt(share)[:, None] * back[None, :]
    difference = out[:, 1] - out[:, 0]
    return Model(how, (vectors @ difference).astype(np.float32), float(bias[1] - bias[0]), vectors)


def score(texts: list[str], model: Model) -> np.ndarray:
    """The probability of class 1 for each whole text."""
    ids, owners = features(texts, model.settings)
    counts = np.bincount(owners, minlength=len(texts))
    z = model.bias + np.bincount(owners, model.table[ids], len(texts)) / np.maximum(counts, 1)
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def score_long(text: str, model: Model, size: int = 1 << 18) -> float:
    """score of one text, in pieces of about size characters that end at white space."""
    total = count = at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and not text[end].isspace():
            end += 1
        ids, _ = features([text[at:end]], model.settings)
        total, count, at = total + float(model.table[ids].sum(dtype=np.float64)), count + len(ids), end
    return float(1 / (1 + np.exp(-np.clip(model.bias + total / max(count, 1), -700, 700))))


def score_all(texts: list[str], model: Model, size: int = 1 << 16) -> np.ndarray:
    """score, in runs of about size characters; what is over 4 * size alone, in pieces."""
    out, run, n = [], [], 0
    for t in [*texts, None]:
        if run and (t is None or n >= size or len(t) > 4 * size):
            out.append(score(run, model))
            run, n = [], 0
        if t is not None and len(t) > 4 * size:
            out.append(np.array([score_long(t, model, 4 * size)]))
        elif t is not None:
            run.append(t)
            n += len(t)
    return np.concatenate([np.zeros(0), *out])


def sample(documents: DataFrame, labels: DataFrame, how: Settings) -> list[tuple[str, int]]:
    """At most how.most rows of each class, chosen by a hash of the doc_id."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_quality")).where(F.crc32(F.col("_id").cast("string").cast("binary")) % 5 != 0)
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("_quality") == y).orderBy(F.xxhash64("_id"), "_id").limit(how.most)
        chosen = part if chosen is None else chosen.union(part)
    picked = chosen.collect()
    if not picked:
        return []
    small = documents.sparkSession.createDataFrame([(r["_id"], r["_quality"]) for r in picked], chosen.schema)
    own = F.coalesce("text", F.lit(""))
    found = documents.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(small), "_id").groupBy("_id", "_quality").agg(F.min_by(own, F.xxhash64(own)).alias("text")).collect()
    return [(r["text"], r["_quality"]) for r in sorted(found, key=lambda r: (str(r["_id"]), r["_quality"]))]


def fit(documents: DataFrame, labels: DataFrame, how: Settings = Settings()) -> Model:
    return train(sample(documents, labels, how), how)


def add_score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """documents with one more column, the probability of class 1; it replaces one of that name."""
    documents = documents.drop(name)
    shared = documents.sparkSession.sparkContext.broadcast((model.settings, model.table, model.bias))

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            scores = score_all(text_of(batch, "text").to_pylist(), own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    from pyspark.sql.types import DoubleType, StructType

    return documents.mapInArrow(run, StructType([*documents.schema.fields]).add(name, DoubleType()))


def op3_quality_classifier(spark, sf_dir):
    """Score every document; labels of held-out rows are never seen."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, read(spark, sf_dir, "labels"))
    scored = add_score(documents, model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of documents whose score reaches the threshold."""
    score = "score" + "_" * max(map(len, documents.columns))
    return add_score(documents, fit(documents, labels), score).where(F.col(score) >= threshold).drop(score)
