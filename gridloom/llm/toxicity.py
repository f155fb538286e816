"""Toxicity: a convolutional text classifier over hashed words, with thresholds calibrated by language.

A text is the sequence of its words, runs of letters. Each word is looked up by its hash in a table of learned
vectors, and so are its first ``stem`` bytes, whose vector is added, or stands alone for words that are too rare;
filters of several widths run over the sequence, each filter's highest value in the whole text is kept,
and a softmax layer over those gives the classes. All is trained in numpy by gradient steps on every labelled row
that may be learned, one for each different text. A fifth of each class isn't trained on: it gives one shift of all
scores, so that 0.3 is where toxic and other documents part best, and a threshold for each language with enough toxic
rows there. The language is used for thresholds alone, never for a score.

Training runs in ``epochs`` rounds. The rows lie in as many parts; small tables have all parts in each round, larger
ones fewer, down to one (``turns``), so that every row is learned from equally often, once at least. In a round each
task steps through its own rows from the same model, some ``most`` rows, and the driver takes the mean of what they
give, one after the other. Words' document counts, bags of words' numbers and the scores of the fifth, as a histogram
of logits, come from Spark; the driver holds the known words and the model only.

Scoring is a product of a slice's word vectors with all filters, sums of shifted columns, and a maximum for each
text; a long text is taken in pieces that overlap by a filter's width.

Edge cases: a null or empty text, or one without words, is a sequence of padding. Labels that are null are
ignored; a doc_id with several labels gives a training row for each. Rows with a null doc_id are scored, and not
held out. A null or unknown language has the threshold of all. Without labels of both classes every score is 0.
An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from . import kernels as K
from .common import discard, each_batch, read, slices, spool, text_of

LETTERS = K.classes(0x3A)
#: Score at which a document counts as toxic.
CUT = 0.3
#: Slots of the table in which words are looked up.
SLOTS = 1 << 20
PIECE = 1 << 20
#: Bits of the map of wanted rows.
SPOTS = 1 << 26


@dataclass(frozen=True)
class Settings:
    dim: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 10
    rate: float = 0.1
    #: Share of a text's words that a training step doesn't see.
    blank: float = 0.5
    decay: float = 1e-3
    #: Rows that one task steps through in a round, about; more rows are more tasks.
    most: int = 2000
    #: Labelled texts that must hold a word for it to have a vector: this many, and one in ``share``.
    least: int = 3
    share: int = 400
    stem: int = 5
    seed: int = 11


@dataclass
class Model:
    settings: Settings
    #: Hashes of the known words and stems; their vectors, after one of zeros for all others. A word's has its stem's added.
    words: np.ndarray
    vectors: np.ndarray
    #: For each width an array (width, dim, filters) and a bias for each filter.
    kernels: list[np.ndarray]
    biases: np.ndarray
    out: np.ndarray
    base: float
    #: Added to every logit, and thresholds of languages.
    shift: float = 0.0
    thresholds: dict[str, float] | None = None


def word_hashes(data: np.ndarray, offsets: np.ndarray, stem: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each word of rows of bytes, A-Z lower-cased, of all of it and of its first bytes; and the number of words of each row."""
    starts, ends, first = K.words(data, offsets, LETTERS)
    own, stems = K.word_hashes(data, starts, ends), K.word_hashes(data, starts, np.minimum(ends, starts + stem))
    return np.stack([own, ~stems], axis=1), np.diff(first)


def hashes_of(text: str, stem: int) -> np.ndarray:
    """The hashes of one text's words, in pieces that end between words."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    out, at = [np.zeros((0, 2), np.uint64)], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not LETTERS[data[end]]:
            end += 1
        out.append(word_hashes(data[at:end], np.array([0, end - at]), stem)[0])
        at = end
    return np.concatenate(out)


class Lookup:
    """Numbers of known words from 1, 0 for others; of words whose hashes want one slot only the first is known."""

    def __init__(self, words: np.ndarray):
        self.keys, self.numbers = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32)
        at = self.slots(words)[::-1]
        self.keys[at], self.numbers[at] = words[::-1], np.arange(len(words), 0, -1)

    @staticmethod
    def slots(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> K.U(64 - SLOTS.bit_length() + 1)).astype(np.int64)

    def each(self, hashes: np.ndarray) -> np.ndarray:
        at = self.slots(hashes)
        return np.where(self.keys[at] == hashes, self.numbers[at], 0)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, or else of its stem."""
        out = self.each(hashes[:, 0])
        rare = np.flatnonzero(out == 0)
        out[rare] = self.each(hashes[rare, 1])
        return out


def _windows(x: np.ndarray, model: Model) -> list[np.ndarray]:
    """Of each width the filters' values at every place of x but the last widest - 1."""
    n = len(x) - max(model.settings.widths) + 1
    every = x @ np.concatenate([w for k in model.kernels for w in k], axis=1)
    f, out, at = model.settings.filters, [], 0
    for width in model.settings.widths:
        total = every[:n, at : at + f].copy()
        for i in range(1, width):
            total += every[i : i + n, at + i * f : at + (i + 1) * f]
        out.append(total)
        at += width * f
    return out


def _logits(pooled: np.ndarray, model: Model) -> np.ndarray:
    return np.maximum(pooled + model.biases, 0) @ model.out + model.base + model.shift


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -700, 700)))


def score_slice(hashes: np.ndarray, counts: np.ndarray, model: Model, lookup: Lookup) -> np.ndarray:
    """The probability of class 1 for each of the texts whose words' hashes lie one after the other."""
    if not len(model.words):
        return np.zeros(len(counts))
    pad = max(model.settings.widths)
    gap = 2 * pad - 1  # so that no window at one of a text's places, its words and pad more, reaches the next text
    begin = np.concatenate([[0], np.cumsum(counts + gap)])
    ids = np.zeros(begin[-1] + pad, np.int32)
    ids[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)) * gap, counts)] = lookup(hashes)
    values = np.concatenate(_windows(model.vectors[ids], model), axis=1)
    edges = np.stack([begin[:-1], begin[:-1] + counts + pad], axis=1).ravel()
    return _probability(_logits(np.maximum.reduceat(values, edges, axis=0)[::2], model))


def score_long(hashes: np.ndarray, model: Model, lookup: Lookup, size: int = 1 << 15) -> float:
    """score_slice for one text, in runs of size words."""
    if not len(model.words):
        return 0.0
    pad = max(model.settings.widths)
    best = None
    ids = np.concatenate([lookup(hashes), np.zeros(2 * pad - 1, np.int32)])
    for at in range(0, len(hashes) + pad, size):
        values = np.concatenate(_windows(model.vectors[ids[at : at + size + pad - 1]], model), axis=1)
        best = values.max(axis=0) if best is None else np.maximum(best, values.max(axis=0))
    return float(_probability(_logits(best[None, :], model))[0])


def _start(known: np.ndarray, how: Settings) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A model's arrays before any step (vectors, kernels, biases, out, base), and their gradients' sums of squares."""
    rng = np.random.default_rng(how.seed)
    f = how.filters
    draw = lambda *n: rng.normal(0, 1 / np.sqrt(how.dim), n).astype(np.float32)
    vectors = draw(len(known) + 1, how.dim)
    vectors[0] = 0
    kernels = [draw(w, how.dim, f) / np.float32(w) for w in how.widths]
    arrays = [vectors, *kernels, np.zeros(f * len(how.widths), np.float32), draw(f * len(how.widths)), np.zeros(1, np.float32)]
    return arrays, [np.full_like(x, 1e-3) for x in arrays]


def _steps(bags: Iterable[tuple[np.ndarray, int]], arrays: list[np.ndarray], seen: list[np.ndarray], weight: np.ndarray, how: Settings, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """A gradient step on each (bag, class), in place, each number's size fitted to the gradients it has had; which vectors changed, and how many steps."""
    f, pad = how.filters, max(how.widths)
    vectors, *kernels, biases, out, base = arrays
    model = Model(how, np.zeros(0), vectors, kernels, biases, out, 0.0)
    changed, steps = np.zeros(len(vectors), bool), 0

    def step(x, g, past, at=slice(None)):
        past[at] += g * g
        x[at] -= how.rate * g / np.sqrt(past[at])

    for bag, y in bags:
        steps += 1
        ids = np.where(rng.random((len(bag), 1)) < how.blank, 0, bag)
        ids = np.concatenate([ids, np.zeros((2 * pad - 1, 2), ids.dtype)])
        x = vectors[ids[:, 0]] + vectors[ids[:, 1]]
        values = _windows(x, model)
        tops = [v.argmax(axis=0) for v in values]
        pooled = np.concatenate([v[t, np.arange(f)] for v, t in zip(values, tops, strict=True)]) + biases
        hidden = np.maximum(pooled, 0)
        error = np.float32((_probability(hidden @ out + base)[0] - y) * weight[y])
        back = error * out * (pooled > 0)
        step(out, error * hidden + how.decay * out, seen[-2])
        step(base, error, seen[-1])
        step(biases, back, seen[-3])
        rows, pulls = [], []
        for n, (width, top) in enumerate(zip(how.widths, tops, strict=True)):
            own = back[n * f : (n + 1) * f]
            places = top[None, :] + np.arange(width)[:, None]  # (width, filter)
            pull = (kernels[n].transpose(0, 2, 1) * own[None, :, None]).reshape(-1, how.dim)
            rows += [ids[places, 0].ravel(), ids[places, 1].ravel()]
            pulls += [pull, pull]
            step(kernels[n], x[places].transpose(0, 2, 1) * own[None, None, :] + how.decay * kernels[n], seen[1 + n])
        rows, pulls = np.concatenate(rows), np.concatenate(pulls)
        each, back_to = np.unique(rows, return_inverse=True)
        total = np.zeros((len(each), how.dim), np.float32)
        np.add.at(total, back_to, pulls)
        keep = each > 0
        changed[each[keep]] = True
        step(vectors, total[keep] + how.decay * vectors[each[keep]], seen[0], each[keep])
    return changed, steps


def _class_weights(sizes: np.ndarray) -> np.ndarray:
    return sizes.sum() / np.maximum(2 * sizes, 1)


def _model(known: np.ndarray, arrays: list[np.ndarray], pairs: np.ndarray, how: Settings) -> Model:
    """The model of trained arrays; pairs: numbers of words and their stems, whose vectors are added."""
    vectors, *kernels, biases, out, base = arrays
    pairs = np.unique(pairs, axis=0)
    pairs = pairs[pairs[:, 0] > 0]
    vectors[pairs[:, 0]] += vectors[pairs[:, 1]]
    return Model(how, known, vectors, kernels, biases, out, float(base[0]))


def _trained(bags: list[np.ndarray], classes: np.ndarray, known: np.ndarray, how: Settings) -> Model:
    """Gradient steps on one text at a time."""
    arrays, seen = _start(known, how)
    rng = np.random.default_rng(how.seed)
    weight = _class_weights(np.bincount(classes, minlength=2))
    for _ in range(how.epochs):
        _steps(((bags[i], classes[i]) for i in rng.permutation(len(bags))), arrays, seen, weight, how, rng)
    return _model(known, arrays, np.concatenate(bags), how)


def _best_cut(scores: np.ndarray, classes: np.ndarray, weights: np.ndarray) -> float:
    """The logit at which the F1 of class 1 is highest, amid the widest gap that has it."""
    order = np.argsort(-scores, kind="stable")
    s, y, w = scores[order], classes[order], weights[order]
    hit, all_ = np.cumsum(w * y), np.cumsum(w)
    f1 = 2 * hit / (all_ + (w * y).sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    ends = np.append(s[1:], s[-1] - 2)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    i = best[np.argmax(s[best] - ends[best])]
    return float((s[i] + ends[i]) / 2)


def train(rows: list[tuple[str, int, str | None]], prior: float = 0.5, how: Settings = Settings()) -> Model:
    """Fit on (text, class 0 or 1, language) rows; prior: the share of class 1 where the model is used."""
    classes = np.array([y for _, y, _ in rows], np.int64)
    if len(set(classes.tolist())) < 2:
        return Model(how, np.zeros(0, np.uint64), np.zeros((1, how.dim), np.float32), [], np.zeros(0), np.zeros(0), 0.0, thresholds={})
    hashes = [hashes_of(t, how.stem) for t, _, _ in rows]
    words, n = np.unique(np.concatenate([np.unique(h) for h in hashes]), return_counts=True)
    enough = n >= max(how.least, len(rows) // how.share)
    known = words[enough][np.argsort(-n[enough], kind="stable")][: SLOTS // 8]
    if not len(known):
        known = np.ones(1, np.uint64)
    lookup = Lookup(known)
    bags = [np.stack([lookup.each(h[:, 0]), lookup.each(h[:, 1])], axis=1) for h in hashes]
    order = np.random.default_rng(how.seed).permutation(len(rows))
    apart = np.zeros(len(rows), bool)
    for y in (0, 1):
        own = order[classes[order] == y]
        apart[own[: len(own) // 5]] = True
    fitted = np.flatnonzero(~apart)
    model = _trained([bags[i] for i in fitted], classes[fitted], known, how)
    # the classes weigh as they occur, not as they were sampled; small samples are calibrated on themselves
    held = np.flatnonzero(apart) if classes[apart].sum() >= 20 else np.arange(len(rows))
    z = np.array([np.log(p / (1 - p)) for p in (min(max(score_long(hashes[i], model, lookup), 1e-12), 1 - 1e-12) for i in held)])
    y = classes[held]
    weights = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    cut = _best_cut(z, y, weights)
    model.shift = float(np.log(CUT / (1 - CUT)) - cut)
    model.thresholds = {}
    langs = np.array([rows[i][2] or "" for i in held])
    for lang in sorted(set(langs.tolist())):
        own = langs == lang
        if y[own].sum() >= 20 and (1 - y[own]).sum() >= 20:
            model.thresholds[lang] = float(_probability(np.array(_best_cut(z[own], y[own], weights[own]) + model.shift)))
    return model


def _marked(rows: DataFrame) -> np.ndarray:
    """A bitmap, of fixed size, of the rows' ``spot``."""
    bits = np.zeros(SPOTS // 8, np.uint8)
    found = rows.groupBy(F.expr("spot div 32768").alias("at")).agg(F.bitmap_construct_agg(F.expr("spot % 32768")).alias("bits")).toArrow()
    for at, own in zip(found.column("at").to_pylist(), found.column("bits").to_pylist(), strict=True):
        bits[at * 4096 : (at + 1) * 4096] = np.frombuffer(own, np.uint8)
    return bits


def labelled(documents: DataFrame, labels: DataFrame, how: Settings) -> tuple[DataFrame, dict[int, int]]:
    """(hash, y, lang, text, apart, part) of every text that may be learned, copies once; and all such labels of each class.

    apart: the fifth that isn't trained on. Which rows are wanted is found without their texts; a bitmap of those rows
    leaves out most others before the texts are shuffled, the join leaves out the rest.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y")).where(F.crc32(F.col("id").cast("string").cast("binary")) % 4 != 2)
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    own = documents.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang") if "lang" in documents.columns else F.lit(None).cast("string").alias("lang"))
    own = own.where("id IS NOT NULL").withColumn("hash", F.xxhash64("text"))
    spot = F.pmod(F.xxhash64("id", "hash"), F.lit(SPOTS)).alias("spot")
    wanted = spool(own.select("id", "hash").join(known, "id").groupBy("y", "hash").agg(F.min("id").alias("id")), "wanted")
    sent = documents.sparkSession.sparkContext.broadcast(_marked(wanted.select(spot)))

    def run(batches):
        for batch in batches:
            at = np.asarray(batch.column("spot"))
            yield batch.filter(pa.array((sent.value[at >> 3] >> (at & 7)) & 1 == 1)).select(["id", "hash", "lang", "text"])

    near = own.select("id", "hash", "lang", "text", spot).mapInArrow(run, "id long, hash long, lang string, text string")
    found = near.join(wanted.hint("merge"), ["id", "hash"]).groupBy("id", "hash", "y").agg(F.min(F.struct("lang", "text")).alias("x"))
    number = lambda seed, n: F.pmod(F.xxhash64("hash", F.lit(seed)), F.lit(n)).cast("int")
    return found.select("hash", "y", "x.lang", "x.text", (number(how.seed, 5) == 0).alias("apart"), number(how.seed + 1, how.epochs).alias("part")), sizes


def _words(batch: pa.RecordBatch, how: Settings) -> Iterable[np.ndarray]:
    """The hashes of the words of each text of a batch."""
    for _, _, data, offsets in slices(text_of(batch, "text")):
        if len(data) > 4 * PIECE:
            yield hashes_of(data.tobytes().decode("utf-8", "surrogatepass"), how.stem)
        else:
            hashes, counts = word_hashes(data, offsets, how.stem)
            yield from np.split(hashes, np.cumsum(counts)[:-1])


def known_words(rows: DataFrame, n: int, how: Settings) -> np.ndarray:
    """Hashes of the words and stems that enough texts hold, most frequent first."""

    def run(batches):
        for batch in batches:
            held = [np.zeros(0, np.int64), *[np.unique(x).view(np.int64) for x in _words(batch, how)]]
            words, counts = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(counts, pa.int64())], ["word", "n"])

    each = rows.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= max(how.least, n // how.share))
    found = each.orderBy(F.desc("n"), "word").limit(SLOTS // 8).toArrow()
    return np.asarray(found.column("word")).view(np.uint64) if found.num_rows else np.ones(1, np.uint64)


def turns(n: int, how: Settings) -> int:
    """In how many of the rounds each of n rows is: all if one task can have them, one at least."""
    return min(how.epochs, max(1, how.epochs * 2 * how.most // max(n, 1)))


def _round(sent, bags: DataFrame, number: int, weight: np.ndarray, how: Settings) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """One round of all tasks from the same model: the mean of their arrays, a word's vector of those tasks that changed it."""

    def run(batches):
        arrays, seen = ([x.copy() for x in part] for part in sent.value)
        from pyspark import TaskContext

        rng = np.random.default_rng([how.seed, number, TaskContext.get().partitionId()])

        def rows():
            for batch in batches:
                words, classes = batch.column("bag").to_pylist(), batch.column("y").to_pylist()
                for i in rng.permutation(len(words)):
                    yield np.frombuffer(words[i], np.int32).reshape(-1, 2), classes[i]

        changed, steps = _steps(rows(), arrays, seen, weight, how, rng)
        if steps:
            yield pa.RecordBatch.from_pydict({"arrays": [pickle.dumps((changed, arrays, seen))]})

    total = past = times = None
    n = 0
    done = spool(bags.mapInArrow(run, "arrays binary"), "round")
    for row in done.toLocalIterator():
        changed, arrays, seen = pickle.loads(row["arrays"])
        if total is None:
            total, past, times = [np.zeros(x.shape) for x in arrays], [np.zeros(x.shape) for x in seen], np.zeros(len(changed))
        times += changed
        arrays[0][~changed] = seen[0][~changed] = 0
        for t, x in zip([*total, *past], [*arrays, *seen], strict=True):
            t += x
        n += 1
    discard(done)
    if not n:
        return sent.value
    arrays, seen = [t / n for t in total], [t / n for t in past]
    for out, t, old in ((arrays, total, sent.value[0]), (seen, past, sent.value[1])):
        out[0] = np.where(times[:, None] > 0, t[0] / np.maximum(times, 1)[:, None], old[0])
    return [x.astype(np.float32) for x in arrays], [x.astype(np.float32) for x in seen]


def calibrated(model: Model, held: DataFrame, prior: float) -> Model:
    """The model with its shift and thresholds by all rows of held (text, y, lang); logits are told apart to a 256th."""
    sent, how = held.sparkSession.sparkContext.broadcast(model), model.settings

    def run(batches):
        lookup = Lookup(sent.value.words)
        for batch in batches:
            p = np.clip([score_long(x, sent.value, lookup) for x in _words(batch, how)], 1e-12, 1 - 1e-12)
            z = np.round(np.log(p / (1 - p)) * 256) / 256
            yield pa.RecordBatch.from_arrays([batch.column("y"), pc.fill_null(batch.column("lang"), ""), pa.array(z, pa.float64())], ["y", "lang", "z"])

    found = held.select("text", "y", "lang").mapInArrow(run, "y int, lang string, z double").groupBy("lang", "y", "z").agg(F.count("*").alias("n")).toArrow()
    z, y, n = (np.asarray(found.column(c)) for c in ("z", "y", "n"))
    langs = np.array(found.column("lang").to_pylist(), object)
    share = n[y == 1].sum() / max(n.sum(), 1)
    # the classes weigh as they occur among labels, not as their different texts do
    weights = n * np.where(y == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    model.shift = float(np.log(CUT / (1 - CUT)) - _best_cut(z, y, weights))
    model.thresholds = {}
    for lang in sorted(set(langs.tolist())):
        own = langs == lang
        if n[own & (y == 1)].sum() >= 20 and n[own & (y == 0)].sum() >= 20:
            model.thresholds[lang] = float(_probability(np.array(_best_cut(z[own], y[own], weights[own]) + model.shift)))
    return model


def fit(documents: DataFrame, labels: DataFrame, how: Settings = Settings()) -> Model:
    """A model of every labelled row that may be learned."""
    rows, sizes = labelled(documents, labels, how)
    if len(sizes) < 2:
        return train([], how=how)
    rows = spool(rows, "labelled", "part")
    count = {(r["y"], r["apart"]): r["n"] for r in rows.groupBy("y", "apart").agg(F.count("*").alias("n")).collect()}
    fitted, learned = np.array([count.get((y, False), 0) for y in (0, 1)]), rows.where("NOT apart")
    if not fitted.all():  # a class of few rows, all apart
        fitted, learned = fitted + [count.get((y, True), 0) for y in (0, 1)], rows
    if not fitted.all():
        discard(rows)
        return train([], how=how)
    known = known_words(rows, sum(count.values()), how)
    sent = documents.sparkSession.sparkContext.broadcast(known)

    def numbers(batches):
        lookup = Lookup(sent.value)
        for batch in batches:
            found = [np.stack([lookup.each(h[:, 0]), lookup.each(h[:, 1])], axis=1).astype(np.int32).tobytes() for h in _words(batch, how)]
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("y"), pa.array(found, pa.binary()), batch.column("part")], ["hash", "y", "bag", "part"])

    n, times = int(fitted.sum()), turns(int(fitted.sum()), how)
    tasks = max(1, round(n * times / how.epochs / how.most))
    bags = learned.select("hash", "y", "text", "part").mapInArrow(numbers, "hash long, y int, bag binary, part int").repartition(tasks, "hash").drop("hash")
    bags = spool(bags, "bags", "part")
    state = _start(known, how)
    weight = _class_weights(fitted)
    for number in range(how.epochs):
        own = bags.where(F.col("part").isin([(number * times + i) % how.epochs for i in range(times)])).select("bag", "y")
        state = _round(documents.sparkSession.sparkContext.broadcast(state), own.coalesce(tasks), number, weight, how)
    model = _model(known, state[0], _pairs(bags), how)
    # small tables are calibrated on all their rows
    model = calibrated(model, rows.where("apart") if count.get((1, True), 0) >= 20 else rows, sizes[1] / (sizes[0] + sizes[1]))
    discard(bags)
    discard(rows)
    return model


def _pairs(bags: DataFrame) -> np.ndarray:
    """The different pairs of numbers in all bags: no more than there are known words, as a word has one stem."""

    def run(batches):
        for batch in batches:
            pairs = np.unique(np.concatenate([np.frombuffer(x, np.int32).reshape(-1, 2) for x in batch.column("bag").to_pylist()]), axis=0)
            pairs = pairs[pairs[:, 0] > 0]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["word", "stem"])

    found = bags.select("bag").mapInArrow(run, "word int, stem int").distinct().toArrow()
    return np.stack([np.asarray(found.column(c)) for c in ("word", "stem")], axis=1).reshape(-1, 2)


def add_score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """documents with one more column, the probability of class 1; it replaces one of that name."""
    documents = documents.drop(name)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        own = sent.value
        lookup = Lookup(own.words)

        def run(batch):
            texts, scores = text_of(batch, "text"), []
            for _, _, data, offsets in slices(texts):
                if len(data) > 4 * PIECE:
                    scores.append(score_long(hashes_of(data.tobytes().decode("utf-8", "surrogatepass"), own.settings.stem), own, lookup))
                else:
                    scores += score_slice(*word_hashes(data, offsets, own.settings.stem), own, lookup).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

        return run

    return documents.mapInArrow(each_batch(make), StructType([*documents.schema.fields]).add(name, DoubleType()))


def threshold(model: Model, lang):
    """The calibrated threshold of a language column."""
    out = F.lit(CUT)
    for name, cut in (model.thresholds or {}).items():
        out = F.when(lang == name, F.lit(cut)).otherwise(out)
    return out


def op12_toxicity(spark, sf_dir):
    """Score every document; labels of held-out rows are never seen. toxic: whether the score reaches its language's threshold."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(documents, read(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    flag = (F.col("score") >= threshold(model, F.col("lang"))).cast("int")
    return add_score(documents, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), flag.alias("toxic"))
