"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Every word that makes up at least ``LEAST_SHARE`` of all words has a vector of its own: all
words are counted in Spark, and a share can be reached by ``1 / LEAST_SHARE`` words at most,
however large the corpus. The rarer words stand for their form (kind of characters, case and
length), as unknown words do in taggers; each form has a vector like a word, and beside it every
rare word keeps its own index vector, which is made from its hash and stored nowhere. So every
word of a text counts, and the table can be broadcast.

A word or form has a sparse ternary index vector (a few +1 and -1 at random places), and its
context vector is the sum of the index vectors of the words near it over all documents:
integer sums, so they don't depend on the order of tasks. A document is pooled into the mean
of its words' weighted vectors and the mean product of neighbours' unit vectors (how much a word
is like the next one); nothing else describes it. A two-layer network gives a logit and a temperature, fitted on labelled rows that the network
did not see, makes it a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import release, stored, strings, text_batches, text_or_empty
from tripmart.llm.memo import Memo

DIMS, NONZERO, REACH = 32, 4, 2
#: Share of all words from which a word has its own vector: 32,768 words at most reach it.
LEAST_SHARE = 1 / (1 << 15)
#: Labelled rows that the network is fitted on at most (those with the smallest id hashes).
MAX_LABELLED = 20_000
#: Weight of a word with share p of all words: RARE / (RARE + p).
RARE = 1e-3
HIDDEN, EPOCHS, RATE, BATCH, DECAY = 32, 40, 0.01, 256, 1e-4
_TOKEN = re.compile(r"\w+|[^\w\s]+").findall
_UPPER, _TITLE, _LOWER, _MIXED, _NUMBER, _OTHER, _MARKS = range(7)
_LENGTHS = 6
#: Forms of rare words.
FORMS = 7 * _LENGTHS
FEATURES = 2 * DIMS
#: Words of a text that are pooled at once.
_CHUNK = 1 << 14
#: Distinct words that a task counts before it sends them on.
_COUNTED = 300_000


def word_key(word: str) -> int:
    """64 bits that stand for a word, signed; words may be as long as texts."""
    return xxhash.xxh64_intdigest(word.encode()) - (1 << 63)


def word_form(word: str) -> int:
    """The form of a word: its kind of characters and the bits of its length (6 or more alike)."""
    if word.isalpha():
        kind = _LOWER if word.islower() else _TITLE if word.istitle() else _UPPER if word.isupper() else _MIXED
    elif word[0].isalnum() or word[0] == "_":
        kind = _NUMBER if word.isdigit() else _OTHER
    else:
        kind = _MARKS
    return kind * _LENGTHS + min(len(word).bit_length(), _LENGTHS) - 1


@dataclass
class Vocabulary:
    """Codes of words: forms come first, then the words of ``keys`` (sorted). A rare word's is
    negative and holds its form and 32 bits of its hash."""

    keys: np.ndarray
    _codes: Memo | None = field(default=None, repr=False)

    def __len__(self) -> int:
        return FORMS + len(self.keys)

    def __getstate__(self) -> dict:
        return {"keys": self.keys, "_codes": None}

    def codes(self, text: str) -> np.ndarray:
        """The code of each word of a text."""
        if self._codes is None:
            places = {k: FORMS + n for n, k in enumerate(self.keys.tolist())}

            def code(word: str) -> int:
                key = word_key(word)
                known = places.get(key)
                return -1 - word_form(word) - FORMS * (key & 0xFFFFFFFF) if known is None else known

            self._codes = Memo(code, 300_000)
        words = _TOKEN(text)
        found = np.fromiter(map(self._codes.__getitem__, words), dtype=np.int64, count=len(words))
        self._codes.trim()
        return found

    def index_vectors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and signs of the non-zero entries of each code's index vector."""
        random = np.random.default_rng(7)
        places = np.argsort(random.random((len(self), DIMS)), axis=1)[:, :NONZERO]
        return places, random.choice([-1.0, 1.0], (len(self), NONZERO))


def _rows(codes: np.ndarray) -> np.ndarray:
    """Rows of the vectors: a rare word's is that of its form."""
    return np.where(codes < 0, (-1 - codes) % FORMS, codes)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        keys = pa.array(map(word_key, counts), pa.int64(), size=len(counts))
        return pa.RecordBatch.from_arrays([keys, pa.array(list(counts.values()), pa.int64())], ["key", "n"])

    for batch in batches:
        for text in strings(batch.column(0)):
            counts.update(_TOKEN(text))
            if len(counts) > _COUNTED:
                yield counted()
                counts.clear()
    yield counted()


def vocabulary(docs: DataFrame, text: str = "text", least_share: float = LEAST_SHARE) -> Vocabulary:
    """The words of ``docs`` that make up ``least_share`` of all words, over whole texts."""
    text_batches(docs.sparkSession)
    found = docs.select(text_or_empty(text).alias("text")).mapInArrow(_word_counts, "key long, n long")
    counts = stored(found.groupBy("key").agg(F.sum("n").alias("n")), "quality-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    known = counts.where(F.col("n") >= least_share * total).select("key").toPandas()  # 1 / least_share rows at most
    release(counts)
    return Vocabulary(np.sort(known["key"].to_numpy(dtype=np.int64)))


def _context_sums(words: Vocabulary):
    """Per task: how often each code occurs, and the sum of its neighbours' index vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = words.index_vectors()
        size = len(words) * DIMS
        total, seen = np.zeros(size), np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            docs = [_rows(words.codes(t)) for t in strings(batch.column(0))]
            codes = np.concatenate([np.zeros(0, np.int64), *docs])
            owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
            seen += np.bincount(codes, minlength=len(words))
            where, what = [np.zeros(0, np.int64)], [np.zeros(0)]
            for gap in range(1, REACH + 1):
                near = owner[gap:] == owner[:-gap]
                left, right = codes[:-gap][near], codes[gap:][near]
                for word, other in ((left, right), (right, left)):
                    where.append((word[:, None] * DIMS + places[other]).ravel())
                    what.append(signs[other].ravel())
            total += np.bincount(np.concatenate(where), np.concatenate(what), minlength=size)
        used = np.flatnonzero(seen)
        if len(used):
            sums = total.reshape(-1, DIMS)[used].astype(np.int64)
            columns = [pa.array(used), pa.array(seen[used]), *(pa.array(c) for c in sums.T.copy())]
            yield pa.RecordBatch.from_arrays(columns, ["code", "n", *(f"d{k}" for k in range(DIMS))])

    return run


@dataclass
class WordVectors:
    """Unit context vectors of all codes and the weights of these; 5 MiB at most."""

    words: Vocabulary
    unit: np.ndarray
    weights: np.ndarray

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Features of each text; zeros for one without words."""
        out = np.zeros((len(texts), FEATURES))
        for row, text in zip(out, texts, strict=True):
            codes = self.words.codes(text)
            last = np.zeros((0, DIMS), np.float32)
            for k in range(0, len(codes), _CHUNK):
                part = codes[k : k + _CHUNK]
                at = _rows(part)
                unit = self.unit[at]
                row[:DIMS] += self.weights[at] @ unit
                rare = part < 0
                unit[rare] = _own_vectors(part[rare])
                unit = np.concatenate([last, unit])
                row[DIMS:] += np.einsum("ij,ij->j", unit[1:], unit[:-1])
                last = unit[-1:]
            row /= max(1, len(codes))
        return out


def _own_vectors(codes: np.ndarray) -> np.ndarray:
    """Unit index vectors of rare words: signs from their hashes."""
    bits = ((-1 - codes) // FORMS).astype("<u4").view(np.uint8).reshape(-1, 4)
    return (np.unpackbits(bits, axis=1).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(DIMS))


def word_vectors(docs: DataFrame, words: Vocabulary, text: str = "text") -> WordVectors:
    """Context vectors of all codes, over all documents."""
    text_batches(docs.sparkSession)
    dims = [f"d{k}" for k in range(DIMS)]
    ddl = ", ".join(f"{c} long" for c in ["code", "n", *dims])
    sums = docs.select(text_or_empty(text).alias("text")).mapInArrow(_context_sums(words), ddl)
    table = sums.groupBy("code").agg(*(F.sum(c).alias(c) for c in ["n", *dims])).toPandas()  # a row per code
    vectors, share = np.zeros((len(words), DIMS)), np.zeros(len(words))
    codes = table["code"].to_numpy(dtype=np.int64)
    vectors[codes] = table[dims].to_numpy(dtype=float)
    share[codes] = table["n"].to_numpy(dtype=float)
    share /= max(1.0, share.sum())
    vectors -= share @ vectors  # what all words have in common says nothing
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return WordVectors(words, vectors.astype(np.float32), (RARE / (RARE + share)).astype(np.float32))


@dataclass
class QualityModel:
    """Word vectors and a network; 5 MiB at most, whatever the corpus."""

    vectors: WordVectors
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]  # w1, b1, w2, b2
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        hidden = np.tanh((features - self.mean) / self.scale @ w1 + b1)
        return hidden @ w2 + b2[0]

    def score(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(self.logits(self.vectors.pooled(texts)) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(features: np.ndarray, labels: np.ndarray, held: np.ndarray, vectors: WordVectors) -> QualityModel:
    """Fit the network on the rows not ``held`` and the temperature on those ``held``.

    With fewer than two classes the score is the same for every text: the labels' mean, or
    a half without labels."""
    fit = ~held if 0 < held.sum() < len(held) else np.ones(len(held), bool)
    width = features.shape[1] if len(features) else FEATURES
    if len(np.unique(labels[fit])) < 2:
        p = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
        layers = [np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.array([np.log(p / (1 - p))])]
        return QualityModel(vectors, np.zeros(width), np.ones(width), layers)
    x, y = features[fit], labels[fit].astype(float)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    x = (x - mean) / scale
    random = np.random.default_rng(11)
    layers = [random.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN),
              random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in layers]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = random.permutation(len(x))
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            hidden = np.tanh(x[rows] @ layers[0] + layers[1])
            error = (_sigmoid(hidden @ layers[2] + layers[3]) - y[rows]) / len(rows)
            back = np.outer(error, layers[2]) * (1 - hidden**2)
            slopes = [x[rows].T @ back + DECAY * layers[0], back.sum(axis=0),
                      hidden.T @ error + DECAY * layers[2], error.sum(keepdims=True)]
            step += 1
            for w, (m, v), g in zip(layers, moments, slopes, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = QualityModel(vectors, mean, scale, layers)
    check = held if held.any() else fit
    logits, truth = model.logits(features[check]), labels[check].astype(float)
    model.temperature = float(min(np.geomspace(0.25, 8, 121), key=lambda t: _log_loss(logits / t, truth)))
    return model


def _log_loss(logits: np.ndarray, truth: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - truth * logits))


def id_remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 for a null id, which is never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def fit_quality(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, text: str = "text",
    doc_id: str = "doc_id", label: str = "quality",
) -> QualityModel:
    """A model of ``label`` (1 good, 0 bad) learned from ``labels`` rows whose id remainder is
    not 0; those with remainder 1 calibrate it. Word vectors are learned from all texts.

    Rows with a null id or label, or of an id not in ``docs``, teach nothing; an id with
    several labels, or several texts, counts once for each."""
    vectors = word_vectors(docs, vocabulary(docs, text), text)
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
    known = known.where("doc_id is not null and label is not null").where(id_remainder(F.col("doc_id")) != 0)
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_labelled)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    rows = texts.join(F.broadcast(known), "doc_id").select(
        "text", "label", (id_remainder(F.col("doc_id")) == 1).alias("held")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = vectors.pooled(strings(batch.column(0))).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(features, pa.list_(pa.float64())), *batch.columns[1:]], ["features", "label", "held"]
            )

    found = rows.mapInArrow(run, "features array<double>, label double, held boolean").limit(max_labelled).collect()
    found.sort()  # tasks may answer in any order
    features = np.array([r.features for r in found], dtype=float).reshape(len(found), FEATURES)
    return train(features, np.array([r.label for r in found]), np.array([r.held for r in found], bool), vectors)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, score`` for each row of ``docs``; null and empty texts are scored like any."""
    spark = docs.sparkSession
    text_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # a few megabytes, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.score(strings(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def keep_quality(docs: DataFrame, model: QualityModel, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is ``least`` or more, with all their columns."""
    spark: SparkSession = docs.sparkSession
    text_batches(spark)
    sent, place = spark.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sent.value.score(strings(batch.column(place))) >= least))

    return docs.mapInArrow(run, docs.schema)
