"""Toxicity of documents, learnt from document labels by multiple-instance learning.

A sentence's score is a logistic function of the byte n-grams it contains, and the
document's is the noisy-or of its sentences: toxic if any of them is. Only documents have
labels; the fit passes the error of the noisy-or back to the sentences, whose scores then
tell which of them offend.

Some clean sentences score high by chance, and the more sentences a text has, the higher
the best of them. So a sentence counts only above the floor that the sentences of a clean
text of as many sentences pass with probability ``CHANCE`` in all. Floors are read from
clean sentences scored by models fitted without their documents; beyond what the sample
shows, its tail is continued as an exponential one. Length alone makes no text toxic.

The model is fitted on at most ``SAMPLE`` labelled documents of either class, chosen by a
hash of their id, of at most ``SAMPLE_BYTES`` together, whatever the length of each. Scoring covers every
sentence of every text, holds one text at a time and shuffles nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import text_bytes, texts

SAMPLE = 3000
SAMPLE_BYTES = 16 << 20
THRESHOLD = 0.7
OFFENDING = 0.5
SIZES = (5, 6)
FEATURES = 20_000
STEPS = 400
CHANCE = 0.05
TAIL = (0.001, 0.01)  # shares of clean sentences the tail is continued from: mislabelled ones lie above

SCORES = (
    "doc_id long, score double, predicted int, "
    "sentences array<struct<start: long, end: long, score: double>>"
)

_ENDS = np.isin(np.arange(256), list(b".!?\n"))
_BLANKS = "".join(chr(b) for b in range(128) if not chr(b).isalnum()).encode()
_PLAIN = bytes.maketrans(_BLANKS, b" " * len(_BLANKS))
_FILTER_BITS = 20
_PIECE = 1 << 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def grams(text: bytes) -> Iterator[tuple[np.ndarray, int]]:
    """For each piece and size, the n-gram starting at every byte, as a number that also tells
    the size, and where the piece starts.

    Letters are lower-cased, punctuation and white space count as blanks, and the text
    is framed by blanks, so that beginnings and ends of words show.
    """
    data = b" " + text.lower().translate(_PLAIN) + b" " * max(SIZES)
    for at in range(0, len(text) + 1, _PIECE):
        count = min(_PIECE, len(text) + 1 - at)
        values = np.frombuffer(data, np.uint8, count + max(SIZES), at).astype(np.uint64)
        packed, done = np.zeros(count, dtype=np.uint64), 0
        for size in SIZES:
            for i in range(done, size):
                packed = packed | (values[i : i + count] << np.uint64(8 * i))
            done = size
            yield packed | np.uint64(size << 56), at


def sentence_bounds(text: bytes) -> np.ndarray:
    """Byte offsets at which sentences end, the last one that of the text."""
    ends = np.flatnonzero(_ENDS[np.frombuffer(text, np.uint8)]) + 1
    return ends if len(ends) and ends[-1] == len(text) else np.append(ends, len(text))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


@dataclass
class Model:
    """Weights of n-grams, sorted, and the bias of a sentence.

    ``tail`` has the highest logits of clean sentences, descending, of ``clean`` in all.
    """

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    tail: np.ndarray = field(default_factory=lambda: np.zeros(0))
    clean: int = 0

    def __post_init__(self) -> None:
        self.present = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.present[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * _SPREAD) >> np.uint64(64 - _FILTER_BITS)

    def hits(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(bounds, sentence, feature)``: where known n-grams start; one per sentence and feature."""
        bounds = sentence_bounds(text)
        rows = [np.zeros((0, 2), dtype=np.int64)]
        for found, piece in grams(text):
            at = np.flatnonzero(self.present[self._slot(found)])
            place = np.minimum(np.searchsorted(self.keys, found[at]), max(0, len(self.keys) - 1))
            real = self.keys[place] == found[at] if len(self.keys) else np.zeros(0, dtype=bool)
            # The frame puts each n-gram one byte later; a blank before a word belongs to it.
            sentence = np.minimum(np.searchsorted(bounds, piece + at[real], "right"), len(bounds) - 1)
            rows.append(np.stack([sentence, place[real]], axis=1))
        pairs = np.unique(np.concatenate(rows), axis=0)
        return bounds, pairs[:, 0], pairs[:, 1]

    def logits(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where sentences end, and their logits."""
        bounds, sentence, feature = self.hits(text)
        return bounds, self.bias + np.bincount(sentence, self.weights[feature], len(bounds))

    def floor(self, sentences: int) -> float:
        """The logit that any of so many clean sentences passes with probability ``CHANCE``."""
        if not len(self.tail):
            return -np.inf
        rank = CHANCE * self.clean / sentences
        near = min(max(10, int(TAIL[0] * self.clean)), len(self.tail))
        far = min(max(100, int(TAIL[1] * self.clean)), len(self.tail))
        if rank >= near:
            return float(self.tail[min(int(rank), len(self.tail)) - 1])
        fall = self.tail[near - 1] - self.tail[far - 1]
        slope = fall / np.log(far / near) if far > near else 1.0
        return float(self.tail[near - 1] + slope * np.log(near / rank))

    def score(self, text: bytes | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and start, end and score of its offending sentences, in characters."""
        if not text:
            return 0.0, []
        bounds, z = self.logits(text)
        counts = np.where(z > self.floor(len(z)), _softplus(z), 0.0)
        score = float(-np.expm1(-counts.sum()))
        single = -np.expm1(-counts)
        offending = []
        for i in np.flatnonzero(single >= OFFENDING):
            start, end = int(bounds[i - 1]) if i else 0, int(bounds[i])
            before = len(text[:start].decode("utf-8", "replace"))
            offending.append((before, before + len(text[start:end].decode("utf-8", "replace")), float(single[i])))
        return score, offending


def _distinct(text: bytes) -> np.ndarray:
    return np.unique(np.concatenate([np.unique(g) for g, _ in grams(text)]))


def select_features(sample: list[tuple[bytes, int]]) -> np.ndarray:
    """The n-grams most unevenly spread over the two classes of documents.

    Counts are gathered some documents at a time, and of clean documents only for the
    n-grams of toxic ones, so memory follows the n-grams and not the sample's length.
    """
    found, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    toxic_texts = [t for t, y in sample if y]
    for at in range(0, len(toxic_texts), 100):
        some = [_distinct(t) for t in toxic_texts[at : at + 100]]
        joined, place = np.unique(np.concatenate([found, *some]), return_inverse=True)
        weights = np.concatenate([count, np.ones(len(place) - len(count), np.int64)])
        found, count = joined, np.bincount(place, weights, len(joined)).astype(np.int64)
    found, count = found[count >= 3], count[count >= 3]
    clean = np.zeros(len(found), np.int64)
    for text in (t for t, y in sample if not y and len(found)):
        own = _distinct(text)
        at = np.minimum(np.searchsorted(found, own), len(found) - 1)
        clean[at[found[at] == own]] += 1
    n_clean, n_toxic = (sum(y == label for _, y in sample) for label in (0, 1))
    toxic_share, clean_share = (count + 0.5) / (n_toxic + 1), (clean + 0.5) / (n_clean + 1)
    gain = np.log(toxic_share / clean_share)
    fit = gain > 1.5
    strength = np.where(fit, gain * count, 0)
    chosen = np.argsort(-strength, kind="stable")[: min(FEATURES, int(fit.sum()))]
    return np.sort(found[chosen])


def fit(sample: list[tuple[bytes | None, int]]) -> Model:
    """A model of the whole sample, with the tail of its clean sentences.

    Each half's clean sentences are scored by a model of the other half; equal texts are
    in one half. Without toxic documents no n-gram is chosen and every score is near 0.
    """
    sample = [(text or b"", label) for text, label in sample]
    model = _likeliest(sample)
    halves = [[r for r in sample if zlib.crc32(r[0]) % 2 == h] for h in (0, 1)]
    found = [np.zeros(0)]
    for own, other in (halves, halves[::-1]):
        apart = _likeliest(other)
        found += [apart.logits(text)[1] for text, label in own if not label and text]
    z = np.sort(np.concatenate(found))[::-1]
    model.clean = len(z)
    model.tail = z[: max(100, int(np.ceil(CHANCE * len(z))))].copy()
    return model


def _likeliest(sample: list[tuple[bytes, int]]) -> Model:
    """Maximum likelihood of the document labels under the noisy-or, by Adam on the whole sample."""
    model = Model(select_features(sample), np.zeros(0), -8.0)
    n = len(model.keys)
    doc, sentence, feature, offset, toxic = [], [], [], 0, []
    for i, (text, label) in enumerate(sample):
        bounds, s, f = model.hits(text)
        doc.append(np.full(len(bounds), i))
        sentence.append(s + offset)
        feature.append(f)
        offset += len(bounds)
        toxic.append(label)
    model.weights = np.zeros(n)
    if not n:
        return model
    doc, sentence, feature = np.concatenate(doc), np.concatenate(sentence), np.concatenate(feature)
    toxic = np.array(toxic, dtype=bool)
    share = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))
    state = np.zeros(n + 1)
    state[:n], state[n] = 1.0, model.bias
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, STEPS + 1):
        z = state[n] + np.bincount(sentence, state[feature], offset)
        total = np.bincount(doc, _softplus(z), len(sample))
        outer = np.where(toxic, -1.0 / np.expm1(np.clip(total, 1e-9, 500)), 1.0) * share
        inner = outer[doc] / (1.0 + np.exp(-z))
        slope = np.append(np.bincount(feature, inner[sentence], n), inner.sum())
        slope[:n] += 1e-5 * state[:n]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        state -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    model.weights, model.bias = state[:n], float(state[n])
    return model


def held_out() -> Column:
    """Whether a document is kept from every fit: crc32 of its id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from the labelled documents that are not held out; only text and label are used.

    Of either class, up to ``sample`` documents in the order of a hash of their ids are
    taken as far as they fit into ``sample_bytes``. Of rows that share an id, the shortest
    is taken, and the least of these.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & ~held_out())
        .distinct()
    )
    order = F.xxhash64(F.col("doc_id"), F.lit(2))
    texts_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()).where("text IS NOT NULL")
    texts_of = texts_of.withColumn("n", F.octet_length("text"))
    # Ids and lengths are few bytes each: those of the sample are chosen before any text is read.
    sizes = texts_of.where(F.col("n") <= sample_bytes).groupBy("doc_id").agg(F.min("n").alias("n"))
    chosen = []
    for label in (0, 1):
        left = sample_bytes
        one = known.where(F.col("toxic") == label).join(sizes, "doc_id")
        for doc_id, n in one.orderBy(order, "doc_id").limit(sample).select("doc_id", "n").collect():
            if n <= left:
                left -= n
                chosen.append((doc_id, label, n))
    chosen = docs.sparkSession.createDataFrame(chosen, "doc_id long, toxic int, n int")
    rows = texts_of.join(F.broadcast(chosen.select("doc_id", "n").distinct()), ["doc_id", "n"])
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    found = sorted((tuple(r) for r in rows.select("doc_id", "text", "toxic").collect()), key=lambda r: (r[0], r[2]))
    return fit([(bytes(text), label) for _, text, label in found])


def _score_batches(model) -> object:
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentence = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        for batch in source:
            scores, spans = [], []
            for text in texts(batch.column("text")):
                score, offending = model.value.score(text)
                scores.append(score)
                spans.append([dict(zip(("start", "end", "score"), s)) for s in offending])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                    pa.array(spans, pa.list_(sentence)),
                ],
                names=["doc_id", "score", "predicted", "sentences"],
            )

    return batches


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, score, predicted, and its offending sentences.

    Null and empty texts have no sentence and score 0. Equal texts score equally; every
    row, also one without id or with a repeated id, has its own result. An empty table
    gives an empty result. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    return plain.mapInArrow(_score_batches(shared), SCORES)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keep = [shared.value.score(text)[0] < THRESHOLD for text in texts(batch.column("__text"))]
            yield batch.drop_columns(["__text"]).filter(pa.array(keep, pa.bool_()))

    return docs.withColumn("__text", F.col("text").cast("binary")).mapInArrow(batches, docs.schema)
