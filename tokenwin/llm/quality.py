"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Features of a text, each hashed into 2^18 buckets: its words and word pairs in lower case, and runs
of one, two and three word shapes. A shape keeps punctuation, writes letters as A or a and digits
as 0, and squeezes repeats; a word equal to the one before it has a shape of its own. Counts are
divided by their number, so that the length of a text has no weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.llm.labelled import labelled_sample
from tokenwin.llm.spans import releasing, releasing_group
from tokenwin.llm.textbytes import Words, mix, ngram_hashes, plain_text, slices, span_hashes, split_words, text_bytes
from tokenwin.shared import byte_count

BUCKETS = 1 << 18
# The most labelled rows of each class that training reads, the least parts it is trained in, and their bytes of text on average.
PER_CLASS = 10_000
SHARDS = 4
SHARD_BYTES = 16 << 20
# Bytes of text whose features are made at a time.
_PIECE = 1 << 20
# Passes over a shard, and more of them where it is small.
_EPOCHS, _UPDATES = 3, 800
_BATCH = 16
_ALPHA, _BETA, _L1, _L2 = 0.5, 1.0, 1e-4, 1e-3
_SCALE = 20.0

_SHAPE = bytes(
    0x41 if 0x41 <= b <= 0x5A else 0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x30 if 0x30 <= b <= 0x39 else b
    for b in range(256)
)
_LOWER = bytes(range(256)).lower()
_REPEATED = np.uint64(0x2545F4914F6CDD1D)


class QualityModel(NamedTuple):
    weights: np.ndarray  # one for each bucket, then the intercept


def _shapes(data: np.ndarray, words: Words) -> np.ndarray:
    shape = np.frombuffer(data.tobytes().translate(_SHAPE), np.uint8)
    keep = np.zeros(len(shape) + 1, np.bool_)
    keep[1:-1] = shape[1:] != shape[:-1]
    keep[words.start] = True
    at = np.concatenate([[0], np.cumsum(keep[:-1])])
    return span_hashes(shape[keep[:-1]], at[words.start], at[words.end])


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, row by row, and the number of features of each row."""
    whole, bounds = text_bytes(plain_text(texts))
    words = split_words(whole, bounds)
    if not len(words.start):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    lower = span_hashes(np.frombuffer(whole.translate(_LOWER), np.uint8), words.start, words.end)
    shapes = _shapes(words.data, words)
    again = np.zeros(len(lower), np.bool_)
    again[1:] = lower[1:] == lower[:-1]
    again[words.first[:-1][words.first[:-1] < len(again)]] = False
    shapes = np.where(again, _REPEATED, shapes)
    kinds = [(lower, 1), (lower, 2), (shapes, 1), (shapes, 2), (shapes, 3)]
    found, rows = [], []
    for salt, (hashes, n) in enumerate(kinds):
        grams, at = ngram_hashes(hashes, words.first, n)
        found.append((mix(grams + np.uint64(salt)) >> np.uint64(46)).astype(np.int64))
        rows.append(np.repeat(np.arange(len(texts)), np.diff(at)))
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return np.concatenate(found)[order], np.bincount(row, minlength=len(texts))


def _logits(weights: np.ndarray, index: np.ndarray, count: np.ndarray) -> np.ndarray:
    row = np.repeat(np.arange(len(count)), count)
    sums = np.bincount(row, weights[index], minlength=len(count))
    return weights[BUCKETS] + _SCALE * sums / np.maximum(count, 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_ftrl(texts: pa.Array, labels: np.ndarray) -> np.ndarray:
    """Weights after a few passes over the given texts in their order."""
    parts = [features(b.column(0)) for b in slices([pa.RecordBatch.from_arrays([texts], ["text"])], most=_PIECE)]
    index, count = (np.concatenate(p) for p in zip(*[(i.astype(np.uint32), n) for i, n in parts]))
    at = np.concatenate([[0], np.cumsum(count)])
    z, n, w = (np.zeros(BUCKETS + 1) for _ in range(3))
    for _ in range(max(_EPOCHS, -(-_UPDATES * _BATCH // len(labels)))):
        for lo in range(0, len(labels), _BATCH):
            hi = min(lo + _BATCH, len(labels))
            own, sizes = index[at[lo] : at[hi]], count[lo:hi]
            error = _sigmoid(_logits(w, own, sizes)) - labels[lo:hi]
            share = np.repeat(error * _SCALE / np.maximum(sizes, 1), sizes)
            touched, place = np.unique(own, return_inverse=True)
            touched = np.append(touched, BUCKETS)
            g = np.append(np.bincount(place, share, minlength=len(touched) - 1), error.sum()) / len(error)
            grown = n[touched] + g * g
            z[touched] += g - (np.sqrt(grown) - np.sqrt(n[touched])) / _ALPHA * w[touched]
            n[touched] = grown
            zt = z[touched]
            w[touched] = -np.sign(zt) * np.maximum(np.abs(zt) - _L1, 0) / ((_BETA + np.sqrt(grown)) / _ALPHA + _L2)
    return w


def train_quality(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "quality", per_class: int = PER_CLASS
) -> QualityModel:
    """Fit on a bounded sample of the labelled documents; see ``labelled_sample``.

    The sample is dealt into ``SHARDS`` groups by id, or more where its texts have more than ``SHARD_BYTES`` for each. Each
    is trained alone and the weights are averaged, so no task holds more than its share. Without labels all weights are 0.
    """
    sample, shift = labelled_sample(docs, labels, label, F.lit(True) if usable is None else usable, per_class)

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending")])
        # Equal ids would let the order of rows decide, so the shuffle of training rows is by place.
        order = np.random.default_rng(0).permutation(group.num_rows)
        group = group.take(pa.array(order))
        w = fit_ftrl(group.column("text").combine_chunks(), group.column("label").to_numpy().astype(float))
        return pa.table({"rows": pa.array([group.num_rows], pa.int64()), "w": pa.array([w.tobytes()], pa.binary())})

    shards = sample.withColumn("shard", F.col("part") % max(SHARDS, -(-byte_count(sample) // SHARD_BYTES)))
    fitted = shards.groupBy("shard").applyInArrow(releasing_group(fit), "rows bigint, w binary").collect()
    total = sum(r["rows"] for r in fitted)
    weights = np.zeros(BUCKETS + 1)
    for r in sorted(fitted, key=lambda r: (r["rows"], r["w"])):
        weights += np.frombuffer(r["w"]) * (r["rows"] / total)
    weights[BUCKETS] += shift
    return QualityModel(weights.astype(np.float32))


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted)`` of every row; a NULL text counts as empty, scored by the intercept.

    Rows with equal texts get equal scores, repeated rows stay, and an empty table gives none.
    Only ``doc_id`` and ``text`` are read, so other columns of any name do no harm.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=_PIECE):
            value = _sigmoid(_logits(weights.value, *features(batch.column("text"))).astype(np.float64))
            out = [batch.column("doc_id"), pa.array(value), pa.array((value >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(releasing(score), "doc_id bigint, score double, predicted int")


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier does not reject; no row moves."""
    weights = docs.sparkSession.sparkContext.broadcast(train_quality(docs, labels).weights)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=_PIECE):
            value = _sigmoid(_logits(weights.value, *features(batch.column("text"))).astype(np.float64))
            yield batch.filter(pa.array(value >= threshold))

    return docs.mapInArrow(releasing(keep), docs.schema)
