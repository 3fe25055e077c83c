"""Toxicity by two class-conditional Kneser-Ney bigram models over one shared backoff.

As in all but the highest order of such a model, counts are
those of continuations: for a pair the different words before it, for a word the different words before
it in its class. A text that comes in many copies thus counts as one. A discount, chosen from
``DISCOUNTS`` on rows kept out of the counts, takes nearly all of a small count and little of a large one;
what it takes goes to the lower order, and at last to the count of both classes together. An expression
too rare to survive the discount therefore has nearly the same probability in both.

Words are runs of letters and digits in lower case, hashed into 2^19 buckets, and so are word pairs,
so a model has a fixed size. A text is judged by two figures: the difference of the two log-likelihoods,
divided by its words, and the largest share that one word has in it, for a single insult in a long
text. A logistic function of both, fitted on rows kept out of the counts, gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.llm.labelled import labelled_sample
from tokenwin.llm.textbytes import mix, plain_text, slices, span_hashes, split_words, text_bytes
from tokenwin.shared import write_shared

WORDS, PAIRS = 1 << 19, 1 << 19
# The most labelled rows of each class that training reads; three quarters are counted.
PER_CLASS = 15_000
DISCOUNTS = (2.0, 8.0, 16.0, 32.0, 64.0)
# Pairs have few continuations, so that their figures are uncertain for longer.
PAIR_DISCOUNT = 40.0
# The most that one word may count for or against.
MOST = 3.0
_START = 0  # bucket of the start of a text

_LETTERS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


class ToxicModel(NamedTuple):
    gain: np.ndarray  # per word bucket: class-conditional log odds without a known context
    odds: np.ndarray  # unigram probabilities, a row for each class
    weight: np.ndarray  # per context bucket and class: share that goes to the unigram
    total: np.ndarray  # per context bucket and class: count as context
    excess: np.ndarray  # per pair bucket and class: count less the discount
    curve: np.ndarray  # intercept, weights of the two figures, their lower and their upper limits


def _buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, of the words before them, and bounds of the rows."""
    whole, bounds = text_bytes(plain_text(texts))
    words = split_words(whole.translate(_LETTERS), bounds)
    word = (span_hashes(words.data, words.start, words.end) >> np.uint64(45)).astype(np.int64)
    before = np.roll(word, 1)
    before[words.first[:-1][words.first[:-1] < len(word)]] = _START
    return word, before, words.first


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (mix(before.astype(np.uint64) << np.uint64(20) | word.astype(np.uint64)) >> np.uint64(45)).astype(np.int64)


def _runs_of_three(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different ``word before, word between, word, class``, packed into 61 bits."""
    for batch in slices(batches):
        word, before, first = _buckets(batch.column("text"))
        third = np.roll(before, 1)
        third[first[:-1][first[:-1] < len(word)]] = _START
        label = np.repeat(batch.column("label").to_numpy(), np.diff(first)).astype(np.int64)
        keys = pd.unique((third << 41) | (before << 21) | (word << 1) | label)
        yield pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])


def _vector(rows: DataFrame, key: str, value: Column, size: int) -> np.ndarray:
    """Sums by bucket and class as an array; at most two rows for each of a fixed number of buckets."""
    sums = rows.groupBy(F.col(key).alias("k"), "label").agg(value.cast("double").alias("v")).where("v <> 0").toArrow()
    out = np.zeros((2, size))
    out[sums.column("label").to_numpy(), sums.column("k").to_numpy()] = sums.column("v").to_numpy()
    return out


def _figures(model: ToxicModel, texts: pa.Array) -> np.ndarray:
    """Per row: mean log odds of its words, and the largest of one word."""
    word, before, first = _buckets(texts)
    out = np.zeros((len(texts), 2))
    if not len(word):
        return out
    pair = _pair(before, word)
    gain = model.gain[word].astype(np.float64)
    full = np.flatnonzero((model.excess[0][pair] > 0) | (model.excess[1][pair] > 0))
    p = []
    for c in (0, 1):
        at, total = before[full], model.total[c][before[full]]
        known = total > 0
        high = np.where(known, model.excess[c][pair[full]] / np.maximum(total, 1), 0)
        p.append(high + np.where(known, model.weight[c][at], 1.0) * model.odds[c][word[full]])
    gain[full] = np.log(p[1] / p[0])
    np.clip(gain, -MOST, MOST, out=gain)
    sums = np.concatenate([[0.0], np.cumsum(gain)])
    count = np.diff(first)
    out[:, 0] = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(count, 1)
    some = count > 0
    out[some, 1] = np.maximum.reduceat(gain, first[:-1][some])
    return out


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, lightly held towards zero, and its mean loss."""
    low, high = np.quantile(x, [0.05, 0.95], axis=0)
    a = np.column_stack([np.ones(len(x)), np.clip(x, low, high)])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(3), a.T @ (y - p) - 1e-3 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(a @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return np.concatenate([w, low, high]), float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "toxic", per_class: int = PER_CLASS
) -> ToxicModel:
    """Fit on a bounded sample of the labelled documents; see ``labelled_sample``.

    Without rows of either class both models are the shared one and every text scores 0.5.
    """
    sample, shift = labelled_sample(docs, labels, label, F.lit(True) if usable is None else usable, per_class)
    runs = sample.where("part >= 250").mapInArrow(_runs_of_three, "key bigint").distinct()
    key = F.col("key")
    before, word = (key.bitwiseAND(F.lit((1 << n) - 1)) for n in (41, 21))
    parts = (F.shiftright(before, 21).cast("int").alias("before"), F.shiftright(word, 1).cast("int").alias("word"))
    counted = runs.groupBy(*parts, key.bitwiseAND(F.lit(1)).cast("int").alias("label"))
    pairs = write_shared(counted.agg(F.count("*").alias("n")), "pairs")
    n = _vector(pairs, "word", F.count("*"), WORDS)
    total = _vector(pairs, "before", F.sum("n"), WORDS)
    continued = pairs.groupBy("word", "before").agg(F.lit(0).alias("label"))
    cont = _vector(continued, "word", F.count("*"), WORDS)[0]
    kept, best, least = sample.where("part < 250"), None, np.inf
    for discount in DISCOUNTS:
        model = _model(pairs, n, total, cont, discount)
        # At most half of the sample's bound in rows of three numbers.
        x, y = _calibration(kept, model)
        if best is not None and not 0 < y.sum() < len(y):
            break
        curve, loss = _fit_curve(x, y) if 0 < y.sum() < len(y) else (np.zeros(7), 0.0)
        curve[0] += shift if curve.any() else 0.0
        if loss < least:
            best, least = model._replace(curve=curve), loss
    return best


def _over(n, discount: float):
    """What is left of a count: nearly nothing below ``discount``, nearly all well above it."""
    return n * n * n / (n * n + discount * discount)


def _model(pairs: DataFrame, n: np.ndarray, total: np.ndarray, cont: np.ndarray, discount: float) -> ToxicModel:
    least = discount * PAIR_DISCOUNT
    over = _over(F.col("n"), least)
    held = _vector(pairs, "before", F.sum(F.when(F.col("n") >= least / 4, F.col("n") - over).otherwise(F.col("n"))), WORDS)
    often = pairs.where(F.col("n") >= least / 4).select("before", "word", "label", over.alias("over"))
    often = often.mapInArrow(_pair_buckets, "pair int, label int, over double")
    excess = _vector(often, "pair", F.sum("over"), PAIRS)
    shared = (cont + 0.5) / (cont.sum() + 0.5 * WORDS)
    odds = np.empty((2, WORDS))
    for c in (0, 1):
        size = max(n[c].sum(), 1.0)
        over = _over(n[c], discount)
        left = (n[c] - over).sum() / size if n[c].any() else 1.0
        odds[c] = over / size + left * shared
    weight = np.where(total > 0, held / np.maximum(total, 1), 1.0)
    arrays = (np.log(odds[1] / odds[0]), odds, weight, total, excess)
    return ToxicModel(*(a.astype(np.float32) for a in arrays), np.zeros(7))


def _calibration(kept: DataFrame, model: ToxicModel) -> tuple[np.ndarray, np.ndarray]:
    shipped = _ship(kept, model)
    rows = _score(kept, shipped, ["label"]).toArrow()
    shipped.destroy()
    x = np.column_stack([rows.column("mean").to_numpy(), rows.column("peak").to_numpy()])
    return x, rows.column("label").to_numpy().astype(float)


def _pair_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pair = _pair(b.column("before").to_numpy().astype(np.int64), b.column("word").to_numpy().astype(np.int64))
        columns = [pa.array(pair.astype(np.int32)), b.column("label"), b.column("over")]
        yield pa.RecordBatch.from_arrays(columns, ["pair", "label", "over"])


def _ship(docs: DataFrame, model: ToxicModel) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(tuple(model))  # a plain tuple, as workers may lack this module


def _score(docs: DataFrame, shipped: Broadcast, keep: list[str]) -> DataFrame:
    names = [*keep, "mean", "peak", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            model = ToxicModel(*shipped.value)
            x = _figures(model, batch.column("text"))
            inside = np.clip(x, model.curve[3:5], model.curve[5:]) if model.curve.any() else x * 0
            value = 1 / (1 + np.exp(-(model.curve[0] + inside @ model.curve[1:3])))
            out = [batch.column(c) for c in keep] + [pa.array(v) for v in (x[:, 0], x[:, 1], value)]
            yield pa.RecordBatch.from_arrays(out, names)

    rows = docs.select(*keep, "text")
    types = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(score, types + "mean double, peak double, score double")


def score_toxicity(docs: DataFrame, model: ToxicModel, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted, mean, peak)`` of every row.

    A NULL or empty text has figures 0 and gets the score of those. Rows with equal texts get equal
    scores, repeated rows stay, an empty table gives none, and other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    return _score(rows, _ship(docs, model), ["doc_id"]).select("doc_id", "score", predicted, "mean", "peak")
