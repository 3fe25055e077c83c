"""Scores of texts by prediction by partial matching, beside a smoothed unigram base.

The score is the code length of the whole text, byte by byte, so it depends on the order of the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.llm.ppm import event_keys, most_used, train_model
from tokenwin.llm.spans import releasing
from tokenwin.llm.textbytes import Words, slices, word_hashes, words_of
from tokenwin.shared import write_shared

# Words that tasks hold with their counts, 16 bytes each; the others are joined.
HELD = 1 << 21
# Bytes of text whose words are counted at a time, and of those that are scored at a time.
_COUNTED = 1 << 20
_SCORED = 1 << 18
_SMOOTH = 0.1


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of each word, hashes by code, and a place by code where the word stands."""
    codes, hashes = pd.factorize(word_hashes(words))
    at = np.empty(len(hashes), np.int64)
    at[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, hashes, at


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=_COUNTED):
        words = words_of(batch.column("text"))
        codes, hashes, at = _distinct(words)
        size = words.end[at] - words.start[at]
        ends = np.cumsum(size)
        take = np.arange(size.sum()) + np.repeat(words.start[at] - (ends - size), size)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        text = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(words.data[take].tobytes()))
        n = np.bincount(codes, minlength=len(hashes))
        yield pa.RecordBatch.from_arrays([text, pa.array(hashes.view(np.int64)), pa.array(n)], ["word", "hash", "n"])


def _coded(
    keys: np.ndarray, bounds: np.ndarray, frequent: np.ndarray, log: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Log probability of the held events of each of at most 256 texts; its other events, how often each comes, and bounds of the texts."""
    size = len(bounds) - 1
    # The text in the lowest byte: one sort brings equal events together.
    packed = np.sort(keys.astype(np.uint64) << np.uint64(8) | np.repeat(np.arange(size, dtype=np.uint64), np.diff(bounds)))
    keys, rows = (packed >> np.uint64(8)).astype(np.int64), (packed & np.uint64(255)).astype(np.int64)
    new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    every, code = keys[new], np.cumsum(new) - 1
    place = np.minimum(np.searchsorted(frequent, every), max(len(frequent) - 1, 0))
    is_held = frequent[place] == every if len(frequent) else np.zeros(len(every), np.bool_)
    value = np.where(is_held, log[place], 0) if len(frequent) else np.zeros(len(every))
    sums = np.bincount(rows, value[code], minlength=size)
    rare = packed[~is_held[code]]
    first = np.flatnonzero(np.append(True, rare[1:] != rare[:-1])[: len(rare)])
    times, rare = np.diff(np.append(first, len(rare))), rare[first]
    order = np.argsort(rare & np.uint64(255), kind="stable")
    of = (rare & np.uint64(255))[order].astype(np.int64)
    return sums, (rare >> np.uint64(8)).astype(np.int64)[order], times[order].astype(np.int32), np.searchsorted(of, np.arange(size + 1)).astype(np.int32)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most 256 texts of about ``_SCORED`` bytes."""
    for batch in slices(batches, most=_SCORED):
        for at in range(0, batch.num_rows, 256):
            yield batch.slice(at, 256)


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, hash, n)`` of all different words of ``text``, in lower case."""
    counted = docs.select("text").mapInArrow(releasing(_count_words), "word string, hash bigint, n bigint")
    return counted.groupBy("word", "hash").agg(F.sum("n").alias("n"))


def score_texts(docs: DataFrame, learn: Column) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs``.

    Models are learned from all rows where ``learn`` holds; NULL is false. Tokens are the words in lower
    case (A-Z) and one end; a NULL text is empty and has the end alone. Without rows to learn from all counts
    are 0. Repeated rows are scored alike, each on its own; an empty table gives no rows.

    Frequent words and events of the byte model are known to every task. The others of a text are looked up by a
    shuffle, one row for each different word or event of a text; no text is shuffled.
    """
    spark = docs.sparkSession
    train = docs.where(F.coalesce(learn, F.lit(False)))
    words = write_shared(count_words(train), "words")
    texts = train.count()
    kinds, tokens = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    total, kinds = tokens + texts, kinds + (texts > 0)
    often, all_words = most_used(words, "n", HELD)
    table = often.select("hash", "n").toArrow()
    hashes, counts = table.column("hash").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(hashes)
    divisor = total + _SMOOTH * (kinds + 1)
    model = train_model(docs, learn)
    all_events = model.events is None
    shipped = spark.sparkContext.broadcast((model.keys, model.log, hashes[order], counts[order]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        frequent, frequent_log, known, known_n = shipped.value
        for batch in _pieces(batches):
            words = words_of(batch.column("text"))
            codes, hashes, at = _distinct(words)
            place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            is_often = known[place] == hashes if len(known) else np.zeros(len(hashes), np.bool_)
            n_held = np.where(is_often, known_n[place], 0) if len(known) else np.zeros(len(hashes))
            # Where all words are held, others have no count.
            settled = is_often | all_words
            base = np.log10((n_held + _SMOOTH) / divisor) * settled
            log, keys, key_times, key_bounds = _coded(*event_keys(words), frequent, frequent_log)
            rows = words.rows()
            size = batch.num_rows
            per_row = lambda v: np.bincount(rows, v[codes], minlength=size)
            rare = np.flatnonzero(~settled[codes])
            pairs, n = np.unique(rows[rare] * len(hashes) + codes[rare], return_counts=True)
            bounds = np.searchsorted(pairs // max(len(hashes), 1), np.arange(size + 1)).astype(np.int32)
            word = pairs % max(len(hashes), 1)
            lists = [(bounds, hashes[word].view(np.int64)), (bounds, n.astype(np.int32))]
            lists += [(key_bounds, keys), (key_bounds, key_times)]
            columns = [
                batch.column("doc_id"),
                pa.array((np.int64(task) << 40) + row + np.arange(size)),
                pa.array(np.diff(words.first) + 1),
                pa.array(per_row(is_often.astype(float)).astype(np.int64) + (texts > 0)),
                pa.array(per_row(base) + np.log10((texts + _SMOOTH) / divisor)),
                pa.array(log),
                *(pa.ListArray.from_arrays(pa.array(b), pa.array(v)) for b, v in lists),
            ]
            row += size
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = """doc_id bigint, row bigint, n_tokens bigint, n_known bigint, base_score double, score double,
    hashes array<bigint>, times array<int>, keys array<bigint>, key_times array<int>"""
    names = ["doc_id", "row", "n_tokens", "n_known", "base_score", "score", "hashes", "times", "keys", "key_times"]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = write_shared(rows.mapInArrow(releasing(score), schema), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("hashes", "times")).alias("word"))
    rare = rare.select("row", F.col("word.hashes").alias("hash"), F.col("word.times").alias("times"))
    if all_words and all_events:
        return _result(scored, total)
    found = rare.join(words.select("hash", "n"), "hash", "left")
    n, log = F.coalesce("n", F.lit(0)), F.log10((F.coalesce("n", F.lit(0)) + _SMOOTH) / divisor)
    sums = found.groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("known"), F.sum(log * F.col("times")).alias("log")
    )
    keys = scored.select("row", F.explode(F.arrays_zip("keys", "key_times")).alias("event"))
    keys = keys.select("row", F.col("event.keys").alias("key"), F.col("event.key_times").alias("times"))
    out = scored.join(sums, "row", "left")
    if not all_events:
        coded = keys.join(model.events, "key").groupBy("row").agg(F.sum(F.col("log") * F.col("times")).alias("model"))
        out = out.join(coded, "row", "left").withColumn("score", F.col("score") + F.coalesce("model", F.lit(0.0)))
    known, base = F.coalesce("known", F.lit(0)), F.coalesce("log", F.lit(0.0))
    return _result(out.withColumns({"n_known": F.col("n_known") + known, "base_score": F.col("base_score") + base}), total)


def _result(scored: DataFrame, tokens: int) -> DataFrame:
    return scored.select(
        "doc_id", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score",
        (F.col("score") / F.lit(float(np.log(10)))).alias("score"),
    )
