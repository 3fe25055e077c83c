"""Prediction by partial matching over the bytes of whole texts, with all counted contexts.

A text is coded as its words, a blank after each, and an end symbol. A byte's context is what precedes it, over
blanks and words, up to ``ORDER`` bytes; contexts of any count take part. An event is a byte with its context, the
latest byte first. Events in that order are the leaves of the context trie from left to right: those of a context of any size lie
together. So the events are dealt out by ranges once, and each task finds all contexts of its range in its own rows. Only
contexts that reach over the edge of a range, at most one of each size for each edge, are counted beforehand and sent to the tasks on
both sides.

Of N symbols in a context, T of them different, one that came n times has probability
(2 n - 1) / (2 N), and T / (2 N) is left to escape. A symbol not seen is coded in the next shorter
context, whose probabilities are spread over the symbols that the escape has not excluded; in the empty context all
bytes left are equally likely. Without texts to learn from the empty context has one end.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.llm.spans import releasing, releasing_group
from tokenwin.llm.textbytes import Words, slices, words_of
from tokenwin.shared import row_count, write_shared

ORDER = 6
# Events that tasks hold with their probabilities, 12 bytes each; the others are joined.
HELD = 1 << 22
# Events of one range on average.
RANGE = 1 << 20
# Bytes of text that are taken apart at a time, counted events that a task collects, eight bytes each, and those it hands over at a time.
PIECE = 1 << 20
_HELD = 1 << 22
_BATCH = 1 << 16
_BLANK, _END = 0x20, 0x0A


class Model(NamedTuple):
    """What each task holds of the model, and the table of all the rest, None if there is no rest."""

    keys: np.ndarray  # the most used events in ascending order
    log: np.ndarray  # and their natural log probabilities
    events: DataFrame | None  # (key, log) of all events of the texts


def event_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """An event for each byte of the texts, and the bounds of the texts in them.

    Before a text there are ``ORDER`` blanks, which never follow each other within it. The highest byte of a key is the
    one just before, the lowest the symbol.
    """
    size = words.end - words.start
    texts = len(words.first) - 1
    rows = words.rows()
    coded = np.bincount(rows, size + 1, minlength=texts).astype(np.int64) + 1
    bounds = np.concatenate([[0], np.cumsum(coded)])
    ends = np.cumsum(size)
    take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(words.start - (ends - size), size)
    # Text r starts after ORDER blanks; a word moves by the blanks and ends before it.
    moved = np.arange(len(size)) + rows * (1 + ORDER) + ORDER
    data = np.full(int(bounds[-1]) + ORDER * texts + 8, _BLANK, np.uint8)
    data[np.arange(len(take)) + np.repeat(moved, size)] = words.data[take]
    place = np.arange(bounds[-1]) + np.repeat(ORDER * np.arange(1, texts + 1), coded)
    data[place[bounds[1:] - 1]] = _END
    eight = np.ndarray((len(data) - 7,), "<i8", data, strides=(1,))[place - ORDER]
    context, symbol = eight & ((np.int64(1) << (8 * ORDER)) - 1), (eight >> (8 * ORDER)) & 255
    return context << 8 | symbol, bounds


def _parts(packed: np.ndarray) -> Iterator[np.ndarray]:
    """Some ``_BATCH`` sorted events at a time, all of a key together."""
    eight, at = np.uint64(8), 0
    while at < len(packed):
        to = len(packed)
        if at + _BATCH < to:
            # The last key is left to the next part, unless it is the only one.
            cut = packed[at + _BATCH] >> eight
            to = int(np.searchsorted(packed, (cut + np.uint64(cut == packed[at] >> eight)) << eight))
        yield packed[at:to]
        at = to


def _compact(held: list[np.ndarray]) -> np.ndarray:
    """The events of ``held``, which is emptied: sorted, and as few as there can be. They are written over the sorted ones."""
    packed = np.concatenate(held)
    held.clear()
    packed.sort()
    seven, most, size = np.uint64(7), np.uint64(127), 0
    for part in _parts(packed):
        marked = part >> seven
        new = np.flatnonzero(np.append(True, marked[1:] != marked[:-1]))
        marked, times = marked[new] << seven, np.add.reduceat(part & most, new)
        full = (times - np.uint64(1)) // most
        out = np.repeat(marked | most, full.astype(np.int64) + 1)
        out[np.cumsum(full.astype(np.int64) + 1) - 1] = marked | times - full * most
        packed[size : size + len(out)] = out
        size += len(out)
    return packed[:size].copy()


def _summed(packed: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(key, n, uses)`` of sorted events."""
    for part in _parts(packed):
        keys, learned, times = part >> np.uint64(8), (part >> np.uint64(7)) & np.uint64(1), part & np.uint64(127)
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sums = [np.add.reduceat(v.astype(np.int64), new) for v in (times * learned, times)]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (keys[new].astype(np.int64), *sums)], ["key", "n", "uses"])


def _count_events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events with their times learned and their uses, summed over many texts before they leave the task.

    A task holds them as key, whether it is learned, and up to 127 times, in 56, 1 and 7 bits.
    """
    held, rows = [], 0
    for batch in slices(batches, most=PIECE):
        keys, bounds = event_keys(words_of(batch.column("text")))
        learned = np.repeat(batch.column("learned").to_numpy(zero_copy_only=False).astype(np.int64), np.diff(bounds))
        marked, times = np.unique(keys << 1 | learned, return_counts=True)
        while len(marked):
            held.append(marked.astype(np.uint64) << np.uint64(7) | np.minimum(times, 127).astype(np.uint64))
            rows += len(marked)
            more = times > 127
            marked, times = marked[more], times[more] - 127
        if rows > _HELD:
            held = [_compact(held)]
            rows = len(held[0])
            if rows > _HELD * 3 // 4:
                yield from _summed(held.pop())
                rows = 0
    if rows:
        yield from _summed(_compact(held))


def _prefix(keys: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes before each event, the latest first."""
    return keys >> (8 * (ORDER - size) + 8)


def _edge_counts(events: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """``(size, key, symbol, n)`` of the contexts that reach over an edge; ``edges`` has them by size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            for size, names in enumerate(edges):
                own = _prefix(keys, size)
                some = np.isin(own, names) & (n > 0)
                pairs, at = np.unique(own[some] << 8 | keys[some] & 255, return_inverse=True)
                sums = np.bincount(at, n[some], len(pairs)).astype(np.int64)
                columns = [np.full(len(pairs), size, np.int32), pairs >> 8, (pairs & 255).astype(np.int32), sums]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["size", "key", "symbol", "n"])

    counted = events.mapInArrow(releasing(count), "size int, key bigint, symbol int, n bigint")
    return counted.groupBy("size", "key", "symbol").agg(F.sum("n").alias("n"))


def _log_probabilities(group: pa.Table) -> pa.Table:
    """``(key, uses, log)`` of the events of a range, from themselves and the contexts at its edges."""
    size, key, symbol, n, uses = (group.column(c).to_numpy() for c in ("size", "key", "symbol", "n", "uses"))
    own = size < 0
    events, uses, learned = key[own], uses[own], n[own]
    seen, times = events[learned > 0], learned[learned > 0]
    levels, shorter = [], None
    for k in range(ORDER + 1):
        edge = size == k
        inner = ~np.isin(_prefix(seen, k), key[edge])
        pairs = np.concatenate([_prefix(seen[inner], k) << 8 | seen[inner] & 255, key[edge] << 8 | symbol[edge]])
        pairs, at = np.unique(pairs, return_inverse=True)
        count = np.bincount(at, np.concatenate([times[inner], n[edge]]), len(pairs))
        if k == 0 and not len(pairs):
            pairs, count = np.array([_END]), np.ones(1)
        names, first = np.unique(pairs >> 8, return_index=True)
        kinds = np.diff(np.append(first, len(pairs)))
        total = np.add.reduceat(count, first) if len(first) else count
        p = (2 * count - 1) / (2 * np.repeat(total, kinds))
        left = 256.0 - kinds
        if k and len(pairs):
            # What the context without its first byte gives to symbols seen here is excluded after an escape.
            excluded = shorter[1][np.searchsorted(shorter[0], pairs >> 16 << 8 | pairs & 255)]
            left = 1 - np.add.reduceat(excluded, first)
        levels.append((names, np.log(kinds / (2 * total) / np.maximum(left, 1e-12)), pairs, np.log(p)))
        shorter = pairs, p
    value, open_ = np.zeros(len(events)), np.arange(len(events))
    for k in range(ORDER, -1, -1):
        names, escape, pairs, log = levels[k]
        if not len(names):
            continue
        context = _prefix(events[open_], k)
        wanted = context << 8 | events[open_] & 255
        at = np.minimum(np.searchsorted(pairs, wanted), len(pairs) - 1)
        found = pairs[at] == wanted
        value[open_[found]] += log[at[found]]
        node = np.minimum(np.searchsorted(names, context), len(names) - 1)
        escapes = ~found & (names[node] == context)
        value[open_[escapes]] += escape[node[escapes]]
        open_ = open_[~found]
    return pa.table([events, uses, value], ["key", "uses", "log"])


def most_used(df: DataFrame, uses: str, held: int) -> tuple[DataFrame, bool]:
    """Rows of the highest uses, ``held`` at most, and whether these are all rows.

    Uses are compared by steps of a sixteenth of a doubling, so counting the rows by step gives some thousand numbers at most.
    """
    if row_count(df) <= held:
        return df, True
    step = F.floor(F.log2(uses) * 16)
    rows, cut = 0, None
    for r in sorted(df.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        rows += r["count"]
        if rows > held:
            break
        cut = r["step"]
    return df.where(step >= cut if cut is not None else F.lit(False)), False


def train_model(docs: DataFrame, learn: Column) -> Model:
    """Log probability of every event of ``docs(text)``, learned from the rows where ``learn`` holds."""
    spark = docs.sparkSession
    learned = docs.select("text", F.coalesce(learn, F.lit(False)).alias("learned"))
    events = learned.mapInArrow(releasing(_count_events), "key bigint, n bigint, uses bigint")
    # Tasks have summed their events, so these are dealt out at once, without a table of them in the executor before.
    events = write_shared(events.repartition("key").groupBy("key").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")), "events")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-row_count(events) // RANGE))
    found = events.approxQuantile("key", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if row_count(events) else []
    cuts = np.unique(np.array(found, np.float64).astype(np.int64))
    # An edge lies between two keys; of each size only the context that holds the cut itself can reach over it.
    edges = [np.unique(_prefix(cuts, k)) for k in range(ORDER + 1)]
    needs = {(i + side, k, int(_prefix(c, k))) for i, c in enumerate(cuts) for side in (0, 1) for k in range(ORDER + 1)}
    # A dozen rows for each range, whatever it holds.
    columns = [pa.array([n[i] for n in needs], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.int64()))]
    needed = F.broadcast(spark.createDataFrame(pa.table(columns, ["range", "size", "key"])))
    at_edges = write_shared(_edge_counts(events, edges), "edges").join(needed, ["size", "key"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.searchsorted(cuts, batch.column("key").to_numpy(), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(of), *batch.columns], ["range", "key", "n", "uses"])

    placed = events.mapInArrow(releasing(place), "range int, key bigint, n bigint, uses bigint")
    columns = ["range", "size", "key", "symbol", "n", "uses"]
    placed = placed.withColumns({"size": F.lit(-1), "symbol": F.lit(0)}).select(*columns)
    whole = placed.unionByName(at_edges.withColumn("uses", F.lit(0).cast("bigint")).select(*columns))
    logs = whole.groupBy("range").applyInArrow(releasing_group(_log_probabilities), "key bigint, uses bigint, log double")
    logs = write_shared(logs, "logs")
    often, complete = most_used(logs, "uses", HELD)
    table = often.select("key", F.col("log").cast("float").alias("log")).toArrow()
    keys, log = table.column("key").to_numpy(), table.column("log").to_numpy()
    order = np.argsort(keys)
    return Model(keys[order], log[order], None if complete else logs.select("key", "log"))
