"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its runs of five words in lower case, a shorter text that of all its words.
A weight is the number of times times an inverse document frequency between 1 and ``RARE_GAIN``: full for
runs in at most one of ``RARE`` documents and falling with the logarithm of the share above that. Document
frequencies are those of 2^20 hash buckets, so they are counted over all texts and have a fixed size. The narrow range keeps copies in a
large group alike, whose common runs are frequent only because there are so many copies. Samples are drawn with the same weights.

``BANDS`` bands of ``ROWS`` samples each bring together texts with a band in common; two texts of
similarity 0.8 miss each other in all bands with a probability of 0.002, of 0.9 below 1e-5. Weighted Jaccard
similarity over all runs decides. Texts of a band are compared with one leader; where that leaves a band in several
classes, its texts are joined by their rarest runs, which finds every link between two classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenwin.llm.components import components
from tokenwin.llm.spans import releasing
from tokenwin.llm.tables import sum_vectors
from tokenwin.llm.textbytes import Words, mix, ngram_hashes, slices, word_hashes, words_of
from tokenwin.operators.lookup import fits_broadcast
from tokenwin.shared import row_count, write_shared

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
RARE, RARE_GAIN = 200, 1.25
_BUCKETS = 1 << 20
_STEPS = 1 << 16  # values of each random figure
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _weighted(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different runs of each text in ascending order, how often each comes, and bounds of the texts."""
    runs, bounds = ngram_hashes(word_hashes(words), words.first, WORDS, short=True)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((runs, row))
    runs = runs[order]
    new = np.ones(len(runs), np.bool_)
    new[1:] = (runs[1:] != runs[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(runs)))
    return runs[first], times, np.searchsorted(first, bounds)


def _bucket(runs: np.ndarray) -> np.ndarray:
    return (mix(runs ^ _GOLD) >> np.uint64(44)).astype(np.int64)


def frequencies(docs: DataFrame) -> np.ndarray:
    """In how many rows of ``docs`` each hash bucket of runs occurs; behind them the number of rows."""

    def add(batches: Iterator[pa.RecordBatch], own: np.ndarray) -> None:
        for batch in slices(batches):
            runs, bounds = ngram_hashes(word_hashes(words := words_of(batch.column("text"))), words.first, WORDS, short=True)
            row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            pairs = np.unique(row * _BUCKETS + _bucket(runs))
            own[:_BUCKETS] += np.bincount(pairs % _BUCKETS, minlength=_BUCKETS)
            own[_BUCKETS] += batch.num_rows

    return sum_vectors(docs.select("text"), add, _BUCKETS + 1)


def idf(counts: np.ndarray) -> np.ndarray:
    """Inverse document frequency of each hash bucket."""
    share = np.maximum(counts[:_BUCKETS], 1) / max(counts[_BUCKETS], 1)
    part = np.clip(-np.log(share) / np.log(RARE), 0, 1)
    return (1 + (RARE_GAIN - 1) * part).astype(np.float32)


def _gamma_steps() -> np.ndarray:
    """Quantiles of the sum of two unit exponentials, in the middle of ``_STEPS`` equal parts."""
    p = (np.arange(_STEPS) + 0.5) / _STEPS
    low, high = np.zeros(_STEPS), np.full(_STEPS, 60.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return x.astype(np.float32)


def band_keys(runs: np.ndarray, weights: np.ndarray, bounds: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A key for each text (none of them empty) and band: one hash of the band's consistent weighted samples.

    For each run and sample, r and c are drawn from Gamma(2, 1) and b from [0, 1) by a hash of the run;
    t = floor(ln w / r + b), ln y = r (t - b), and the run with the least ln c - ln y - r is drawn, with its t.
    """
    gamma = _gamma_steps()
    log_gamma = np.log(gamma)
    log_w = np.log(weights).astype(np.float32)
    starts, counts = bounds[:-1], np.diff(bounds)
    keys = np.zeros((len(starts), bands), np.uint64)
    mask, shift = np.uint64(_STEPS - 1), np.uint64(16)
    for k in range(bands * rows):
        h = mix(runs + np.uint64((k + 1) * int(_GOLD) % (1 << 64)))
        r = gamma[h & mask]
        h >>= shift
        log_c = log_gamma[h & mask]
        h >>= shift
        b = (h & mask).astype(np.float32) / np.float32(_STEPS)
        t = np.floor(log_w / r + b)
        value = log_c - r * (t - b) - r
        least = np.minimum.reduceat(value, starts)
        at = np.flatnonzero(value == np.repeat(least, counts))
        drawn = at[np.searchsorted(at, starts)]
        sample = mix(runs[drawn] ^ mix(t[drawn].astype(np.int64).view(np.uint64) + _GOLD))
        band = k // rows
        keys[:, band] = mix(keys[:, band] * np.uint64(3) + sample + np.uint64(band))
    return keys


def _text_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the words of each text in their order."""
    hashes = word_hashes(words)
    rows = words.rows()
    place = (np.arange(len(hashes)) - words.first[:-1][rows]).astype(np.uint64)
    out = []
    for salt in (np.uint64(1), np.uint64(2)):
        each = mix(hashes + mix(place * np.uint64(2) + salt))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each)])
        out.append(mix(sums[words.first[1:]] - sums[words.first[:-1]] + salt).view(np.int64))
    return out[0], out[1]


def signatures(docs: DataFrame, weight: np.ndarray) -> DataFrame:
    """``(doc_id, t1, t2, weight, bands)``: hashes of the words, total weight, band keys (none if empty)."""
    shipped = docs.sparkSession.sparkContext.broadcast(weight)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(batch.column("text"))
            t1, t2 = _text_hashes(words)
            runs, times, bounds = _weighted(words)
            weights = times * shipped.value[_bucket(runs)]
            total = np.concatenate([[0], np.cumsum(weights, dtype=np.float64)])
            some = np.flatnonzero(np.diff(bounds))
            size = np.zeros(batch.num_rows + 1, np.int32)
            keys = np.zeros((0, BANDS), np.uint64)
            if len(some):
                keys = band_keys(runs, weights, np.append(bounds[some], bounds[-1]))
                size[some + 1] = BANDS
            bands = pa.ListArray.from_arrays(pa.array(np.cumsum(size, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))
            columns = [batch.column("doc_id"), pa.array(t1), pa.array(t2), pa.array(np.diff(total[bounds])), bands]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t1", "t2", "weight", "bands"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(releasing(sign), "doc_id bigint, t1 bigint, t2 bigint, weight double, bands array<bigint>")


def _vectors(docs: DataFrame, ids: DataFrame, weight: np.ndarray) -> DataFrame:
    """``(id, t1, runs, weights)`` of the documents named, as sorted hashes and their weights."""
    shipped = docs.sparkSession.sparkContext.broadcast(weight)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(batch.column("text"))
            runs, times, bounds = _weighted(words)
            weights = (times * shipped.value[_bucket(runs)]).astype(np.float32)
            edges = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            blobs = [pa.array([v[a:b].tobytes() for a, b in edges], pa.binary()) for v in (runs, weights)]
            columns = [batch.column("doc_id"), pa.array(_text_hashes(words)[0]), *blobs]
            yield pa.RecordBatch.from_arrays(columns, ["id", "t1", "runs", "weights"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    wanted = ids.select(F.col("id").alias("doc_id"))
    some = rows.join(F.broadcast(wanted) if fits_broadcast(ids, 16) else wanted, "doc_id", "left_semi")
    return some.mapInArrow(releasing(vectors), "id bigint, t1 bigint, runs binary, weights binary")


def weighted_jaccard(x: np.ndarray, wx: np.ndarray, y: np.ndarray, wy: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger weights of two sorted sets."""
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = np.flatnonzero(y[at] == x)
    common = np.minimum(wx[both], wy[at[both]]).sum(dtype=np.float64)
    return common / (wx.sum(dtype=np.float64) + wy.sum(dtype=np.float64) - common)


def _similarities(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(a, b, similarity)`` of each pair; adaptive execution splits the pairs of one text over tasks."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [[np.frombuffer(v, k) for v in batch.column(n).to_pylist()] for n, k in kinds]
            value = np.array([weighted_jaccard(*each) for each in zip(*parts)], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(value)], ["a", "b", "similarity"])

    kinds = [("ra", np.uint64), ("wa", np.float32), ("rb", np.uint64), ("wb", np.float32)]
    left = vectors.select(F.col("id").alias("a"), F.col("runs").alias("ra"), F.col("weights").alias("wa"))
    right = vectors.select(F.col("id").alias("b"), F.col("runs").alias("rb"), F.col("weights").alias("wb"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.select("a", "b", *[n for n, _ in kinds]).mapInArrow(releasing(compare), "a bigint, b bigint, similarity double")


def prefixes(vectors: DataFrame, counts: np.ndarray, similarity: float) -> DataFrame:
    """``(run, id, class, weight, left)``: the rarest runs of each text, those before less than ``similarity`` of its weight is left.

    Two texts of that similarity have as much in common, so the rarest run that they share is among these in both. A run
    in one text alone is left out. ``left`` is the weight of the run and of all that are less rare.
    """
    shipped = vectors.sparkSession.sparkContext.broadcast(counts)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[], [], [], [], []]
            for key, class_, runs, weights in zip(*(batch.column(c).to_pylist() for c in ("id", "class", "runs", "weights"))):
                runs, weights = np.frombuffer(runs, np.uint64), np.frombuffer(weights, np.float32).astype(np.float64)
                often = shipped.value[_bucket(runs)]
                order = np.lexsort((runs, often))
                left = np.cumsum(weights[order][::-1])[::-1]
                # A little more than needed, against rounding.
                some = np.flatnonzero((left >= (similarity - 1e-6) * left[0]) & (often[order] > 1))
                same = (np.full(len(some), v) for v in (key, class_, left[0]))
                for held, values in zip(columns, (runs[order[some]].view(np.int64), *same, left[some])):
                    held.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["run", "id", "class", "weight", "left"])

    schema = "run bigint, id bigint, class bigint, weight double, left double"
    return vectors.select("id", "class", "runs", "weights").mapInArrow(releasing(rarest), schema)


def pairs_between_classes(postings: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: texts of different classes that share a run of ``postings`` and whose weights allow the similarity.

    Nearly all texts of a common run are of one class, and those are not paired with each other: a side of every pair is
    of another class than the run's largest. At the rarest run that two texts share, what is left of either must be as much as
    they need to have in common, which no text with too many runs of its own has.
    """
    classes = postings.groupBy("run", "class").agg(F.count("*").alias("n"))
    largest = F.max_by("class", F.struct("n", "class")).alias("largest")
    several = classes.groupBy("run").agg(largest, F.count("*").alias("kinds")).where("kinds > 1").select("run", "largest")
    rows = write_shared(postings.join(several, "run"), "postings")
    named = {"x": "id", "x_class": "class", "x_weight": "weight", "x_left": "left"}
    left = rows.where("class <> largest").select("run", *[F.col(c).alias(name) for name, c in named.items()])
    other = (F.col("x_class") != F.col("class")) & ((F.col("class") == F.col("largest")) | (F.col("x") < F.col("id")))
    ratio = F.least("weight", "x_weight") / F.greatest("weight", "x_weight")
    need = (F.col("weight") + F.col("x_weight")) * (similarity / (1 + similarity) - 1e-6)
    fits = (F.least("left", "x_left") >= need) & (ratio >= similarity - 1e-6)
    return left.join(rows, "run").where(other & fits).select(*_ordered("x", "id")).distinct()


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, class_id, kept)`` of every row of ``docs(doc_id, text)``.

    Texts are linked if a band brings them together and their weighted similarity reaches the threshold;
    a class is what links connect, and ``class_id`` the smallest id in it, the one that is kept. Texts of the same words
    (in lower case, whatever the blanks) are one node from the start; NULL and empty texts are alike. Rows that share
    an id are one document with the links of all of them. A row without id has no class and is not kept. An empty table gives no rows.

    All texts that share a band could be pairs, but each is compared with the band's leader only, the text that shares most bands
    with others, and then again with the leader of those that are in another class. What links connect needs no further
    comparison. Bands that are still in several classes go through an exact join by rarest runs, which pairs texts of different classes alone.
    """
    counts = frequencies(docs)
    weight = idf(counts)
    signed = write_shared(signatures(docs, weight), "signatures")
    known = signed.where("doc_id is not null")
    nodes = known.groupBy("t1", "t2").agg(
        F.min("doc_id").alias("id"), F.first("weight").alias("weight"), F.first("bands").alias("bands")
    )
    nodes = write_shared(nodes, "nodes")
    members = nodes.select("id", "t1", "weight", F.explode("bands").alias("band")).distinct()
    sizes = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = write_shared(members.join(sizes, "band"), "members")
    degree = shared.groupBy("id").agg(F.sum("n").alias("degree"))
    wanted = write_shared(shared.select("id", "t1").distinct(), "ids")
    members = write_shared(shared.drop("n", "t1").distinct().join(degree, "id"), "members")
    vectors = _vectors(docs, wanted.select("id").distinct(), weight)
    vectors = vectors.join(wanted, ["id", "t1"], "left_semi").dropDuplicates(["id", "t1"]).drop("t1")
    vectors = write_shared(vectors, "vectors")

    # Rows that share an id with other words belong together as well.
    links = known.groupBy("doc_id").agg(F.count_distinct("t1").alias("n")).where("n > 1").select("doc_id")
    links = known.join(links, "doc_id").join(nodes.select("t1", "t2", "id"), ["t1", "t2"])
    links = write_shared(links.select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct(), "links")
    classes = components(links)

    def linked(pairs: DataFrame) -> None:
        nonlocal links, classes
        new = write_shared(_similarities(pairs, vectors).where(F.col("similarity") >= similarity).select("a", "b"), "new")
        if row_count(new):
            links = write_shared(links.unionByName(new), "links")
            classes = components(links)

    for _ in range(2):
        if not row_count(members):
            break
        best = F.max_by(F.struct("id", "weight", "class"), F.struct("degree", -F.col("id"), "weight")).alias("best")
        placed = _classed(members, classes, "id").withColumnRenamed("id_class", "class")
        leaders = placed.groupBy("band").agg(best)
        star = placed.join(leaders, "band").where("id <> best.id and class <> best.class")
        ratio = F.least("weight", "best.weight") / F.greatest("weight", "best.weight")
        linked(star.where(ratio >= similarity).select(*_ordered("id", "best.id")).distinct())
        placed = _classed(members, classes, "id")
        several = placed.groupBy("band").agg(F.min("id_class").alias("low"), F.max("id_class").alias("high")).where("low <> high")
        open_ = placed.join(several.select("band"), "band")
        # In each open band the largest class is done with itself; the best text of the others leads next.
        size = open_.groupBy("band", "id_class").agg(F.count("*").alias("n"))
        largest = size.groupBy("band").agg(F.max_by("id_class", F.struct("n", "id_class")).alias("largest"))
        ahead = F.when(F.col("id_class") == F.col("largest"), F.lit(-1)).otherwise(F.col("degree"))
        members = write_shared(open_.join(largest, "band").withColumn("degree", ahead).select("id", "weight", "band", "degree"), "members")
    if row_count(members):
        open_ = write_shared(members.select("id").distinct(), "open")
        chosen = _classed(vectors.join(F.broadcast(open_) if fits_broadcast(open_, 16) else open_, "id", "left_semi"), classes, "id")
        postings = prefixes(chosen.withColumnRenamed("id_class", "class"), counts, similarity)
        linked(pairs_between_classes(write_shared(postings, "prefixes"), similarity))
    node = _classed(nodes.select("t1", "t2", "id"), classes, "id").select("t1", "t2", F.col("id_class").alias("class_id"))
    out = signed.select("doc_id", "t1", "t2").join(node, ["t1", "t2"], "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.col("class_id"))
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce(F.col("doc_id") == class_id, F.lit(False)).alias("kept"))


def _classed(rows: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    """``rows`` with the class of an id, which is the id itself where it has no link."""
    table = classes.select(F.col("id").alias(column), F.col("component").alias("_class"))
    return rows.join(table, column, "left").withColumn(f"{column}_class", F.coalesce("_class", column)).drop("_class")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are kept, one row for each id.

    Rows without id stay, as no decision names them. Documents move only if the ids to drop do not fit a broadcast.
    """
    out = write_shared(near_duplicates(docs).where("doc_id is not null"), "classes")
    dropped = write_shared(out.where("not kept").select("doc_id").distinct(), "dropped")
    kept = docs.join(F.broadcast(dropped) if fits_broadcast(dropped, 16) else dropped, "doc_id", "left_anti")
    repeated = write_shared(out.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not row_count(repeated):
        return kept
    several = F.broadcast(repeated) if fits_broadcast(repeated, 16) else repeated
    once = kept.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(several, "doc_id", "left_anti").unionByName(once)
