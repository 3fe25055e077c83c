import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tokenwin.llm import huffman, ppm
from tokenwin.llm.tables import sum_vectors
from tokenwin.llm.textbytes import ngram_hashes, slices, word_hashes, words_of
from tokenwin.shared import write_shared

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b.", max_size=30)), max_size=6))
def test_words_are_runs_of_other_bytes_than_blanks(texts):
    words = words_of(pa.array(texts, pa.string()), lower=False)
    found = [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.end)]
    expected = [WORD.findall(t or "") for t in texts]
    assert found == [w for ws in expected for w in ws]
    assert np.diff(words.first).tolist() == [len(ws) for ws in expected]


def test_hash_depends_on_the_word_alone():
    long = "x" * 100
    words = words_of(pa.array([f"ab {long} abc", f"{long} AB abcd abc", "x" * 99]))
    h = word_hashes(words).tolist()
    assert h[0] == h[4] and h[1] == h[3] and h[2] == h[6]
    assert len(set(h)) == 5


def test_runs_stay_within_a_row():
    words = words_of(pa.array(["a b c", "a b", "", "a b c"]))
    runs, bounds = ngram_hashes(word_hashes(words), words.first, 2)
    assert np.diff(bounds).tolist() == [2, 1, 0, 2]
    assert runs[0] == runs[2] == runs[3] and runs[1] == runs[4]
    short, bounds = ngram_hashes(word_hashes(words), words.first, 3, short=True)
    assert np.diff(bounds).tolist() == [1, 1, 0, 1] and short[0] == short[2] != short[1]


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "x" * 50, "", "c"])], ["text"])
    parts = list(slices([batch], most=4))
    assert [v for p in parts for v in p.column("text").to_pylist()] == ["ab", None, "x" * 50, "", "c"]
    assert len(parts) > 1


def test_sums_of_vectors_over_partitions(spark):
    def add(batches, own):
        for b in batches:
            np.add.at(own, b.column("id").to_numpy(), 3)

    total = sum_vectors(spark.range(0, 9000, 1, 7), add, 10_000)
    assert total[:9000].tolist() == [3] * 9000 and not total[9000:].any()


@pytest.mark.parametrize("limit_bound", [False, True])
def test_huffman_round_trip_and_length(limit_bound):
    rng = np.random.default_rng(1)
    counts = (2 ** np.arange(30)).astype(np.int64) if limit_bound else rng.integers(0, 50, 400)
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= huffman.LIMIT and ((lengths > 0) == (counts > 0)).all()
    assert (2.0 ** -lengths[lengths > 0].astype(float)).sum() == pytest.approx(1)
    used = np.flatnonzero(counts)
    ids = rng.choice(used, 5000)
    bounds = np.array([0, 1, 1, 700, 5000])
    data, edges, offset = huffman.encode(ids, bounds, huffman.canonical_codes(lengths), lengths)
    starts, sizes = [], []
    for a, b, edge in zip(bounds, bounds[1:], edges):
        for at in range(a, b, huffman.EVERY):
            starts.append(edge * 8 + offset[at])
            sizes.append(min(huffman.EVERY, b - at))
    out = huffman.decode(data, np.array(starts), np.array(sizes), huffman.decode_table(lengths))
    assert (out == ids).all()


def test_huffman_is_optimal_without_a_limit_in_force():
    import heapq

    counts = np.random.default_rng(2).integers(1, 1000, 300)
    heap, cost = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (huffman.code_lengths(counts) * counts).sum() == cost
    assert huffman.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]


def test_probabilities_add_up_and_follow_the_counts():
    """Events of one range, all symbols asked in some contexts: seen ones, escapes, and contexts never seen."""
    order, blank = ppm.ORDER, 32
    rng = np.random.default_rng(3)
    contexts = [int.from_bytes(bytes(rng.choice([97, 98, 32], order).tolist()), "big") for _ in range(12)] + [int.from_bytes(b"zzzzzz", "big")]
    counts = {(c, s): int(rng.integers(1, 5)) for c in contexts[:10] for s in rng.choice([97, 98, blank, 10], 2).tolist()}
    keys = np.array([c << 8 | s for c in contexts for s in range(256)])
    n = np.array([counts.get((c, s), 0) for c in contexts for s in range(256)])
    columns = [np.full(len(keys), -1), keys, np.zeros(len(keys), int), n, np.ones(len(keys), int)]
    out = ppm._log_probabilities(pa.table([pa.array(c) for c in columns], ["size", "key", "symbol", "n", "uses"]))
    p = np.exp(out.column("log").to_numpy()).reshape(len(contexts), 256)
    assert p.sum(axis=1) == pytest.approx(1, abs=1e-6)
    for (c, s), times in counts.items():
        total = sum(v for (other, _), v in counts.items() if other == c)
        assert p[contexts.index(c), s] == pytest.approx((2 * times - 1) / (2 * total))


def test_the_most_used_rows_are_held(spark):
    uses = write_shared(spark.range(1, 2001).select(F.col("id").alias("uses")), "uses")
    some, complete = ppm.most_used(uses, "uses", 300)
    kept = [r["uses"] for r in some.collect()]
    assert not complete and 200 < len(kept) <= 300 and min(kept) == 2001 - len(kept)
    assert ppm.most_used(uses, "uses", 2000)[1]


def test_counted_events_leave_a_task_in_small_batches(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(bytes(w).decode() for w in rng.integers(97, 101, (60, 4), np.uint8)) for _ in range(40)] + ["z" * 3000, None]
    learned = [i % 3 > 0 for i in range(len(texts))]
    expected = {}
    for text, own in zip(texts, learned):
        for key in ppm.event_keys(words_of(pa.array([text], pa.string())))[0].tolist():
            n, uses = expected.get(key, (0, 0))
            expected[key] = n + own, uses + 1
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(learned)], ["text", "learned"])
    rows = []
    for held in (1 << 22, 20_000, 500):
        monkeypatch.setattr(ppm, "_HELD", held)
        monkeypatch.setattr(ppm, "_BATCH", 16, raising=False)
        monkeypatch.setattr(ppm, "PIECE", 1000)
        out, largest = {}, 0
        rows.append(0)
        for part in ppm._count_events(iter([batch] * 3)):
            largest = max(largest, part.num_rows)
            rows[-1] += part.num_rows
            for row in part.to_pylist():
                n, uses = out.get(row["key"], (0, 0))
                out[row["key"]] = n + row["n"], uses + row["uses"]
        assert out == {key: (3 * n, 3 * uses) for key, (n, uses) in expected.items()}
        assert largest <= 16
    # What is summed up fits in 20,000, what came before does not: each event still leaves once.
    assert rows[0] == rows[1] == len(expected) < rows[2]


def test_scoring_and_counting_hold_little_beside_the_texts():
    """Peak of what numpy and Arrow hold for texts of 6 MB, without the texts."""
    import tracemalloc

    from tokenwin.llm import lm

    rng = np.random.default_rng(5)
    words = [bytes(w).decode() for w in rng.integers(97, 123, (5000, 5), np.uint8)]
    texts = pa.array([" ".join(words[i] for i in rng.integers(0, 5000, 1000)) for _ in range(1000)])
    batch = pa.RecordBatch.from_arrays([texts, pa.array([True] * 1000)], ["text", "learned"])

    def peak(use):
        tracemalloc.start()
        use()
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top / 1e6

    def code():
        for piece in lm._pieces(iter([batch])):
            lm._coded(*ppm.event_keys(words_of(piece.column("text"))), np.arange(5), np.zeros(5))

    assert peak(code) < 60
    assert peak(lambda: [None for _ in lm._count_words(iter([batch]))]) < 60
    assert peak(lambda: [None for _ in ppm._count_events(iter([batch]))]) < 140
