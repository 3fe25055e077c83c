"""Alignment of two tokenizers over whole texts.

Tokenizer A is byte-level, B a sentencepiece model; both encode a space and the text (B adds it itself).
Byte offsets where tokens of both end cut the text into groups; two tokens are linked where their bytes
overlap. One state vector holds a pointer into A and one into B for every document of a batch. In each
step all pointers are compared at once: the step emits a link for each, a cut where both end, moves
the pointer that ends first, or both, and drops what has come to its end. A long document enters as several
lanes from one common end to another, so that the vector stays long.

Texts that are NULL or empty, or whose tokens do not give back their bytes (a text with U+2581), have
no tokens. Repeated rows and ids are aligned each on their own; an empty table gives no rows. Only
the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tokenwin.llm.spans import Seen, chunk_starts, distinct, gather, worker_memory
from tokenwin.llm.textbytes import plain_text, slices, text_bytes
from tokenwin.llm.tokencount import byte_of_letter, described
from tokenwin.operators.lookup import lookup
from tokenwin.shared import write_shared

# Ids of both tokenizers that a worker remembers, two bytes each, before it starts anew.
REMEMBERED = 1 << 23
# Tokens of A after which a long document may go on in another lane.
LANE = 128
# Pairs of ids that tasks hold with their counts, some 16 bytes each; the rest are joined.
HELD = 1 << 21
_AT_ONCE = 4096
_TOKENS = "doc_id bigint, a binary, b binary"


class Vocabularies(NamedTuple):
    """Descriptions of both tokenizers and the bytes in each of their tokens."""

    a_text: str
    b_model: bytes
    a_bytes: np.ndarray
    b_bytes: np.ndarray


def read_vocabularies(path_a: str, path_b: str) -> Vocabularies:
    with open(path_a, encoding="utf-8") as file:
        a_text = file.read()
    with open(path_b, "rb") as file:
        b_model = file.read()
    vocab = described(a_text)["model"]["vocab"]
    a_bytes = np.zeros(max(Tokenizer.from_str(a_text).get_vocab_size(), max(vocab.values()) + 1), np.int32)
    for token, i in vocab.items():
        a_bytes[i] = len(token)  # a letter a byte
    pieces = _pieces(sentencepiece.SentencePieceProcessor(model_proto=b_model))
    if any(b" " in p.lstrip(b" ") for p in pieces):
        raise ValueError("a piece holds a space after another character, so texts cannot be cut at spaces")
    b_bytes = np.array([len(p) for p in pieces], np.int32)
    if max(len(a_bytes), len(b_bytes)) > 1 << 16:
        raise ValueError("ids are written in two bytes; these vocabularies need more")
    return Vocabularies(a_text, b_model, a_bytes, b_bytes)


def _pieces(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of each piece; U+2581 stands for a space and <0xHH> for a byte."""
    return [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.get_piece_size())
    ]


class PairEncoder:
    """Ids of both tokenizers; each different chunk is encoded once."""

    def __init__(self, vocabularies: Vocabularies):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        self.a = Tokenizer.from_str(vocabularies.a_text)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.b_model)
        self.pieces, self.space = _pieces(self.b), self.b.piece_to_id("▁")
        self._forget()

    def _forget(self) -> None:
        self.seen, self.good = Seen(), np.zeros(0, np.bool_)
        self.flat = [np.zeros(0, np.uint16)] * 2
        self.begin, self.size = [np.zeros(0, np.int32)] * 2, [np.zeros(0, np.int32)] * 2

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        texts = [c.decode() for c in chunks]
        ids: tuple[list, list] = ([], [])
        for at in range(0, len(texts), _AT_ONCE):
            some = texts[at : at + _AT_ONCE]
            ids[0].extend(e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False))
            # The model adds the space to anything but nothing.
            ids[1].extend(row or [self.space] for row in self.b.encode([t[1:] for t in some], num_threads=1))
        piece = self.pieces.__getitem__
        good = [b"".join(map(piece, row)) == chunk for row, chunk in zip(ids[1], chunks)]
        self.good = np.concatenate([self.good, np.array(good, np.bool_)])
        for k in range(2):
            size = np.array([len(x) for x in ids[k]], np.int32)
            begin = len(self.flat[k]) + np.cumsum(size, dtype=np.int32) - size
            self.flat[k] = np.concatenate([self.flat[k], np.array([i for x in ids[k] for i in x], np.uint16)])
            self.begin[k], self.size[k] = np.concatenate([self.begin[k], begin]), np.concatenate([self.size[k], size])
        self.seen.add(hashes)

    def encode(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and B all ids, and the bounds of each text in them."""
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), plain_text(texts), pa.scalar("", pa.large_string()))
        whole, bounds = text_bytes(spaced)
        data = np.frombuffer(whole, np.uint8)
        start = np.flatnonzero(chunk_starts(data, bounds))
        end = np.append(start[1:], len(data))
        codes, hashes, first = distinct(data, start, end)
        slots = self.seen.find(hashes)
        if (slots < 0).any():
            if sum(len(f) for f in self.flat) > REMEMBERED:
                self._forget()
                slots[:] = -1
            new = np.flatnonzero(slots < 0)
            self._learn(hashes[new], [whole[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            slots = self.seen.find(hashes)
        at = np.searchsorted(start, bounds)
        good = np.diff(bounds) > 1
        good[np.repeat(np.arange(len(texts)), np.diff(at))[~self.good[slots][codes]]] = False
        slots = slots[codes]
        out = []
        for k in range(2):
            size = np.where(np.repeat(good, np.diff(at)), self.size[k][slots], 0)
            sums = np.concatenate([[0], np.cumsum(size)])
            out.append((gather(self.flat[k], self.begin[k][slots].astype(np.int64), size), sums[at]))
        return out


class Alignment(NamedTuple):
    """Links as places of tokens in A and B and the text they belong to; tokens at whose ends both cut."""

    link_a: np.ndarray
    link_b: np.ndarray
    row: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> Alignment:
    """Merge the token ends of all texts at once.

    ``end_a`` and ``end_b`` are byte offsets over all texts, ``first_a`` and ``first_b`` the texts' bounds in them.
    Every text has the same bytes in both.
    """
    lane_a, lane_b, stop, row = _lanes(end_a, end_b, first_a, first_b)
    state = np.stack([lane_a, lane_b, np.arange(len(row))])
    cut_a, cut_b = np.zeros(len(end_a), np.bool_), np.zeros(len(end_b), np.bool_)
    links = [np.zeros((3, 0), np.int64)]
    while state.shape[1]:
        links.append(state)
        a, b = end_a[state[0]], end_b[state[1]]
        both = a == b
        cut_a[state[0][both]] = True
        cut_b[state[1][both]] = True
        state = state.copy()
        state[0] += a <= b
        state[1] += b <= a
        open_ = state[0] < stop[state[2]]
        if not open_.all():
            state = state[:, open_]
    all_links = np.concatenate(links, axis=1)
    return Alignment(all_links[0], all_links[1], row[all_links[2]], cut_a, cut_b)


def _lanes(end_a, end_b, first_a, first_b):
    """Where lanes start in A and B, where they stop in A, and their texts.

    A text has a lane and one more for every ``LANE`` tokens, if one of the next sixteen ends where a token of B ends.
    """
    texts = np.flatnonzero(np.diff(first_a) > 0)
    start_a, start_b, row = first_a[texts], first_b[texts], texts
    more = (np.diff(first_a)[texts] - 1) // LANE
    if more.any():
        owner = np.repeat(np.arange(len(texts)), more)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(more) - more, more) + 1
        tries = (start_a[owner] + nth * LANE - 1)[:, None] + np.arange(16)
        inside = tries < first_a[texts[owner] + 1][:, None] - 1
        ends = end_a[np.minimum(tries, len(end_a) - 1)]
        at = np.minimum(np.searchsorted(end_b, ends), len(end_b) - 1)
        found = inside & (end_b[at] == ends)
        some = np.flatnonzero(found.any(axis=1))
        pick = found[some].argmax(axis=1)
        start_a = np.concatenate([start_a, tries[some, pick] + 1])
        start_b = np.concatenate([start_b, at[some, pick] + 1])
        row = np.concatenate([row, texts[owner[some]]])
        order = np.argsort(start_a, kind="stable")
        start_a, start_b, row = start_a[order], start_b[order], row[order]
    stop = np.append(start_a[1:], first_a[-1])
    return start_a, start_b, stop, row


def encode_both(docs: DataFrame, vocabularies: Vocabularies, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, a, b)``: the ids of each text, two bytes each; empty for texts without tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies)
    key = f"pair {hashlib.sha256(vocabularies.a_text.encode() + vocabularies.b_model).hexdigest()}"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_memory(key, lambda: PairEncoder(shared.value))
        for batch in slices(batches):
            columns = [batch.column("doc_id")]
            for ids, bounds in encoder.encode(batch.column("text")):
                offsets = pa.py_buffer((2 * bounds).astype(np.int32))
                columns.append(pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(ids.astype("<u2"))]))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a", "b"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(encode, _TOKENS)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(column.cast(pa.large_binary()))
    return np.frombuffer(data, "<u2").astype(np.int64), bounds // 2


def _aligned(batches: Iterator[pa.RecordBatch], shared) -> Iterator[tuple]:
    """Pieces of batches with their ids, bounds, ends of tokens and alignment."""
    a_bytes, b_bytes = shared.value
    for batch in slices(batches, "a", 1 << 20):
        (a, first_a), (b, first_b) = _ids(batch.column("a")), _ids(batch.column("b"))
        end_a, end_b = np.cumsum(a_bytes[a]), np.cumsum(b_bytes[b])
        yield batch, a, first_a, b, first_b, end_a, lockstep(end_a, end_b, first_a, first_b)


def _widths(tokens: DataFrame, vocabularies: Vocabularies):
    return tokens.sparkSession.sparkContext.broadcast((vocabularies.a_bytes.astype(np.int64), vocabularies.b_bytes.astype(np.int64)))


def links_and_cuts(tokens: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """``(doc_id, links, cuts)``: linked tokens by their places in the text, in order, and byte offsets of cuts.

    Offsets count from the added space on. ``tokens`` comes from ``encode_both``.
    """
    widths = _widths(tokens, vocabularies)
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, first_a, b, first_b, end_a, found in _aligned(batches, widths):
            order = np.lexsort((found.link_b, found.link_a))
            row = found.row[order]
            pairs = pa.StructArray.from_arrays(
                [pa.array((found.link_a[order] - first_a[row]).astype(np.int32)), pa.array((found.link_b[order] - first_b[row]).astype(np.int32))],
                ["a", "b"],
            )
            links = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)), pairs)
            before = np.concatenate([[0], end_a])[first_a]
            cut = np.flatnonzero(found.cut_a)
            owner = np.searchsorted(first_a, cut, "right") - 1
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            cuts = pa.ListArray.from_arrays(pa.array(bounds), pa.array(end_a[cut] - before[owner]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), links.cast(kind), cuts], ["doc_id", "links", "cuts"])

    return tokens.mapInArrow(listed, "doc_id bigint, links array<struct<a:int,b:int>>, cuts array<bigint>")


def pair_counts(tokens: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """``(pair, n, best)``: links of each pair of ids in all texts, and whether its B id has no pair with more.

    ``pair`` is the A id times the size of B's vocabulary, plus the B id. Tasks sum up before the shuffle.
    """
    widths, size_b = _widths(tokens, vocabularies), len(vocabularies.b_bytes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, a, _, b, _, _, found in _aligned(batches, widths):
            own, n = np.unique(a[found.link_a] * size_b + b[found.link_b], return_counts=True)
            merged, at = np.unique(np.concatenate([keys, own]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([sums, n]), len(merged)).astype(np.int64)
            keys = merged
            if len(keys) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])
                keys, sums = keys[:0], sums[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])

    counts = write_shared(tokens.mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = (F.col("pair") % size_b).alias("b")
    # At most as many rows as B has ids.
    most = write_shared(counts.groupBy(b).agg(F.max("n").alias("most")), "best")
    found = lookup(counts.withColumn("b", b), most, "b", spread=["pair"])
    return found.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


_MEASURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint"


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", held: int = HELD) -> DataFrame:
    """One row per document: its tokens, groups and links, how common the links are, and a digest of the groups.

    ``n_best`` counts links whose pair of ids is the most frequent one of its B id in all texts, ties included;
    ``count_sum`` sums the counts of the links' pairs. Tasks hold the counts of all pairs if there are at most
    ``held``, else of those with more than one in ``held`` of all links; links of the others are joined.
    """
    vocabularies = read_vocabularies(path_a, path_b)
    encoded = encode_both(docs, vocabularies, doc_id, text)
    tokens = write_shared(encoded.withColumn("row", F.monotonically_increasing_id()), "tokens")
    counts = write_shared(pair_counts(tokens, vocabularies), "counts")
    rows, links = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    common = counts if rows <= held else counts.where(F.col("n") > links // held)
    known = common.orderBy("pair").toArrow()
    table = [known.column(c).to_numpy() for c in ("pair", "n", "best")]
    shared = docs.sparkSession.sparkContext.broadcast(table)
    measured = _measure(tokens, vocabularies, shared)
    if rows <= held:
        return measured.drop("row", "rare")
    measured = write_shared(measured, "measured")
    asked = measured.select("row", F.explode("rare").alias("r")).select("row", "r.pair", F.col("r.n").alias("times"))
    found = lookup(asked, counts, "pair", spread=["row"], how="inner")
    more = write_shared(
        found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("n") * F.col("times")).alias("_sum")),
        "more",
    )
    whole = lookup(measured.drop("rare"), more, "row", spread=["row"])
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def _measure(tokens: DataFrame, vocabularies: Vocabularies, counts) -> DataFrame:
    """What ``align`` returns as far as the held counts go, and the other pairs of each row."""
    widths, size_b = _widths(tokens, vocabularies), len(vocabularies.b_bytes)
    schema = f"row bigint, doc_id bigint, {_MEASURES}, groups_sha256 string, rare array<struct<pair:bigint,n:bigint>>"
    kind = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = counts.value
        digits = _digits()
        for batch, a, first_a, b, first_b, _, found in _aligned(batches, widths):
            total = batch.num_rows
            asked, back = np.unique(a[found.link_a] * size_b + b[found.link_b], return_inverse=True)
            at = np.minimum(np.searchsorted(pairs, asked), max(len(pairs) - 1, 0))
            held = pairs[at] == asked if len(pairs) else np.zeros(len(asked), np.bool_)
            own_n = np.where(held, n[at], 0) if len(pairs) else np.zeros(len(asked), np.int64)
            own_best = held & best[at] if len(pairs) else held
            row = found.row
            sums = np.zeros(total, np.int64)
            np.add.at(sums, row, own_n[back])
            rare = np.flatnonzero(~held[back])
            keys, times = np.unique(row[rare] * len(asked) + back[rare], return_counts=True) if len(rare) else (rare, rare)
            owner = keys // max(len(asked), 1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner, np.arange(total + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(asked[keys - owner * len(asked)] if len(keys) else np.zeros(0, np.int64)), pa.array(times.astype(np.int64))], ["pair", "n"]),
            )
            groups = np.diff(np.concatenate([[0], np.cumsum(found.cut_a)])[first_a])
            numbers = [np.diff(first_a), np.diff(first_b), groups, np.bincount(row, minlength=total), np.bincount(row[own_best[back]], minlength=total), sums]
            columns = [batch.column("row"), batch.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in numbers), pa.array(_digests(a, first_a, b, first_b, found, digits)), lists.cast(kind)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rare"])

    return tokens.mapInArrow(measure, schema)


def _digits() -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of each id, and how many."""
    text = np.char.mod("%d", np.arange(1 << 16)).astype("S5")
    return text.view(np.uint8).reshape(-1, 5), np.char.str_len(text)


def _digests(a, first_a, b, first_b, found: Alignment, digits) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2`` of each text; an empty string without tokens."""
    table, lengths = digits
    # Within a text A's tokens of a group come first; group numbers go on over all texts.
    group_a, group_b = np.cumsum(found.cut_a) - found.cut_a, np.cumsum(found.cut_b) - found.cut_b
    place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
    total = len(a) + len(b)
    ids, mark = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
    ids[place_a], ids[place_b] = a, b
    mark[place_a[found.cut_a]] = ord("|")
    mark[place_b[found.cut_b]] = ord(";")
    cells = np.empty((total, 6), np.uint8)
    cells[:, :5] = table[ids]
    size = lengths[ids]
    cells[np.arange(total), size] = mark
    text = cells[np.arange(6) <= size[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(size + 1)])[first_a + first_b].tolist()
    return [hashlib.sha256(memoryview(text)[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:])]
