"""Token-ID files: ids of all texts, Huffman coded in independent blocks, in the order of ids.

The folder ``blocks`` is Parquet with one block a row: the place in the order (``part``, ``place``), the documents'
ids and token counts, their codes one after another, each from a byte on, and checkpoints. The folder
``codes`` has the code length of each token id, from which the canonical codes follow.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tokenwin.llm import huffman, tokenids
from tokenwin.llm.spans import forget_worker_memory, releasing, worker_memory
from tokenwin.llm.tables import sum_vectors
from tokenwin.llm.textbytes import slices
from tokenwin.shared import new_path, write_shared

BLOCK_TOKENS = 1 << 16
END_ID = 1
# Room for the ids of any vocabulary that codes of 16 bits can serve.
_IDS = 1 << huffman.LIMIT
# Ids that are coded at a time.
_PIECE = 1 << 18
_BLOCK = "doc_ids array<bigint>, n_tokens array<int>, marks binary, bits binary"


def _token_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``(doc_id, n_tokens, ids)``: two bytes an id, compressed."""

    with open(tokenizer, encoding="utf-8") as file:
        described = file.read()
    if max(Tokenizer.from_str(described).get_vocab(with_added_tokens=True).values(), default=0) >= _IDS or end_id >= _IDS:
        raise ValueError(f"ids of {_IDS} and more do not fit the file's two bytes")
    shared = docs.sparkSession.sparkContext.broadcast(described)
    key = f"pieces {end_id} {hashlib.sha256(described.encode()).hexdigest()}"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        encoder = worker_memory(key, lambda: tokenids.PieceEncoder(shared.value, end_id))
        for batch in slices(batches, most=1 << 20):
            ids, bounds = encoder.encode(batch.column("text"))
            plain, n = ids.astype("<u2").tobytes(), np.diff(bounds)
            packed = [packer.compress(plain[2 * a : 2 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            columns = [batch.column("doc_id"), pa.array(n.astype(np.int32)), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(releasing(encode), "doc_id bigint, n_tokens int, ids binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of batches of about ``_PIECE`` ids, or one text, with their ids."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        ends, at = np.cumsum(batch.column("n_tokens").to_numpy().astype(np.int64)), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PIECE, "right")))
            piece, at = batch.slice(at, to - at), to
            plain = b"".join(unpacker.decompress(v) for v in piece.column("ids").to_pylist())
            yield piece, np.frombuffer(plain, "<u2").astype(np.int64)


def _token_counts(rows: DataFrame) -> np.ndarray:
    def add(batches: Iterator[pa.RecordBatch], own: np.ndarray) -> None:
        forget_worker_memory()  # the encoder, as all texts are encoded
        for _, ids in _unpacked(batches):
            own += np.bincount(ids, minlength=_IDS)

    return sum_vectors(rows.select("n_tokens", "ids"), add, _IDS)


def _blocks(batches: Iterator[pa.RecordBatch], lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Code documents in their order into blocks of about ``BLOCK_TOKENS``; a longer one is alone."""
    forget_worker_memory()  # the encoder, as all texts are encoded
    names = ["doc_ids", "n_tokens", "marks", "bits"]
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    codes = huffman.canonical_codes(lengths)

    def block(rows: list[tuple]) -> pa.RecordBatch:
        ids, n, marks, bits = (list(v) for v in zip(*rows))
        starts = np.cumsum([0] + [len(b) * 8 for b in bits[:-1]])
        marks = b"".join((m + s).astype("<u4").tobytes() for m, s in zip(marks, starts))
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((ids, n, marks, b"".join(bits)), kinds)], names)

    held, tokens = [], 0
    for piece, ids in _unpacked(batches):
        sizes = piece.column("n_tokens").to_pylist()
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        data, edges, offset = huffman.encode(ids, bounds, codes, lengths)
        for i, (doc_id, n) in enumerate(zip(piece.column("doc_id").to_pylist(), sizes)):
            if held and tokens + n > BLOCK_TOKENS:
                yield block(held)
                held, tokens = [], 0
            marks = offset[bounds[i] : bounds[i + 1] : huffman.EVERY]
            held.append((doc_id, n, marks, data[edges[i] : edges[i + 1]]))
            tokens += n
    if held:
        yield block(held)


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every whole ``text`` and write the ids in ascending order of ``doc_id``.

    A NULL text counts as empty and has the end id alone. Rows without id come first; rows that
    share an id are ordered by their tokens. Without rows the file has no blocks. Only ``doc_id`` and
    ``text`` are read. Texts are encoded once; their ids are kept for the counts and are range-sorted for the blocks.
    """
    spark = docs.sparkSession
    rows = write_shared(_token_ids(docs, tokenizer, end_id), "ids")
    lengths = huffman.code_lengths(_token_counts(rows))
    used = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(used, "id int, bits int").coalesce(1).write.parquet(f"{path}/codes")
    # A hash stands for the ids, as a sample of the sort keys goes to the driver.
    ordered = rows.orderBy(F.col("doc_id").asc_nulls_first(), "n_tokens", F.xxhash64("ids"))
    blocks = ordered.mapInArrow(releasing(lambda batches: _blocks(batches, lengths)), _BLOCK)
    place = F.monotonically_increasing_id()
    blocks.select(F.spark_partition_id().alias("part"), place.alias("place"), "*").write.parquet(f"{path}/blocks")


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """``(part, place, nth, doc_id, ids)``: each document's ids, and its place in the order."""
    return _decoded(spark, path, False)


def _decoded(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    lengths = np.zeros(_IDS, np.uint8)
    # One row for each id of the vocabulary.
    for r in spark.read.parquet(f"{path}/codes").collect():
        lengths[r["id"]] = r["bits"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decode_table(lengths)
        for batch in batches:
            # Some blocks at a time, so that a step of the decoder works on many checkpoints.
            for at in range(0, batch.num_rows, 16):
                yield _decode_blocks(batch.slice(at, 16), table, digest)

    blocks = spark.read.parquet(f"{path}/blocks")
    value = "n_tokens bigint, ids_crc32 bigint" if digest else "ids array<int>"
    return blocks.mapInArrow(releasing(decode), f"part int, place bigint, nth int, doc_id bigint, {value}")


def _decode_blocks(batch: pa.RecordBatch, table: tuple[np.ndarray, np.ndarray], digest: bool) -> pa.RecordBatch:
    docs = batch.column("doc_ids")
    per_block = pc.list_value_length(docs).to_numpy()
    sizes = batch.column("n_tokens").flatten().to_numpy().astype(np.int64)
    bits = batch.column("bits").to_pylist()
    bases = np.cumsum([0] + [len(b) * 8 for b in bits[:-1]])
    marks = [np.frombuffer(m, "<u4") + base for m, base in zip(batch.column("marks").to_pylist(), bases)]
    runs = -(-sizes // huffman.EVERY)
    counts = np.full(int(runs.sum()), huffman.EVERY, np.int64)
    counts[np.cumsum(runs) - 1] = (sizes - 1) % huffman.EVERY + 1  # every text has an id at least
    ids = huffman.decode(b"".join(bits), np.concatenate(marks), counts, table)
    ends = np.cumsum(sizes)
    block = np.repeat(np.arange(len(per_block)), per_block)
    nth = np.arange(len(sizes)) - np.repeat(np.cumsum(per_block) - per_block, per_block)
    keys = [batch.column(n).take(pa.array(block)) for n in ("part", "place")]
    columns = [*keys, pa.array(nth.astype(np.int32)), docs.flatten()]
    names = ["part", "place", "nth", "doc_id"]
    if digest:
        little = ids.astype("<u4").tobytes()
        crc = [zlib.crc32(little[4 * a : 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sizes), pa.array(crc, pa.int64())], [*names, "n_tokens", "ids_crc32"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
    return pa.RecordBatch.from_arrays([*columns, lists], [*names, "ids"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in a file, from its decoded ids.

    ``start`` adds up the counts of each part, of which there is one for each task that wrote, and
    those of the documents before within the part.
    """
    rows = write_shared(_decoded(spark, path, True), "index")
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("own").over(upto), F.lit(0)).alias("first"))
    inside = Window.partitionBy("part").orderBy("place", "nth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("first") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    # One row for each writing task, so the broadcast is bounded by their number.
    return rows.join(F.broadcast(starts), "part").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def token_file_index(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write a token file into the shared folder and read it back as an index."""
    path = new_path(docs.sparkSession, "tokens")
    write_token_file(docs, path, tokenizer, end_id)
    return token_index(docs.sparkSession, path)
