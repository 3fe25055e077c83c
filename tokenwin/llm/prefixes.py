"""The tree of common beginnings of conversations, measured on its Euler tour.

A node is a distinct sequence of first turns. Turns are told apart by SHA-256 of role and text, and sequences by
sums of SHA-256 of place and turn, so texts are read once and never shuffled. The tour enters and leaves
every node once; its arcs are ranked as a linked list, and what a subtree holds is the difference of two prefix sums.

Conversations are ordered by turn, NULL first; equal turns by role and then by the turn's hash. NULL roles and
texts count as empty. Rows without ``conv_id`` belong to no conversation. Further columns are ignored. An empty table has no nodes,
not even a root. No conversation, parent or group of equal conversations needs to fit one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenwin.llm.listrank import FEW, list_rank
from tokenwin.llm.scans import MODULUS, running_sums
from tokenwin.operators.lookup import lookup
from tokenwin.operators.numbering import number_rows, number_rows_within
from tokenwin.shared import write_shared

_WORD = r"[^\x20\x09-\x0D]+"
# Text of joined ids that is hashed or passed on at a time.
PIECE = 1 << 16


def _lane(hex_digest: Column, at: int) -> Column:
    return F.conv(F.substring(hex_digest, at, 15), 16, 10).cast("bigint")


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, digest, words)``: turns numbered from 0 in their order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).cast("bigint").alias("words"),
    )
    numbered = number_rows_within(rows, "conv_id", ["turn", "role", "digest"], "pos")
    return write_shared(numbered.select("conv_id", "pos", "digest", "words"), "turns")


def rebuild(turns: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``head`` turns are those of the conversation ``base``.

    Both are expressions of ``conv_id``; ``head`` is below 4, and only a bounded number of conversations may share
    a base. Returns ``(conv_id, total)``, one row for each conversation, and ``(conv_id, depth, digest, words, last)``, one for each turn.
    """
    lengths = write_shared(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "lengths")
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = lengths.select("conv_id", "n", base.alias("base"), head.cast("bigint").alias("head")).join(bases, "base", "left")
    taken = F.least("head", F.coalesce("base_n", F.lit(0)))
    plan = plan.withColumn("taken", taken).withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    plan = write_shared(plan.select("conv_id", "base", "head", "taken", "total"), "rebuilt")
    own = lookup(turns, plan.drop("base"), "conv_id", spread=["pos"], how="inner").where("pos >= head")
    own = own.withColumn("depth", F.col("pos") - F.col("head") + F.col("taken") + 1)
    heads = turns.where("pos < 4").withColumnRenamed("conv_id", "base")
    borrowed = plan.where("taken > 0").join(heads, "base").where("pos < taken").withColumn("depth", F.col("pos") + 1)
    columns = ["conv_id", "depth", "digest", "words", (F.col("depth") == F.col("total")).alias("last")]
    return plan.select("conv_id", "total"), own.select(*columns).unionByName(borrowed.select(*columns))


def prefix_tree(totals: DataFrame, turns: DataFrame, few: int = FEW) -> DataFrame:
    """One row per node: its members, place in the tree, leaves and savings below it, and a digest of who ends there.

    ``totals`` and ``turns`` are what ``rebuild`` returns.
    """
    term = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")), 256)
    terms = turns.select("conv_id", "depth", "words", "last", term.alias("t")).select(
        "conv_id", "depth", "words", "last", _lane(F.col("t"), 1).alias("t0"), _lane(F.col("t"), 16).alias("t1")
    )
    summed = running_sums(terms, ["conv_id"], ["depth"], ["t0", "t1"])
    parts = [F.pmod(F.col(f"run_t{i}") - F.col(f"t{i}"), F.lit(MODULUS)).alias(f"p{i}") for i in range(2)]
    paths = summed.select("conv_id", "depth", "words", "last", F.col("run_t0").alias("k0"), F.col("run_t1").alias("k1"), *parts)
    tree = write_shared(_tree(totals, paths), "tree")
    below = _below(tree, few)
    none_end = F.lit(hashlib.sha256(b"").hexdigest())
    zero = F.lit(0).cast("bigint")
    empty = totals.where("total = 0").select(zero.alias("k0"), zero.alias("k1"), "conv_id")
    ends = joined_digests(paths.where("last").select("k0", "k1", "conv_id").unionByName(empty))
    return (
        tree.join(below, "n")
        .join(ends, ["k0", "k1"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("digest", none_end).alias("ends_sha256"),
        )
    )


def _tree(totals: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes numbered so that siblings follow one another, with their parents and children."""
    least = [F.min(c).alias(c) for c in ("conv_id", "depth", "words", "p0", "p1")]
    nodes = paths.groupBy("k0", "k1").agg(*least, F.count("*").alias("n_convs"))
    root = totals.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    constants = {"k0": 0, "k1": 0, "depth": 0, "words": 0, "p0": -1, "p1": -1}
    root = root.select("conv_id", "n_convs", *[F.lit(v).cast("bigint").alias(c) for c, v in constants.items()])
    nodes = write_shared(number_rows(nodes.unionByName(root), ["depth", "p0", "p1", "conv_id"], "n"), "nodes")
    kids = nodes.where("depth > 0").groupBy("p0", "p1").agg(F.min("n").alias("first"), F.max("n").alias("last"), F.count("*").alias("n_children"))
    above = nodes.select(F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("conv_id").alias("parent_conv_id"), F.col("n").alias("parent"))
    parents = write_shared(kids.join(above, ["p0", "p1"]), "parents")
    placed = lookup(nodes, parents.drop("first", "n_children"), ["p0", "p1"], spread=["n"])
    own = parents.select(F.col("parent").alias("n"), "first", "n_children")
    return placed.drop("p0", "p1").join(own, "n", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def tour_arcs(tree: DataFrame) -> DataFrame:
    """Arc 2n enters node n and arc 2n + 1 leaves it; ``next`` follows on the tour, -1 ends it."""
    enter, leave = F.col("n") * 2, F.col("n") * 2 + 1
    down = F.when(F.col("n_children") > 0, F.col("first") * 2).otherwise(leave)
    up = F.when(F.col("parent").isNull(), F.lit(-1)).when(F.col("n") < F.col("last"), enter + 2).otherwise(F.col("parent") * 2 + 1)
    leaf, saved = (F.col("n_children") == 0).cast("bigint"), (F.col("n_convs") - 1) * F.col("words")
    zero = F.lit(0).cast("bigint")
    sides = [
        F.struct(enter.alias("id"), down.alias("next"), leaf.alias("leaf"), saved.alias("saved")),
        F.struct(leave.alias("id"), up.cast("bigint").alias("next"), zero.alias("leaf"), zero.alias("saved")),
    ]
    return tree.select("conv_id", "depth", F.explode(F.array(*sides)).alias("arc")).select("conv_id", "depth", "arc.*")


def _below(tree: DataFrame, few: int) -> DataFrame:
    """``(n, n_leaves, saved_tokens)`` of each subtree, from the prefix sums where the tour enters and leaves it."""
    ranked = list_rank(tour_arcs(tree), ["conv_id", "depth"], few).select("id", "pos", "leaf", "saved")
    sums = running_sums(ranked, [], ["pos"], ["leaf", "saved"])
    inside = [
        F.sum(F.when(F.col("id") % 2 == 1, F.col(f"run_{v}")).otherwise(F.col(v) - F.col(f"run_{v}"))).alias(name)
        for v, name in (("leaf", "n_leaves"), ("saved", "saved_tokens"))
    ]
    return sums.groupBy(F.expr("id div 2").alias("n")).agg(*inside)


def joined_digests(members: DataFrame) -> DataFrame:
    """``(k0, k1, digest)``: SHA-256 of the ids of each key in ascending order, joined by commas.

    The members are range-sorted, so those of a large key spread over tasks, which join them to pieces of text. A key that lies
    within one task is hashed there; the pieces of the others stream through one task each in order, since the hash needs them in turn.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        key, text, open_ = None, [], True  # open: the key began before this task, or a piece of it is out
        held = 0
        rows: list[tuple] = []
        for batch in batches:
            for k0, k1, conv_id in zip(*(batch.column(c).to_pylist() for c in ("k0", "k1", "conv_id"))):
                if (k0, k1) != key:
                    if key is not None:
                        joined = ",".join(text)
                        rows.append((*key, None, part, place, joined) if open_ else (*key, hashlib.sha256(joined.encode()).hexdigest(), None, None, None))
                        place, open_ = place + 1, False
                    key, text, held = (k0, k1), [], 0
                text.append(str(conv_id))
                held += 8
                if held > PIECE:
                    rows.append((*key, None, part, place, ",".join(text)))
                    text, held, place, open_ = [], 0, place + 1, True
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)], _NAMES)
                rows = []
        if text:
            rows = [(*key, None, part, place, ",".join(text))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)], _NAMES)

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            rows = []
            for k0, k1, piece in zip(*(batch.column(c).to_pylist() for c in ("k0", "k1", "piece"))):
                if (k0, k1) == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        rows.append((*key, sha.hexdigest()))
                    key, sha = (k0, k1), hashlib.sha256()
                sha.update(piece.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["k0", "k1", "digest"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, sha.hexdigest())], ["k0", "k1", "digest"])

    pieces = write_shared(
        members.orderBy("k0", "k1", "conv_id").mapInArrow(join, "k0 bigint, k1 bigint, digest string, part int, place int, piece string"), "ends"
    )
    whole = pieces.where("digest is not null").select("k0", "k1", "digest")
    rest = pieces.where("digest is null").repartition("k0", "k1").sortWithinPartitions("k0", "k1", "part", "place")
    return whole.unionByName(rest.select("k0", "k1", "piece").mapInArrow(hash_, "k0 bigint, k1 bigint, digest string"))


_NAMES = ["k0", "k1", "digest", "part", "place", "piece"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string()]
