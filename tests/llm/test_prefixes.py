"""The tree of common beginnings against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from compare import differences
from pyspark.sql import functions as F

from tokenwin.llm import prefixes, queries
from tokenwin.llm.listrank import list_rank
from tokenwin.llm.scans import MODULUS, running_sums

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, n string, words int"


def turn_order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    return (turn is not None, turn or 0, role, digest)


def plain_tree(rows):
    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=turn_order):
        own[row[0]].append((row[2] or "", row[3] or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def tree(spark, rows, **options):
    turns = prefixes.conversation_turns(spark.createDataFrame([(*r, 9, "n", 1) for r in rows], SCHEMA))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    found = prefixes.prefix_tree(*prefixes.rebuild(turns, F.col("conv_id") - F.col("conv_id") % 20, head), **options)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("few", [5, 1 << 16])
def test_odd_conversations(spark, few):
    rng = random.Random(4)
    ids = [*range(120), *[7] * 90, 1000, 10**12 + 3]
    rows = [
        (c, rng.choice([None, 0, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.choice([None, "", "x y", " z\n"]))
        for c in ids for _ in range(rng.randint(0, 4))
    ]
    rows += [(None, 0, "a", "of no conversation"), (41, 5, "a", "word " * 50_000), (41, 5, "a", "word " * 50_000)]
    assert tree(spark, rows, few=few) == plain_tree(rows)


def test_a_large_group_of_equal_conversations(spark, partitions, monkeypatch):
    partitions(16)
    rows = [(c, t, "u", f"turn {t}") for c in range(20, 620) for t in range(3)] + [(c, 0, "u", f"own {c}") for c in range(700, 760)]
    assert tree(spark, rows) == plain_tree(rows)
    members = spark.createDataFrame([(1, 2, c) for c in range(40_000)] + [(1, 3, 5)], "k0 bigint, k1 bigint, conv_id bigint")
    found = {tuple(r[:2]): r[2] for r in prefixes.joined_digests(members).collect()}
    assert found == {(1, 2): hashlib.sha256(",".join(map(str, range(40_000))).encode()).hexdigest(), (1, 3): hashlib.sha256(b"5").hexdigest()}


def test_no_conversations(spark):
    assert tree(spark, []) == []
    assert tree(spark, [(None, 1, "a", "b")]) == []


@pytest.mark.parametrize("few", [1, 40, 1 << 16])
def test_list_rank_of_a_shuffled_list(spark, few):
    n = 3000
    order = list(range(n))
    random.Random(2).shuffle(order)
    rows = [(a, b, a * 2) for a, b in zip(order, [*order[1:], -1])]
    arcs = spark.createDataFrame(rows, "id bigint, next bigint, size bigint").withColumnRenamed("size", "twice")
    found = list_rank(arcs, ["id"], few).collect()
    assert sorted((r["pos"], r["id"], r["twice"]) for r in found) == [(i, a, a * 2) for i, a in enumerate(order)]


def test_running_sums_over_many_tasks(spark, partitions):
    partitions(13)
    rng = random.Random(3)
    rows = [(rng.choice([1, 5, 5, 5, 9]), i, rng.randrange(MODULUS)) for i in range(2000)]
    found = running_sums(spark.createDataFrame(rows, "k bigint, at bigint, v bigint").repartition(7), ["k"], ["at"], ["v"])
    sums, want = defaultdict(int), {}
    for k, at, v in rows:
        sums[k] = (sums[k] + v) % MODULUS
        want[at] = sums[k]
    assert {r["at"]: r["run_v"] for r in found.collect()} == want


def test_query_equals_sql_at_two_sizes(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert differences(queries.op11_prefix_tree(spark, sf_dir), queries.oracle_sql()["op11_prefix_tree"], sf_dir) == []
