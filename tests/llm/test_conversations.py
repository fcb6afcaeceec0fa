from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations as cv

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, node long, depth int"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda t: hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest()
    order = lambda t: (*t[:2], int(digest(t)[:15], 16), int(digest(t)[16:31], 16))
    own = {c: [t[2:] for t in sorted(v, key=order)] for c, v in turns.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:]
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
            if d:
                kids[tuple(v[: d - 1])].add(tuple(v[:d]))
        ends[tuple(v)].append(c)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        own_saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        leaves = sum(total[k][0] for k in kids[p]) if kids[p] else 1
        total[p] = (leaves, own_saved + sum(total[k][1] for k in kids[p]))
    return {
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *total[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    }


def same(df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = cv.trie_digest(df).select(*COLUMNS).collect()
    want = plain_trie(rows)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_trie_equals_plain_trie(spark):
    same(spark.read.parquet(f"{SMALL}/conversations.parquet"))


def test_trie_of_edge_rows(spark):
    rows = [(c, t, "user" if t % 2 else "bot", f"é{t}" * (1 + (c + t) % 2)) for c in range(40) for t in range(c % 12)]
    rows += [(0, t, "u", "same") for t in range(300)] + [(5, t, "u", "same") for t in range(290)]
    rows += [(7, None, None, None), (7, None, "u", ""), (8, 3, "u", "x"), (8, 3, "u", "x")]
    rows += [(None, 1, "u", "lost"), (1003, 0, "u", "word " * 60_000), (-7, 1, "u", "below")]
    same(spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA))


def test_trie_of_nothing(spark):
    assert cv.trie_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_list_is_digested_in_pieces(spark, monkeypatch):
    ends = spark.range(2000).select((F.col("id") % 3 == 0).cast("long").alias("node"), F.col("id").alias("conv_id"))
    got = {r["node"]: r["ends_sha256"] for r in cv.ends_digests(ends).collect()}
    for node in (0, 1):
        ids = [str(i) for i in range(2000) if (i % 3 == 0) == node]
        assert got[node] == hashlib.sha256(",".join(ids).encode()).hexdigest()


@pytest.mark.parametrize("shape", ["chain", "star", "comb"])
def test_totals_of_trees(spark, shape):
    n = 200
    parent = {"chain": lambda i: i - 1, "star": lambda i: 0, "comb": lambda i: i - 2 if i % 2 else i - 1}[shape]
    rows = [(i * 3, None if i == 0 else max(parent(i), 0) * 3, i) for i in range(n)] + [(9999, None, 5)]
    df = spark.createDataFrame(rows, "node long, parent long, v long")
    want = {i: v for i, _, v in rows}
    for i, p, _ in reversed(rows):
        if p is not None:
            want[p] += want[i]
    assert {r["node"]: r["v"] for r in cv.subtree_totals(df, ["v"]).collect()} == want
