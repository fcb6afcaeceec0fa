from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from tidemark.llm import ngram_join as nj

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, rep long, token string, label int, n double"


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain(rows, width=5):
    """All pairs that share a shingle, then components over ids."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    index = defaultdict(list)
    for at, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                index[x].append(at)
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    shared = defaultdict(int)
    for at in index.values():
        for n, x in enumerate(at):
            for y in at[:n]:
                shared[x, y] += 1
    for (x, y), both in shared.items():
        if 100 * both >= 80 * (len(sets[x][1]) + len(sets[y][1]) - both):
            a, b = sorted((find(sets[x][0]), find(sets[y][0])))
            parent[b] = a
    return sorted(
        ((i, len(s), find(i) if s and i is not None else i) for i, s in sets), key=lambda r: (r[0] is None, r[0] or 0, r[1])
    )


def same(df, width=5):
    got = [tuple(r) for r in nj.jaccard_components(df, width).select("doc_id", "n_shingles", "component_id").collect()]
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1])) == plain(rows, width)


def family(rng, n, words, edits, start):
    """Copies of one text with so many words replaced each, the least edited one last."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for at in rng.sample(range(words), edits if i < n - 1 else 0):
            text[at] = f"e{rng.randrange(10**6)}"
        out.append((start + i, " ".join(text)))
    return out


def test_components_equal_all_pairs(spark):
    same(spark.read.parquet(f"{SMALL}/documents.parquet"))


@pytest.mark.parametrize("small", [nj.SMALL_BUCKET, 2])
def test_families_and_shared_passages(spark, monkeypatch, small):
    monkeypatch.setattr(nj, "SMALL_BUCKET", small)
    rng = random.Random(5)
    rows = family(rng, 60, 120, 2, 100) + family(rng, 40, 60, 1, 1000) + family(rng, 50, 80, 3, 2000)
    passage = " ".join(f"shared{i}" for i in range(60))
    rows += [(3000 + i, passage + " " + " ".join(f"own{i}x{j}" for j in range(i % 17))) for i in range(60)]
    rows += [(4000 + i, " ".join(f"tail{i}x{j}" for j in range(6)) + " " + passage) for i in range(30)]
    chain = [f"c{i}" for i in range(400)]
    rows += [(5000 + i, " ".join(chain[3 * i : 3 * i + 100])) for i in range(60)]
    same(spark.createDataFrame([(i, t, 1, "t", 1, 0.5) for i, t in rows], SCHEMA))


def test_edge_rows(spark):
    long = " ".join(f"word{i % 97}x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, long), (7, long + " tail"), (7, long + " tail")]
    rows += [(None, "no id here at all"), (None, "one two"), (8, "a b c d e"), (9, "A b c d e"), (9, "x y z u v w"), (10, "x y z u v w")]
    same(spark.createDataFrame([(i, t, 1, "t", 1, 0.5) for i, t in rows], SCHEMA))


def test_nothing(spark):
    assert nj.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
