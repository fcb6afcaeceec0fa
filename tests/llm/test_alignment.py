from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tidemark.llm import alignment as al

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
SCHEMA = "doc_id long, text string, row long, a int, n string"


def plain_groups(texts):
    """Groups (a ids, b ids) of every text, by the files' own libraries, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(al.BYTE_BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=al.PIECE_BPE)
    letters = al._byte_letters()
    out = []
    for text in texts:
        text = text or ""
        want = (" " + text).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        spell_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        spell_b = [
            bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
            for i in b for p in [second.id_to_piece(i)]
        ]
        if not text or b"".join(spell_a) != want or b"".join(spell_b) != want:
            out.append([])
            continue
        groups, i, j, at_a, at_b, own_a, own_b = [], 0, 0, 0, 0, [], []
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                own_a.append(a[i])
                at_a += len(spell_a[i])
                i += 1
            else:
                own_b.append(b[j])
                at_b += len(spell_b[j])
                j += 1
            if at_a == at_b and own_a and own_b:
                groups.append((own_a, own_b))
                own_a, own_b = [], []
        out.append(groups)
    return out


def plain_rows(rows):
    groups = plain_groups([t for _, t in rows])
    count, best = Counter(), defaultdict(int)
    for own in groups:
        for pair in {(a, b) for x, y in own for a in x for b in y}:
            count[pair] += 1
    for (a, _), c in count.items():
        best[a] = max(best[a], c)
    out = Counter()
    for (doc, _), own in zip(rows, groups, strict=True):
        links = [(a, b) for x, y in own for a in x for b in y]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in own)
        out[
            doc, sum(len(x) for x, _ in own), sum(len(y) for _, y in own), len(own), len(links),
            sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if own else "",
        ] += 1
    return out


def same(df):
    want = plain_rows([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    got = Counter(tuple(r) for r in al.cross_tokenizer_alignment(df).select(*COLUMNS).collect())
    assert got == want


EDGE_TEXTS = [
    None, "", " ", "  two  spaces ", "<s> </s> <|endoftext|> <unk>", "▁ already", "tab\tnew\nline\r\n", "\x00 nul",
    "naïve 東京 🙂🙂 é ﬁ ½", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "١٢٣ ​﻿", "same text here",
]


@pytest.mark.parametrize("frequent", [al.FREQUENT, 40, 0])
def test_alignment_equals_plain_walk(spark, monkeypatch, frequent):
    monkeypatch.setattr(al, "FREQUENT", frequent)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    if frequent != al.FREQUENT:
        docs = docs.limit(60)
    same(docs)


def test_alignment_of_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(al, "LINKS", 7)
    rows = [(i, t, 1, 2, "n") for i, t in enumerate(EDGE_TEXTS)]
    rows += [(50, "same text here", 1, 2, "n")] * 2 + [(None, "same text", None, None, None)]
    rows += [(60, "word " * 30_000 + "x" * 20_000, 1, 2, "n")]
    same(spark.createDataFrame(rows, SCHEMA))


def test_alignment_of_nothing(spark):
    assert al.cross_tokenizer_alignment(spark.createDataFrame([], SCHEMA)).count() == 0


def test_alignment_lists(spark):
    docs = spark.createDataFrame([(1, "Hello strange worlds"), (2, "")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in al.alignments(docs).collect()}
    assert rows[2]["a_ids"] == [] and rows[2]["b_groups"] == []
    got = defaultdict(lambda: ([], []))
    for k, side in enumerate("ab"):
        for i, g in zip(rows[1][f"{side}_ids"], rows[1][f"{side}_groups"], strict=True):
            got[g][k].append(i)
    assert [got[g] for g in sorted(got)] == plain_groups(["Hello strange worlds"])[0]
    assert rows[1]["a_ends"][-1] == rows[1]["b_ends"][-1] == len(" Hello strange worlds")


def test_every_character_has_the_files_ids():
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(al.BYTE_BPE)
    with open(al.BYTE_BPE, "rb") as f:
        side = al.byte_side(f.read())
    texts = [f"a{chr(c)}1 {chr(c)} b{chr(c)}{chr(c)}!" for c in range(0x80, 0x3000)]
    want = [e.ids for e in first.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert side.encode(texts) == want


def test_pairs_of_an_empty_chunk():
    with open(al.BYTE_BPE, "rb") as f, open(al.PIECE_BPE, "rb") as g:
        a, b = al.byte_side(f.read()), al.piece_side(g.read())
    found = al.align(pa.array([None, ""], pa.string()), a, b)
    assert al.linked_pairs(found).num_rows == 0 and al.group_texts(found, a, b) == [b"", b""]
