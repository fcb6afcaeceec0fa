"""Benchmark passages in documents, by q-gram counting and banded alignment.

Benchmark items are cut into overlapping windows. A window of L characters that occurs in a
document with at most e edits shares at least L + 1 - q(e + 1) q-grams with it, all on
diagonals at most e apart. Shared q-grams are counted in overlapping bands of diagonals; bands
that reach the bound are verified by alignment inside the band.

Text is compared folded: ASCII letters in lower case, every run of other ASCII characters
except digits as one space. Null and empty texts hold nothing; items that fold to fewer than
MIN_WINDOW characters are too short to be evidence and match nothing. Repeated rows are judged
alike, each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bytesets import BYTE_VALUE, Texts, chunks, mix, powers

#: Length of q-grams, of windows, and the step between windows, in bytes of folded text.
Q, WINDOW, STEP, MIN_WINDOW = 12, 96, 48, 26
#: Edits allowed per character of a window.
EDIT_RATE = 0.055
#: Bytes of benchmark text in one broadcast index; a larger benchmark takes several passes.
BLOCK_BYTES = 2 << 20
_BITS = 22

_FOLD = np.full(256, 0x20, dtype=np.uint8)
for _c in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _FOLD[_c] = _c
_FOLD[65:91] = np.arange(97, 123)


def folded(texts: Texts) -> Texts:
    """Texts as they are compared."""
    data = _FOLD[texts.data]
    if not len(data):
        return texts
    space = data == 0x20
    stay = ~space
    stay[1:] |= space[1:] & ~space[:-1]
    edges = texts.bounds[:-1]
    edges = edges[edges < len(data)]
    stay[edges] = ~space[edges]
    total = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(stay, out=total[1:])
    return Texts(data[stay], total[texts.bounds])


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Unmixed hashes of all q-grams; equal q-grams give equal hashes."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=prefix[1:])
    out = prefix[Q:] - prefix[:n]
    out *= down[:n]
    return out


def _slot(raw: np.ndarray) -> np.ndarray:
    return ((raw * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64)


@dataclass(frozen=True)
class WindowIndex:
    """Windows of a block of benchmark items and an inverted index of their q-grams."""

    items: list
    windows: list[bytes]
    owner: np.ndarray  # item number of a window
    edits: np.ndarray
    least: np.ndarray  # q-grams a window must share
    grams: np.ndarray  # sorted distinct q-gram hashes
    first: np.ndarray  # where a q-gram's postings begin
    window: np.ndarray
    place: np.ndarray
    present: np.ndarray  # by slot: whether any q-gram falls there


def build_index(items: list[tuple[object, str | None]]) -> WindowIndex:
    texts = [(t or "").encode("utf-8", "replace") for _, t in items]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    low = folded(Texts(np.frombuffer(b"".join(texts), dtype=np.uint8), bounds))
    windows, owner = [], []
    for i in range(len(items)):
        text = low.data[low.bounds[i] : low.bounds[i + 1]].tobytes().rstrip(b" ")
        if len(text) < MIN_WINDOW:
            continue
        last = max(0, len(text) - WINDOW)
        for at in sorted({*range(0, last + 1, STEP), last}):
            windows.append(text[at : at + WINDOW])
            owner.append(i)
    size = np.array([len(w) for w in windows], dtype=np.int64)
    edits = np.floor(size * EDIT_RATE).astype(np.int64)
    least = np.maximum(1, size + 1 - Q * (edits + 1))
    raw, of, place = [], [], []
    for k, w in enumerate(windows):
        h = _gram_hashes(np.frombuffer(w, dtype=np.uint8))
        raw.append(h)
        of.append(np.full(len(h), k, dtype=np.int32))
        place.append(np.arange(len(h), dtype=np.int32))
    raw = np.concatenate(raw) if raw else np.zeros(0, np.uint64)
    of = np.concatenate(of) if of else np.zeros(0, np.int32)
    place = np.concatenate(place) if place else np.zeros(0, np.int32)
    order = np.argsort(raw, kind="stable")
    grams, first = np.unique(raw[order], return_index=True)
    present = np.zeros(1 << _BITS, dtype=bool)
    present[_slot(grams)] = True
    return WindowIndex(
        [i for i, _ in items], windows, np.array(owner, dtype=np.int64), edits, least, grams,
        np.append(first, len(raw)), of[order], place[order], present,
    )


def edit_distance_within(window: bytes, region: bytes) -> int:
    """Least edits between the window and any substring of the region."""
    if window in region:
        return 0
    text = np.frombuffer(region, dtype=np.uint8)
    places = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype=np.int64)
    for c in window:
        after = row + 1
        np.minimum(after[1:], row[:-1] + (text != c), out=after[1:])
        row = np.minimum.accumulate(after - places) + places
    return int(row.min())


def _hits(low: Texts, index: WindowIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in the text data, window, place in the window) of every shared q-gram."""
    raw = _gram_hashes(low.data)
    at = np.flatnonzero(index.present[_slot(raw)]) if len(raw) else np.zeros(0, np.int64)
    found = np.searchsorted(index.grams, raw[at])
    found[found == len(index.grams)] = 0
    real = index.grams[found] == raw[at] if len(index.grams) else np.zeros(len(at), bool)
    at, found = at[real], found[real]
    doc = np.searchsorted(low.bounds, at, "right") - 1
    inside = at + Q <= low.bounds[doc + 1]
    at, found = at[inside], found[inside]
    count = index.first[found + 1] - index.first[found]
    each = np.repeat(np.arange(len(at)), count)
    posting = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + index.first[found][each]
    return at[each], index.window[posting], index.place[posting]


def leaks(texts: Texts, index: WindowIndex) -> list[tuple[int, int, int, int]]:
    """(text number, item number, verified windows, least edits), one per text and item."""
    low = folded(texts)
    at, window, place = _hits(low, index)
    if not len(at):
        return []
    doc = np.searchsorted(low.bounds, at, "right") - 1
    diagonal = at - place
    width = 2 * (index.edits[window] + 1)
    tried: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for shift in (np.zeros_like(width), width // 2):
        band = (diagonal + shift) // width
        key = mix(
            mix(doc.astype(np.uint64) * np.uint64(0x10001) + window.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            + band.astype(np.uint64)
        )
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        for i in first[count >= index.least[window[first]]]:
            start = int(band[i] * width[i] - shift[i])
            tried.setdefault((int(doc[i]), int(window[i])), []).append((start, start + int(width[i])))
    best: dict[tuple[int, int], list[int]] = {}
    for (d, w), bands in tried.items():
        lo, hi = low.bounds[d], low.bounds[d + 1]
        text, budget = index.windows[w], int(index.edits[w])
        least = min(
            edit_distance_within(
                text, low.data[max(lo, a - budget) : min(hi, b + len(text) + budget)].tobytes()
            )
            for a, b in bands
        )
        if least <= budget:
            seen = best.setdefault((d, int(index.owner[w])), [0, least])
            seen[0] += 1
            seen[1] = min(seen[1], least)
    return [(d, item, n, least) for (d, item), (n, least) in sorted(best.items())]


def _indexes(docs: DataFrame, benchmark: DataFrame) -> Iterator:
    """Broadcast indexes of the benchmark, block by block."""
    context, block, size = docs.sparkSession.sparkContext, [], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        length = len(row["text"] or "")
        if block and size + length > BLOCK_BYTES:
            yield context.broadcast(build_index(block))
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += length
    yield context.broadcast(build_index(block))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item found in it: doc_id, item_id, n_windows
    (verified windows) and edits (the least of them)."""
    source = docs.select("doc_id", "text")
    doc_type = source.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    out = None
    for shared in _indexes(docs, benchmark):

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                for lo, _, texts in chunks(batch.column(1)):
                    found = leaks(texts, index)
                    if found:
                        rows = pa.array([lo + d for d, *_ in found], pa.int64())
                        items = [index.items[i] for _, i, *_ in found]
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(rows),
                                pa.array(items, pa.int32() if item_type == "int" else pa.int64() if item_type == "bigint" else pa.string()),
                                pa.array([n for *_, n, _ in found], pa.int64()),
                                pa.array([e for *_, e in found], pa.int64()),
                            ],
                            ["doc_id", "item_id", "n_windows", "edits"],
                        )

        part = source.mapInArrow(
            run, f"doc_id {doc_type}, item_id {item_type}, n_windows long, edits long"
        )
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, unchanged and without a shuffle."""
    for shared in _indexes(docs, benchmark):

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                at = batch.schema.get_field_index("text")
                for lo, hi, texts in chunks(batch.column(at)):
                    clean = np.ones(hi - lo, dtype=bool)
                    clean[[d for d, *_ in leaks(texts, index)]] = False
                    yield batch.slice(lo, hi - lo).filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
