"""Quality rules: exact counts of a text, and a learned verdict beside them.

The verdict is a logistic regression over hashed word and character n-grams, fitted on
labelled rows, calibrated, and held against a fixed threshold. Null texts count as empty;
a text without words fails the base rule.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesets import WHITE, Texts, chunks, windows
from tidemark.llm.linear import LinearModel, fit_on_sample, logits

#: Buckets of the hashed features (2 to this power).
BITS = 18
#: The classifier is fitted on at most this many labelled rows.
MAX_LABELLED = 6_000
#: Kept from this calibrated probability of good quality on.
KEEP_FROM = 0.5
#: Fixed limits of the base rule.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_POINT = np.ones(256, dtype=bool)  # bytes that begin a code point
_POINT[0x80:0xC0] = False
_NOT_NEWLINE = np.ones(256, dtype=bool)
_NOT_NEWLINE[0x0A] = False


def _per_text(flags: np.ndarray, texts: Texts) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[texts.bounds[1:]] - total[texts.bounds[:-1]]


def _repeated(keys: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: equal to another key of the group; equal to an earlier one."""
    n = len(keys)
    order = np.lexsort((np.arange(n), keys, group))
    same = np.zeros(n, dtype=bool)
    same[1:] = (keys[order][1:] == keys[order][:-1]) & (group[order][1:] == group[order][:-1])
    any_same, earlier = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    earlier[order] = same
    either = same.copy()
    either[:-1] |= same[1:]
    any_same[order] = either
    return any_same, earlier


def counts(texts: Texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text."""
    n = len(texts)
    start, end, doc = texts.words()
    out = {"n_words": np.bincount(doc, minlength=n)}
    data = texts.data
    out["word_chars"] = _per_text(~WHITE[data] & _POINT[data], texts)
    out["n_symbols"] = _per_text(_SYMBOL[data], texts)

    l_start, l_end, l_doc = texts.runs(_NOT_NEWLINE)
    marks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(~WHITE[data], out=marks[1:])
    worded = marks[l_end] > marks[l_start]
    l_start, l_end, l_doc = l_start[worded], l_end[worded], l_doc[worded]
    _, earlier = _repeated(texts.hashes(l_start, l_end), l_doc)
    out["n_dup_lines"] = np.bincount(l_doc[earlier], minlength=n)

    three, at = windows(texts.hashes(start, end), doc, 3)
    again, _ = _repeated(three, doc[at])
    covered = np.zeros(len(start) + 3, dtype=bool)
    for k in range(3):
        covered[at[again] + k] = True
    out["n_repeat_words"] = np.bincount(doc[covered[: len(start)]], minlength=n)
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> LinearModel:
    return fit_on_sample(docs, labels, "quality", BITS, max_rows)


def judge_quality(docs: DataFrame, model: LinearModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row of ``docs``: its id, the counts, ``quality`` (0 to 1), base_failed and kept."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 2^bits floats: a fixed size
    source = docs.select("doc_id", "text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        m = shared.value
        for batch in batches:
            for lo, hi, texts in chunks(batch.column(1)):
                c = counts(texts)
                p = m.probability(logits(texts, m))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *[pa.array(c[k], pa.int64()) for k in names], pa.array(p)],
                    ["doc_id", *names, "quality"],
                )

    key = source.schema["doc_id"].dataType.simpleString()
    scored = source.mapInArrow(run, f"doc_id {key}, {', '.join(f'{k} long' for k in names)}, quality double")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality") >= keep_from))


def keep_good(docs: DataFrame, model: LinearModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for lo, hi, texts in chunks(batch.column(at)):
                c = counts(texts)
                kept = (c["n_words"] >= LEAST_WORDS) & (
                    100 * c["n_repeat_words"] <= MOST_REPEATED_PERCENT * c["n_words"]
                )
                kept &= m.probability(logits(texts, m)) >= keep_from
                yield batch.slice(lo, hi - lo).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
