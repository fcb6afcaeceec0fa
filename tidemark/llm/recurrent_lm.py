"""Log-likelihood of whole documents under a gated recurrent language model.

Counts of all training tokens come from one grouped aggregation. The most frequent words are
broadcast (a fixed number); rarer words of a document meet their counts by a join. The model
is trained by rounds of parallel shards: every shard walks its documents from the current
parameters, and Spark averages the shards' parameters, weighted by their tokens. Every round
walks every training document from its start to its end with the state carried on.

A null or empty text is just its end token. Words not seen in training are one further type
per cell, with the share of words seen once there. Rows that repeat an id are
scored each on its own and all count in training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import gru
from tidemark.llm.bytesets import Texts, chunks, mix
from tidemark.scratch import keep

#: At most so many words have their counts broadcast.
KNOWN_WORDS = 1 << 17
#: Steps per truncated window.
TRUNCATE = 32
BATCH, ROUNDS, LEAST_STEPS, RATE = 64, 3, 200, 0.02
#: Tokens in a shard, and in a piece of a text: a longer one is walked in consecutive pieces.
SHARD, LONGEST = 1 << 21, 1 << 16
#: Tokens scored side by side.
SIDE_BY_SIDE = 1 << 20
#: The end token. No word hashes to it but by chance.
END = np.uint64(0xE0D0E0D0E0D0E0D1)
_PIECE = 1024


def spelling(texts: Texts, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spelling class of a word by its last two bytes."""
    last = texts.data[end - 1].astype(np.uint64)
    before = np.where(end - start > 1, texts.data[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    return (mix(last * np.uint64(257) + before) >> np.uint64(58)).astype(np.int16)


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and cell of every token, ends included, and the bounds of the texts."""
    low = texts.lowered()
    start, end, doc = low.words()
    n = len(texts)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n) + 1)])
    at = np.arange(len(doc)) + doc
    h = np.full(bounds[-1], END, dtype=np.uint64)
    s = np.zeros(bounds[-1], dtype=np.int16)
    h[at] = low.hashes(start, end)
    s[at] = spelling(low, start, end) * gru.MEMBERS + (h[at] % np.uint64(gru.MEMBERS)).astype(np.int16)
    return h, s, bounds


def count_tokens(training: DataFrame) -> DataFrame:
    """(token, cell, n) over all training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(parts):
            h, s, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h)
            h, s, n = h[order], s[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            return h[first], s[first], np.add.reduceat(n, first)

        def send(parts):
            h, s, n = merged(parts)
            return pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(s), pa.array(n)], ["token", "cell", "n"]
            )

        parts, held = [], 0
        for batch in batches:
            for _, _, texts in chunks(batch.column(0)):
                h, s, _ = tokens(texts)
                parts.append(merged([(h, s, np.ones(len(h), dtype=np.int64))]))
                held += len(parts[-1][0])
                if held > 2_000_000:
                    yield send(parts)
                    parts, held = [], 0
        if parts:
            yield send(parts)

    counted = training.select("text").mapInArrow(run, "token long, cell short, n long")
    return counted.groupBy("token").agg(F.min("cell").alias("cell"), F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words from some frequency on, at most ``most`` of them.

    The limit comes from a short histogram of frequencies, so nothing is sorted and no task
    sends more than its share."""
    step = F.floor(8 * F.log2(F.col("n"))).cast("int")
    least, held = 1 << 30, 0
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        held += r["count"]
        if held > most:
            break
        least = r["step"]
    return counts.where(step >= least)


class Lexicon:
    """The broadcast words by sorted hash, their counts, and where the model puts them."""

    def __init__(self, token: np.ndarray, count: np.ndarray, cell: np.ndarray):
        rank = np.lexsort((token, -count))
        token, count, cell = token[rank], count[rank], cell[rank]
        # Neighbours in frequency share a class, so a class's words are about equally likely.
        place = np.arange(len(token))
        symbols = np.where(place < gru.N_HEAD, place, gru.N_HEAD + cell)
        order = np.argsort(token)
        self.token, self.count = token[order], count[order]
        self.symbols = symbols[order].astype(np.int32)
        self.log_plain = np.log10(np.maximum(self.count, 1))
        self.log_count = np.log10(self.count + 0.5)
        self.member_count = np.zeros(gru.N_HEAD)
        self.member_count[: min(len(count), gru.N_HEAD)] = count[: gru.N_HEAD]
        # A table of first guesses by the leading bits saves most of the binary search.
        self.bits = 17
        self.guess = np.searchsorted(self.token, np.arange((1 << self.bits) + 1, dtype=np.uint64) << np.uint64(64 - self.bits))
        self.guess[-1] = len(self.token)
        self.reach = int(np.diff(self.guess).max()) if len(self.token) else 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Position of every token, -1 where it isn't among the broadcast words."""
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.guess[slot], self.guess[slot + 1]
        out = np.full(len(h), -1, dtype=np.int64)
        for k in range(self.reach):
            here = at + k
            open_ = np.flatnonzero(here < stop)
            if not len(open_):
                break
            same = self.token[here[open_]] == h[open_]
            out[open_[same]] = here[open_[same]]
        return out

    def place(self, h: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position and symbol of every token."""
        found = self.find(h)
        symbols = gru.N_HEAD + cell.astype(np.int32)
        known = found >= 0
        symbols[known] = self.symbols[found[known]]
        return found, symbols


def shifted(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Inputs: the symbol before each token, START at the beginning of a text."""
    inputs = np.empty(len(symbols), dtype=np.int32)
    inputs[1:] = symbols[:-1]
    inputs[bounds[:-1]] = gru.START
    return inputs


def training_documents(training: DataFrame, shared) -> DataFrame:
    """(order, piece, size, data): every document as int16 symbols, the first an input only.

    A text of more than LONGEST tokens is cut into consecutive pieces; a piece's first input is
    the last token of the piece before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in batches:
            for lo, _, texts in chunks(batch.column(1)):
                h, s, bounds = tokens(texts)
                symbols = lexicon.place(h, s)[1].astype(np.int16)
                n_pieces = -(-np.diff(bounds) // LONGEST)
                doc = np.repeat(np.arange(len(n_pieces)), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = bounds[doc] + piece * LONGEST
                end = np.minimum(start + LONGEST, bounds[doc + 1])
                before = np.where(piece > 0, symbols[np.maximum(start - 1, 0)], gru.START).astype(np.int16)
                data = [
                    b.tobytes() + symbols[i:j].tobytes() for b, i, j in zip(before, start.tolist(), end.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(lo + doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(end - start),
                        pa.array(data, pa.binary()),
                    ],
                    ["order", "piece", "size", "data"],
                )

    hashed = training.select(F.xxhash64("doc_id", "text").alias("order"), "text")
    return hashed.mapInArrow(run, "order long, piece int, size long, data binary")


def train_model(documents: DataFrame, start: np.ndarray) -> np.ndarray:
    """Rounds of local training and averaging; the parameters have a fixed size."""
    context = documents.sparkSession.sparkContext
    kept = keep(documents, "lm-documents")
    n_tokens = kept.agg(F.sum("size")).first()[0] or 0
    n_shards = max(1, -(-n_tokens // SHARD))
    # Range by the hashed order: shards of about equal size, the same rows in every run.
    spread = keep(kept.repartitionByRange(n_shards, "order", "piece").sortWithinPartitions("order", "piece", "data"), "lm-shards")
    flat = start
    for number in range(ROUNDS):
        now = context.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], number=number, now=now) -> Iterator[pa.RecordBatch]:
            def learnt(texts: list[np.ndarray]) -> pa.RecordBatch:
                p = gru.train(gru.unpack(now.value), texts, TRUNCATE, BATCH, LEAST_STEPS // ROUNDS, RATE / (1 + number), number)
                weight = float(sum(len(t) - 1 for t in texts))
                packed = np.append(gru.pack(p).astype(np.float64), 1.0) * weight
                pieces = [packed[i : i + _PIECE] for i in range(0, len(packed), _PIECE)]
                return pa.RecordBatch.from_arrays(
                    [pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.list_(pa.float64()))], ["piece", "sums"]
                )

            texts, held = [], 0
            for batch in batches:
                for cell in batch.column(0):
                    texts.append(np.frombuffer(cell.as_py(), dtype=np.int16))
                    held += len(texts[-1]) - 1
                    if held >= 2 * SHARD:
                        yield learnt(texts)
                        texts, held = [], 0
            if texts:
                yield learnt(texts)

        sums = (
            spread.select("data").mapInArrow(run, "piece int, sums array<double>")
            .select("piece", F.posexplode("sums").alias("at", "value"))
            .groupBy("piece", "at").agg(F.sum("value").alias("value"))
        ).collect()
        if not sums:
            return flat
        total = np.zeros(gru.N_PARAMETERS + 1)
        for r in sums:
            total[r["piece"] * _PIECE + r["at"]] = r["value"]
        flat = (total[:-1] / total[-1]).astype(np.float32)
        now.unpersist()
    return flat


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    context = docs.sparkSession.sparkContext
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    training = docs.select("doc_id", "text").where(~held_out)
    counts = keep(count_tokens(training), "lm-counts")
    by_cell = counts.groupBy("cell").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum((F.col("n") == 1).cast("long")).alias("once")
    ).collect()
    n_all = sum(r["n"] for r in by_cell)
    v_all = sum(r["v"] for r in by_cell)
    top = most_frequent(counts, KNOWN_WORDS).toPandas().sort_values(["n", "token"], ascending=[False, True])
    lexicon = Lexicon(
        top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), top["cell"].to_numpy(np.int64)
    )
    shared = context.broadcast(lexicon)

    # What a cell holds beside the head words, and its share for unseen words.
    rest, once = np.zeros(gru.N_CELLS), np.zeros(gru.N_CELLS)
    for r in by_cell:
        rest[r["cell"]], once[r["cell"]] = r["n"], r["once"]
    head = top.iloc[: gru.N_HEAD] if len(top) else top
    np.subtract.at(rest, head["cell"].to_numpy(np.int64), head["n"].to_numpy(np.float64))
    once = np.maximum(once, 0.5)
    member_count = np.concatenate([lexicon.member_count, rest + once]).reshape(gru.N_CLASSES, gru.MEMBERS)

    start = gru.pack(gru.initial(member_count.sum(1), member_count))
    model = context.broadcast(train_model(training_documents(training, shared), start))
    log_rest, log_once = np.log10(rest + once), np.log10(once)
    scale = float(np.log10(n_all + 0.5 * (v_all + 1))) if n_all else float(np.log10(0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, p = shared.value, gru.unpack(model.value)

        def scored(ids: pa.Array, parts: list) -> pa.RecordBatch:
            h, s = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
            bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[2]) for x in parts]))])
            found, symbols = words.place(h, s)
            classes, members = symbols // gru.MEMBERS, symbols % gru.MEMBERS
            n = len(ids)
            doc = np.repeat(np.arange(n), np.diff(bounds))
            net = gru.log_likelihoods(p, shifted(symbols, bounds), classes, members, bounds) / np.log(10)
            known = found >= 0
            base = np.bincount(doc[known], weights=words.log_count[found[known]], minlength=n)
            outside = np.flatnonzero(symbols >= gru.N_HEAD)
            share = -log_rest[symbols[outside] - gru.N_HEAD]
            both = known[outside]
            share[both] += words.log_plain[found[outside[both]]]
            net += np.bincount(doc[outside], weights=share, minlength=n)
            rare = np.flatnonzero(~known)
            order = np.lexsort((h[rare], doc[rare]))
            r_doc, r_key, r_cell = doc[rare][order], h[rare][order], s[rare][order]
            first = np.ones(len(order), dtype=bool)
            first[1:] = (r_doc[1:] != r_doc[:-1]) | (r_key[1:] != r_key[:-1])
            at = np.flatnonzero(first)
            times = np.diff(np.append(at, len(order)))
            edge = np.searchsorted(r_doc[at], np.arange(n + 1)).astype(np.int32)
            cells = pa.StructArray.from_arrays(
                [pa.array(r_key[at].view(np.int64)), pa.array(times.astype(np.int32)), pa.array(r_cell[at])],
                ["token", "times", "cell"],
            )
            return pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.diff(bounds)),
                    pa.array(np.bincount(doc[known], minlength=n)),
                    pa.array(base),
                    pa.array(net),
                    pa.ListArray.from_arrays(pa.array(edge), cells),
                ],
                ["doc_id", "n_tokens", "n_top", "base", "net", "rare"],
            )

        for batch in batches:
            parts, held, since = [], 0, 0
            for _, hi, texts in chunks(batch.column(1)):
                parts.append(tokens(texts))
                held += len(parts[-1][0])
                if held >= SIDE_BY_SIDE or hi == batch.num_rows:
                    yield scored(batch.column(0).slice(since, hi - since), parts)
                    parts, held, since = [], 0, hi

    source = docs.select("doc_id", "text")
    key = source.schema["doc_id"].dataType.simpleString()
    scored = keep(
        source.mapInArrow(
            run,
            f"doc_id {key}, n_tokens long, n_top long, base double, net double, "
            "rare array<struct<token:long,times:int,cell:short>>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "lm-scores",
    )
    unseen = F.element_at(F.array(*[F.lit(float(x)) for x in log_once]), F.col("cell") + 1)
    met = scored.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(
        counts.select("token", "n"), "token", "left"
    )
    rare = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_base"),
        F.sum(F.col("times") * F.coalesce(F.log10("n"), unseen)).alias("rare_net"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("n_top") + zero("rare_known")).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base") - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("net") + zero("rare_net")).alias("score"),
    )
