"""Mixture-controlled packing: every window is filled to target token shares.

Each source is a queue of its documents' tokens. Window w takes from each
source what deficit round-robin owes it: shares times the window, plus the
deficit of the windows before. As documents may be cut anywhere, a queue
always pays its whole deficit, and the state after any number of windows has
a closed form: token t of a queue of weight r is due at time (t + 1/2) / r, and of the
first x = 4096 w tokens by due time (then by queue), queue s has sent A_s(x). An
exhausted queue sends no more and the others share its part. So deficits carry over
windows and partitions without a pass over the windows: a document needs its place in
its source's queue and the queues' totals to know its pieces, windows and offsets.

The weights are the corpus's own token totals, so that all queues last to the end, or
given by source. A source of fewer than one in ``QUEUES`` of the tokens would not be in every
window, so such sources share up to ``QUEUES`` common queues by hash: at most twice that many
queues, whose totals (one number a queue) are all that reaches the driver.

Within a window the queues' runs follow in order of name. Only the last window may
be short, so at most 4095 places of padding in all.

Defined cases: a null text counts as empty and packs its end token alone;
null source is a source of its own; whole texts are packed, very long ones as any;
repeated rows are separate documents; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import document_columns, documents, text_or_empty, written
from .tokens import token_ids

WINDOW = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
QUEUES = 512
#: Queue starts (one per input partition and source, about 60 bytes) are broadcast up to here.
BROADCAST_STARTS = 200_000

_TOKENS = "doc_id long, source_key string, pid int, place long, doc_tokens long, ids binary"


#: Documents worked on together: what a worker holds beside its caches.
SLICE_ROWS = 1_000


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _tokenise(vocabulary: str | None):
    """Documents of a partition -> their ids and their place in the partition's queue of their source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(VOCABULARY)
        encode = token_ids(path).encode
        end = END_ID.to_bytes(2, "little")
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        filled: dict[str, int] = {}
        for batch in _slices(batches):
            queues = batch["source_key"].to_pylist()
            ids = [encode(t) + end for t in batch["text"].to_pylist()]
            places = []
            for q, b in zip(queues, ids, strict=True):
                places.append(filled.get(q, 0))
                filled[q] = places[-1] + len(b) // 2
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(queues, pa.string()), pa.array([pid] * len(ids), pa.int32()),
                 pa.array(places, pa.int64()), pa.array([len(b) // 2 for b in ids], pa.int64()),
                 pa.array(ids, pa.binary())],
                names=["doc_id", "source_key", "pid", "place", "doc_tokens", "ids"])

    return run


def sent_before(x: np.ndarray, totals: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Rows A(x): how many of the first x tokens come from each queue, in exact integers.

    Queues run dry in order of total / weight. Between two such times the tokens sent grow
    evenly, so time is (x - tokens of dry queues) / (weight left), and a queue has sent its tokens
    due by then; ties and rounding are settled by due time.
    """
    if not len(x):
        return np.zeros((0, len(totals)), dtype=np.int64)
    total = [int(t) for t in totals]
    weight = total if weights is None else [int(w) for w in weights]
    dry = sorted((s for s in range(len(total)) if total[s]), key=lambda s: Fraction(total[s], weight[s]))
    gone, left, limits, states = 0, sum(weight[s] for s in dry), [], []
    for s in dry:  # up to which x the state before s runs dry holds
        states.append((gone, left))
        limits.append(gone + left * total[s] // weight[s])
        gone, left = gone + total[s], left - weight[s]
    states = states or [(0, 1)]
    phase = np.minimum(np.searchsorted(np.array(limits or [0], dtype=object).astype(float) + 0.5, np.asarray(x, dtype=float)), len(states) - 1)
    xs = [int(v) for v in x]
    for i, v in enumerate(xs):  # floats only bring the phase near
        while phase[i] and v <= limits[phase[i] - 1]:
            phase[i] -= 1
        while phase[i] + 1 < len(states) and v > limits[phase[i]]:
            phase[i] += 1
    before = [states[k][0] for k in phase.tolist()]
    rest = [states[k][1] for k in phase.tolist()]
    small = 2 * max(weight, default=0) * max(xs) + max(rest) < 2 ** 63
    kind = np.int64 if small else object
    w, big = np.array(weight, dtype=kind), np.array(total, dtype=kind)
    e, r = np.array(before, dtype=kind)[:, None], np.array(rest, dtype=kind)[:, None]
    sent = np.minimum((2 * (np.array(xs, dtype=kind)[:, None] - e) * w + r) // (2 * r), big)  # due by then
    off = sent.sum(axis=1) - np.array(xs, dtype=kind)
    scale = np.maximum(np.array(weight, dtype=float), 1e-300)
    for i in np.flatnonzero(off):
        row = sent[i]
        while (d := int(row.sum()) - xs[i]):
            # the next due token is sent, or the one due last is taken back; nearly equal
            # float times are compared exactly
            due = (row.astype(float) + (0.5 if d < 0 else -0.5)) / scale
            due[(row >= big) if d < 0 else (row <= 0)] = np.inf if d < 0 else -np.inf
            best = due.min() if d < 0 else due.max()
            near = np.flatnonzero(np.abs(due - best) <= 1e-9 * abs(best))
            exact = lambda s: Fraction(2 * int(row[s]) + (1 if d < 0 else -1), weight[s])  # noqa: B023, E731
            pick = (min(near, key=lambda s: (exact(s), s)) if d < 0 else max(near, key=lambda s: (exact(s), s)))
            row[pick] += 1 if d < 0 else -1
    return sent.astype(np.int64)


class _Windows:
    """A(4096 w) in chunks of windows, as far as they are asked for."""

    CHUNK = 512

    def __init__(self, totals: list[int], weights: list[int]) -> None:
        self.totals, self.weights = np.array(totals, dtype=np.int64), np.array(weights, dtype=np.int64)
        self.whole = int(self.totals.sum())
        self.held: dict[int, np.ndarray] = {}
        # tokens sent by the time that each queue runs dry, and the time, for a first guess
        rate, size = self.weights.astype(float), self.totals.astype(float)
        time = np.unique(np.r_[0.0, size / rate])
        self.time, self.sent = time, np.minimum(size[:, None], rate[:, None] * time).sum(axis=0)

    def chunk(self, c: int) -> np.ndarray:
        if c not in self.held:
            while len(self.held) > 8:
                self.held.pop(next(iter(self.held)))
            w = np.arange(c * self.CHUNK, (c + 1) * self.CHUNK + 1, dtype=np.int64) * WINDOW
            self.held[c] = sent_before(np.minimum(w, self.whole), self.totals, self.weights)
        return self.held[c]

    def chunks(self, s: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that hold the first and the last token of each document, or lie beside them."""
        near = len(self.totals) + WINDOW  # a guess is off by less than a token a queue
        guess = lambda t: np.interp((t + 0.5) / self.weights[s], self.time, self.sent)
        of = lambda x: np.clip(x, 0, self.whole) // (WINDOW * self.CHUNK)
        return of(guess(first) - near).astype(np.int64), of(guess(last) + near).astype(np.int64)

    def pieces(self, s: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Documents (queue, place in it, tokens) -> (document, first token, tokens, window, offset) of every piece."""
        low, high = self.chunks(s, place, place + n - 1)
        out = []
        span = self.CHUNK + 1
        for c in np.unique(np.concatenate([np.arange(a, b + 1) for a, b in set(zip(low.tolist(), high.tolist(), strict=True))])).tolist():
            rows = self.chunk(c)
            docs = np.flatnonzero((low <= c) & (high >= c))
            q = s[docs]
            a, b = np.maximum(place[docs], rows[0, q]), np.minimum((place + n)[docs], rows[-1, q])
            some = a < b
            docs, q, a, b = docs[some], q[some], a[some], b[some]
            # one ascending line of all queues' borders
            shift = np.arange(rows.shape[1], dtype=np.int64) * (self.whole + 1)
            line = (rows.T + shift[:, None]).ravel()
            w0 = np.searchsorted(line, a + shift[q], side="right") - 1 - q * span
            w1 = np.searchsorted(line, b - 1 + shift[q], side="right") - 1 - q * span
            times = w1 - w0 + 1
            d = np.repeat(np.arange(len(docs)), times)
            w = np.arange(len(d)) - np.repeat(np.cumsum(times) - times, times) + w0[d]
            lo, hi = np.maximum(a[d], rows[w, q[d]]), np.minimum(b[d], rows[w + 1, q[d]])
            before = np.cumsum(np.diff(rows, axis=0), axis=1) - np.diff(rows, axis=0)  # runs of the queues ahead
            real = lo < hi
            d, w, lo, hi = d[real], w[real], lo[real], hi[real]
            out.append((docs[d], lo - place[docs[d]], hi - lo, w + c * self.CHUNK, before[w, q[d]] + lo - rows[w, q[d]]))
        return tuple(np.concatenate(v) for v in zip(*out, strict=True))


_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long")


def _cut(totals: list[int], weights: list[int]):
    """Documents with their place in their queue -> pieces, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(totals, weights)
        names = [f.split()[0] for f in _PIECES.split(", ")]
        for batch in _slices(batches):
            s, place, n = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("number", "place", "doc_tokens"))
            ids = np.frombuffer(b"".join(batch["ids"].to_pylist()), dtype="<u2").astype("<u4")
            doc, start, length, window, offset = windows.pieces(s, place, n)
            order = np.lexsort((start, doc))
            doc, start, length, window, offset = (v[order] for v in (doc, start, length, window, offset))
            raw = memoryview(ids).cast("B")
            at = 4 * ((np.cumsum(n) - n)[doc] + start)
            sums = [crc32(raw[i:j]) for i, j in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(doc)), *[pa.array(v, pa.int64()) for v in (start, length, sums, n[doc], window, offset)]],
                names=names)

    return run


def packed_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """documents -> (doc_id, source_key, pid, place, doc_tokens, ids): ids as 16-bit
    little-endian bytes with the end token, ``place`` counted in the partition's tokens of the source."""
    base = document_columns(docs, "doc_id", "text", "source").select(
        "doc_id", text_or_empty().alias("text"), _source_key(F.col("source")).alias("source_key"))
    return written(base.mapInArrow(_tokenise(vocabulary), _TOKENS), "pack_tokens")


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("~"))


def queue_plan(parts: DataFrame, weights: Mapping[str | None, int] | None = None, queues: int = QUEUES) -> DataFrame:
    """(pid, source_key, n) -> (pid, source_key, queue, queue_start, n, weight): the queue of each source,
    where in it a partition's tokens of the source begin, and the source's weight."""
    per_source = parts.groupBy("source_key").agg(F.sum("n").alias("source_n"))
    whole = per_source.agg(F.sum("source_n")).first()[0] or 0
    common = F.concat(F.lit("+"), F.pmod(F.xxhash64("source_key"), F.lit(queues)).cast("string"))
    given = F.col("source_n")
    if weights is not None:
        if any(w < 1 for w in weights.values()):
            raise ValueError("weights are positive integers")
        pairs = [x for k, w in weights.items() for x in (F.lit("~" if k is None else f"={k}"), F.lit(w).cast("long"))]
        given = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source_key")), F.lit(1).cast("long")) if pairs else F.lit(1).cast("long")
    plan = per_source.select("source_key", F.when(F.col("source_n") * queues >= whole, F.col("source_key")).otherwise(common).alias("queue"),
                             given.alias("weight"))
    along = Window.partitionBy("queue").orderBy("pid", "source_key")
    return parts.join(plan, "source_key").withColumn("queue_start", F.sum("n").over(along) - F.col("n"))


def packed_pieces(docs: DataFrame, vocabulary: str | None = None, weights: Mapping[str | None, int] | None = None) -> DataFrame:
    """documents -> one row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``weights`` (source -> positive integer, others 1) are the shares that windows are filled to while all queues
    last; without them the corpus's own."""
    spark = docs.sparkSession
    tokens = packed_tokens(docs, vocabulary)
    parts = tokens.groupBy("pid", "source_key").agg(F.sum("doc_tokens").alias("n"))
    plan = written(queue_plan(written(parts, "pack_parts"), weights), "pack_plan")
    one = plan.groupBy("queue", "source_key").agg(F.sum("n").alias("n"), F.first("weight").alias("weight"))
    # one row per queue, at most 2 * QUEUES of them
    rows = one.groupBy("queue").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).orderBy("queue").collect()
    numbers = spark.createDataFrame([(r["queue"], i) for i, r in enumerate(rows)], "queue string, number int")
    starts = plan.join(F.broadcast(numbers), "queue").select("pid", "source_key", "number", "queue_start")
    few = plan.count() <= BROADCAST_STARTS
    placed = tokens.join(F.broadcast(starts) if few else starts, ["pid", "source_key"]).select(
        "doc_id", "number", (F.col("place") + F.col("queue_start")).alias("place"), "doc_tokens", "ids")
    return placed.mapInArrow(_cut([r["n"] for r in rows], [r["weight"] for r in rows]), _PIECES)


def op7_deficit_round_robin(spark, sf_dir: str) -> DataFrame:
    return packed_pieces(documents(spark, sf_dir))
