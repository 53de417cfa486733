"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage of every
document is encoded: shares of byte classes, word lengths, repeats, and
hashed byte pairs, then a learned layer e = tanh(E x). Gated attention weighs
the passages, a = softmax(w . (tanh(V e) * sigmoid(U e))), and the document's
score is sigmoid(c . sum(a e) + b). Only documents have labels; which passages
speak for them is learned.

Training is on a bounded sample: at most ``SAMPLE_ROWS`` labelled documents a class,
those with the smallest hash of doc_id among texts of up to ``SAMPLE_BYTES`` bytes,
weighted so that the classes count as in all labelled rows. Rows whose
crc32(doc_id) mod 3 is ``HELD_OUT`` are never in it. The model (a few kB) goes to
the tasks, which score whole texts in one pass: attention is a ratio of two sums, so
a text of any length is scored in pieces of ``PIECE_BYTES``. No shuffle of texts.

Defined cases: a null, empty or blank text is a bag of one passage of zeros; a
passage never crosses a piece; null doc_ids are scored, not held out and
never trained on; of several labels of a doc_id the larger counts, and of
several texts the smallest; without labelled rows every score is 0.5, with one class
all scores are that class's share by the rule of succession; repeated rows give
repeated result rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_columns, documents, read_table, text_or_empty, uniform64

PASSAGE_WORDS = 64
PIECE_BYTES = 1 << 22
GROUP_BYTES = 1 << 20
SAMPLE_ROWS = 1024
SAMPLE_BYTES = 1 << 15
FOLDS, HELD_OUT = 3, 1

#: Byte classes: space, capital, small letter, digit, stop or comma, other sign, beyond ASCII.
CLASSES = 7
NUMBERS = 7
PAIR_BUCKETS = 32
FEATURES = CLASSES + NUMBERS + PAIR_BUCKETS
#: Bytes and words added to a passage's own when shares are taken, so that a few words have no extreme ones.
PRIOR_BYTES, PRIOR_WORDS = 32, 8
ENCODED, GATES = 16, 8
STEPS, RATE, SHRINK = 300, 0.02, 1e-4


def _byte_classes() -> np.ndarray:
    of = np.full(256, 5, dtype=np.int64)
    of[[0x20, *range(0x09, 0x0E)]] = 0
    of[ord("A"):ord("Z") + 1] = 1
    of[ord("a"):ord("z") + 1] = 2
    of[ord("0"):ord("9") + 1] = 3
    of[[ord("."), ord(",")]] = 4
    of[128:] = 6
    return of


_CLASS = _byte_classes()


def pieces(raw: bytes) -> list[bytes]:
    """The text in pieces of at most PIECE_BYTES, cut at white space where there is any."""
    out = []
    while len(raw) > PIECE_BYTES:
        cut = max(raw.rfind(s, 0, PIECE_BYTES) for s in (b" ", b"\n", b"\t")) + 1 or PIECE_BYTES
        out.append(raw[:cut])
        raw = raw[cut:]
    return [*out, raw]


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts -> (features of each passage, the number of each passage's text)."""
    a = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    kind = _CLASS[a]
    inside = kind > 0
    starts = np.flatnonzero(inside & np.r_[True, ~inside[:-1]])
    ends = np.flatnonzero(inside & np.r_[~inside[1:], True]) + 1
    owner = np.searchsorted(text_ends, starts, side="right")
    words = np.bincount(owner, minlength=len(texts))
    n_passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    first_passage = np.cumsum(n_passages) - n_passages
    first_word = np.cumsum(words) - words
    passage = first_passage[owner] + (np.arange(len(starts)) - first_word[owner]) // PASSAGE_WORDS
    total = int(n_passages.sum())
    x = np.zeros((total, FEATURES), dtype=np.float32)
    of_text = np.repeat(np.arange(len(texts)), n_passages)
    if not len(starts):
        return x, of_text
    # a byte belongs to the passage of the last word begun before it in its text, else to the text's first
    is_start = np.zeros(len(a), dtype=np.int64)
    is_start[starts] = 1
    last = np.cumsum(is_start) - 1
    text_of = np.repeat(np.arange(len(texts)), np.diff(np.r_[0, text_ends]))
    own = (last >= 0) & (owner[last] == text_of)
    at = np.where(own, passage[last], first_passage[text_of])
    following = np.r_[a[1:], 0]
    following[text_ends - 1] = 0
    size = np.bincount(at, minlength=total)
    shares = np.bincount(at * CLASSES + kind, minlength=total * CLASSES).reshape(total, CLASSES)
    # letters without case, so that a pair is a pair of letters; a fixed multiplicative hash
    low = lambda v: np.where((v >= 65) & (v <= 90), v + 32, v).astype(np.uint32)
    pair = ((low(a) * 257 + low(following)) * np.uint32(2654435761) >> np.uint32(27)).astype(np.int64)
    pairs = np.bincount(at * PAIR_BUCKETS + pair, minlength=total * PAIR_BUCKETS).reshape(total, PAIR_BUCKETS)
    length = ends - starts
    count = np.bincount(passage, minlength=total)
    some = np.maximum(count, 1)
    mean = np.bincount(passage, length, minlength=total) / some
    square = np.bincount(passage, length.astype(float) ** 2, minlength=total) / some
    # a word's hash: a polynomial of its bytes
    place = np.arange(len(a)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(a)]))
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)])
    word = np.add.reduceat((a.astype(np.uint64) + np.uint64(1)) * powers[place] * inside, starts)
    order = np.lexsort((word, passage))
    p, w = passage[order], word[order]
    new = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (w[1:] != w[:-1])])
    times = np.diff(np.r_[new, len(p)])
    most = np.zeros(total)
    np.maximum.at(most, p[new], times)
    again = np.r_[False, (word[1:] == word[:-1]) & (passage[1:] == passage[:-1])]
    x[:, :CLASSES] = np.sqrt(shares / (size + PRIOR_BYTES)[:, None])
    x[:, CLASSES:CLASSES + NUMBERS] = np.column_stack([
        np.log1p(count), np.log1p(mean), np.log1p(np.sqrt(np.maximum(square - mean ** 2, 0))),
        (count - np.bincount(p[new], minlength=total)) / (count + PRIOR_WORDS), most / (count + PRIOR_WORDS),
        np.bincount(passage[again], minlength=total) / (count + PRIOR_WORDS), np.log1p(size)])
    x[:, CLASSES + NUMBERS:] = np.sqrt(pairs / (size + PRIOR_BYTES)[:, None])
    x[count == 0] = 0
    return x, of_text


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


@dataclass
class Model:
    """Weights of the encoding layer, the gated attention and the classifier."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def encoded(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.weights["E"] + self.weights["e"])

    def attention(self, e: np.ndarray) -> np.ndarray:
        """Unnormalised weights; the gate is within 1, so no exponent overflows."""
        w = self.weights
        return np.exp((np.tanh(e @ w["V"]) * _sigmoid(e @ w["U"])) @ w["w"])

    def score(self, z: np.ndarray) -> np.ndarray:
        return _sigmoid(z @ self.weights["c"] + self.weights["b"])


def train(x: np.ndarray, bag: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Model:
    """Passages ``x`` of bags 0, 1, ... in order, a label and a weight a bag -> the model, by Adam."""
    rnd = np.random.default_rng(12)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    h = ((x - mean) / scale).astype(np.float64)
    d = h.shape[1]
    p = {"E": rnd.normal(0, d ** -0.5, (d, ENCODED)), "e": np.zeros(ENCODED),
         "V": rnd.normal(0, ENCODED ** -0.5, (ENCODED, GATES)), "U": rnd.normal(0, ENCODED ** -0.5, (ENCODED, GATES)),
         "w": rnd.normal(0, GATES ** -0.5, GATES), "c": rnd.normal(0, ENCODED ** -0.5, ENCODED), "b": np.zeros(1)}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    starts = np.flatnonzero(np.r_[True, bag[1:] != bag[:-1]])
    weight = weight / weight.sum()
    for step in range(1, STEPS + 1):
        e = np.tanh(h @ p["E"] + p["e"])
        t, s = np.tanh(e @ p["V"]), _sigmoid(e @ p["U"])
        g = t * s
        raw = np.exp(g @ p["w"])
        a = raw / np.add.reduceat(raw, starts)[bag]
        z = np.add.reduceat(a[:, None] * e, starts)
        off = (_sigmoid(z @ p["c"] + p["b"]) - label) * weight
        dz = off[:, None] * p["c"]
        da = (dz[bag] * e).sum(axis=1)
        da = a * (da - np.add.reduceat(a * da, starts)[bag])
        dg = da[:, None] * p["w"]
        dt, ds = dg * s * (1 - t ** 2), dg * t * s * (1 - s)
        de = (a[:, None] * dz[bag] + dt @ p["V"].T + ds @ p["U"].T) * (1 - e ** 2)
        grads = {"E": h.T @ de, "e": de.sum(axis=0), "V": e.T @ dt, "U": e.T @ ds, "w": g.T @ da,
                 "c": z.T @ off, "b": off.sum(keepdims=True)}
        for k, v in p.items():
            grad = grads[k] + SHRINK * v
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad ** 2
            p[k] = v - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, p)


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def _encode_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [encode([(t or "").encode()])[0] for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array([v.tobytes() for v in x], pa.binary())],
                                         names=["doc_id", "label", "x"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | float:
    """The model of the labelled documents that are not held out, or the one score there is."""
    marks = (labels.where(labels["doc_id"].isNotNull() & labels["quality"].isin(0, 1))
             .groupBy(labels["doc_id"].alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
             .where(remainder(F.col("doc_id")) != HELD_OUT))
    base = document_columns(docs, "doc_id", "text").withColumn("text", text_or_empty())
    base = base.where(F.octet_length("text") <= SAMPLE_BYTES)
    known = base.select("doc_id").distinct().join(marks, "doc_id")
    count = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return (count.get(1, 0) + 1) / (sum(count.values()) + 2)
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(uniform64(21, "doc_id"), "doc_id").limit(sample_rows)
        chosen = some if chosen is None else chosen.union(some)
    # at most 2 * sample_rows rows, a proven bound
    texts = base.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = sorted(texts.mapInArrow(_encode_sample, "doc_id long, label int, x binary").collect(), key=lambda r: r["doc_id"])
    xs = [np.frombuffer(r["x"], dtype=np.float32).reshape(-1, FEATURES) for r in rows]
    label = np.array([r["label"] for r in rows])
    in_sample = np.bincount(label, minlength=2)
    weight = np.array([count[v] / in_sample[v] for v in label.tolist()])
    return train(np.concatenate(xs), np.repeat(np.arange(len(xs)), [len(v) for v in xs]), label, weight)


_SCORES = "doc_id long, score double, n_passages long, attended long, attention double"


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            z, mass = np.zeros((n, ENCODED)), np.zeros(n)
            seen, attended, best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n)
            group: list[tuple[int, bytes]] = []
            size = 0

            def work() -> None:
                x, part = encode([t for _, t in group])
                doc = np.array([d for d, _ in group])[part]
                e = model.encoded(x)
                a = model.attention(e)
                starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                d = doc[starts]
                z[d] += np.add.reduceat(a[:, None] * e, starts)
                mass[d] += np.add.reduceat(a, starts)
                runs = np.diff(np.r_[starts, len(doc)])
                top = np.maximum.reduceat(a, starts)
                where = np.full(len(doc), len(doc))
                hit = np.flatnonzero(a == np.repeat(top, runs))
                where[hit] = hit
                first = np.minimum.reduceat(where, starts)
                better = top > best[d]
                attended[d[better]] = seen[d[better]] + (first - starts)[better]
                best[d[better]] = top[better]
                seen[d] += runs

            for i, text in enumerate(batch["text"].to_pylist()):
                for piece in pieces(text.encode()):
                    group.append((i, piece))
                    size += len(piece)
                    if size >= GROUP_BYTES:
                        work()
                        group.clear()
                        size = 0
            if group:
                work()
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(model.score(z / mass[:, None])), pa.array(seen), pa.array(attended),
                 pa.array(best / mass)], names=[f.split()[0] for f in _SCORES.split(", ")])

    return run


def scores(docs: DataFrame, model: Model | float) -> DataFrame:
    """documents -> (doc_id, score, n_passages, attended, attention), a row per row: ``attended`` is the
    number of the passage with the largest weight, ``attention``."""
    base = document_columns(docs, "doc_id", "text").withColumn("text", text_or_empty())
    if isinstance(model, float):
        none = F.lit(None)
        return base.select("doc_id", F.lit(model).alias("score"), none.cast("long").alias("n_passages"),
                           none.cast("long").alias("attended"), none.cast("double").alias("attention"))
    return base.mapInArrow(_score(model), _SCORES)


def op12_gated_attention(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scores(docs, fit(docs, read_table(spark, sf_dir, "labels"))).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "n_passages", "attended", "attention")
