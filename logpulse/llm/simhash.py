"""SimHash near-duplicate detection with pigeonring filtering.

A 64-bit fingerprint is cut into ``SEGMENTS`` segments laid on a ring. Two
fingerprints within ``max_bits`` differ by at most ``max_bits`` over the whole
ring, so some segment starts a chain whose first l segments together differ
by at most ``l * max_bits / SEGMENTS`` bits, for every l. With five segments
and two bits the budget of the first two segments is 0: a pair must agree
on two consecutive segments (25 or 26 bits), which is the join key, and then
stay within 1, 1 and 2 bits over three, four and five segments before the
whole distance is counted.

Distinct fingerprints are linked, not documents: a fingerprint stands for
all documents that have it, by their smallest doc_id. In a bucket of more
than ``BUCKET_PAIRS`` fingerprints no pairs are made. There each fingerprint
lists itself and its one-bit neighbours outside the agreeing segments; two
fingerprints within two bits share a neighbour, a neighbour has at most 39
listers, and linking all listers of a neighbour to the smallest keeps
every connection in linear space (``max_bits`` must be 2 or less).

Defined cases: a null, empty or blank text has fingerprint zero and links like
any other; fewer than three words count as one shingle; whole texts are used;
repeated rows give repeated result rows; rows with null doc_id are grouped
like others but never name a component unless it has no other row (then
null); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import document_columns, documents, text_or_empty, written
from .components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BUCKET_PAIRS = 64
#: (first bit, bits) of each segment of the ring
SEGMENTS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]

NO_ID = 2**63 - 1

# column b of a byte's row: bit b of the byte
_BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_BYTE_OFFSET = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of the lower-cased (A-Z) text's word shingles, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(words_per_shingle, len(words))
    starts = [0, *(ends[: len(words) - k] + 1).tolist()]
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist(), strict=True)]
    values = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    seen = np.bincount((values + _BYTE_OFFSET).ravel(), minlength=2048).reshape(8, 256)
    bits = (seen @ _BYTE_BITS).ravel()  # how many hashes have each bit, lowest first
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(words_per_shingle: int):
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            fps = np.array([fingerprint(t, words_per_shingle) for t in s], dtype=np.uint64)
            yield pd.Series(fps.view(np.int64))
    return of


def _segment(fp: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1))


def _chain(fp: Column, i: int) -> Column:
    """The key of two consecutive segments of the ring."""
    a, b = SEGMENTS[i], SEGMENTS[(i + 1) % len(SEGMENTS)]
    return F.shiftleft(_segment(fp, *a), b[1]).bitwiseOR(_segment(fp, *b))


def _outside_bits(i: int) -> list[int]:
    inside = {s + k for s, n in (SEGMENTS[i], SEGMENTS[(i + 1) % len(SEGMENTS)]) for k in range(n)}
    return [b for b in range(64) if b not in inside]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _within_budgets(a: Column, b: Column, start: Column, max_bits: int) -> Column:
    """Chain budgets from the start segment on, the whole ring last."""
    diff = a.bitwiseXOR(b)
    m = len(SEGMENTS)
    cases = None
    for i in range(m):
        ok = F.lit(True)
        mask = 0
        for length in range(1, m + 1):
            s, n = SEGMENTS[(i + length - 1) % m]
            mask |= ((1 << n) - 1) << s
            ok = ok & (F.bit_count(diff.bitwiseAND(F.lit(_signed(mask)))) <= length * max_bits // m)
        cases = F.when(start == i, ok) if cases is None else cases.when(start == i, ok)
    return cases


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS,
                      bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """(fp, node), fp distinct -> (a, b): node links that connect all within ``max_bits``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2: chains of two segments are the key")
    fp = F.col("fp")
    ring = nodes.select("fp", "node", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), _chain(fp, i).alias("chain")) for i in range(len(SEGMENTS))]))
        .alias("k")).select("fp", "node", "k.i", "k.chain")
    shared = ring.groupBy("i", "chain").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(ring.join(shared, ["i", "chain"]), "simhash_buckets")

    small = buckets.where(F.col("n") <= bucket_pairs)
    a, b = small.alias("a"), small.alias("b")
    pairs = (a.join(b, (F.col("a.i") == F.col("b.i")) & (F.col("a.chain") == F.col("b.chain"))
                    & (F.col("a.node") < F.col("b.node")))
             .where(_within_budgets(F.col("a.fp"), F.col("b.fp"), F.col("a.i"), max_bits))
             .where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits)
             .select(F.col("a.node").alias("a"), F.col("b.node").alias("b")))

    large = buckets.where(F.col("n") > bucket_pairs)
    flips = F.lit(None).cast("array<long>")
    for i in range(len(SEGMENTS)):
        # one bit on either side reaches distance two; for less, both sides or one stay put
        masks = [0] + [_signed(1 << x) for x in _outside_bits(i)]
        flips = F.when(F.col("i") == i, F.array(*[F.lit(x).cast("long") for x in masks])).otherwise(flips)
    if max_bits == 2:
        met = large.select("i", "chain", "node", F.explode(flips).alias("flip"), "fp").select(
            "node", F.col("fp").bitwiseXOR(F.col("flip")).alias("meet"))
        hubs = met.groupBy("meet").agg(F.collect_set("node").alias("all")).where(F.size("all") > 1)
        near = hubs.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a != b")
    elif max_bits == 1:
        met = large.select("node", F.explode(flips).alias("flip"), "fp").select(
            "node", F.col("flip") == 0, F.col("fp").bitwiseXOR(F.col("flip")).alias("meet")).toDF(
            "node", "own", "meet")
        near = (met.groupBy("meet").agg(F.min(F.when(F.col("own"), F.col("node"))).alias("a"),
                                        F.collect_set("node").alias("all"))
                .where("a is not null").select("a", F.explode("all").alias("b")).where("a != b"))
    else:
        near = None
    return pairs if near is None else pairs.union(near)


def _near_rows(docs: DataFrame, words_per_shingle: int, max_bits: int) -> DataFrame:
    """documents -> (doc_id, sum, fp, root_id, root_fp), a row per row: a checksum of the text, its fingerprint and
    the node that names its component (NO_ID for no doc_id)."""
    base = document_columns(docs, "doc_id", "text")
    fps = written(base.select("doc_id", F.xxhash64(text_or_empty()).alias("sum"),
                              _fingerprints(words_per_shingle)("text").alias("fp")), "simhash_fingerprints")
    # a node is a distinct fingerprint, named by its smallest doc_id
    nodes = fps.groupBy("fp").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("least"))
    # several fingerprints may lack an id: those nodes are named after all ids by their fingerprint
    linked = connected_components(fingerprint_links(
        nodes.select("fp", F.struct(F.col("least").alias("id"), "fp").alias("node")), max_bits))
    roots = linked.select(F.col("u.fp").alias("fp"), F.col("v.id").alias("root"), F.col("v.fp").alias("other"))
    named = written(nodes.join(roots, "fp", "left").select(
        "fp", F.coalesce("root", "least").alias("root_id"), F.coalesce("other", "fp").alias("root_fp")),
        "simhash_named")  # a table of its own, so that a fingerprint with many rows is split in the join
    return fps.join(named, "fp")


def near_groups(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS,
                max_bits: int = MAX_BITS) -> DataFrame:
    """documents -> (doc_id, fingerprint, component_id), a row per row."""
    return _near_rows(docs, words_per_shingle, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.nullif("root_id", F.lit(NO_ID)).alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each group stays, all columns: that with the smallest doc_id (null last; of several texts
    with it the one of the group's naming fingerprint), and of repeated rows one."""
    rows = _near_rows(docs, SHINGLE_WORDS, MAX_BITS).where(
        (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("root_id")) & (F.col("fp") == F.col("root_fp")))
    kept = rows.groupBy("root_id", "root_fp").agg(F.min("sum").alias("_kept_sum")).select(
        F.nullif("root_id", F.lit(NO_ID)).alias("_kept_id"), "_kept_sum")
    summed = docs.withColumn("_sum", F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    one = summed.join(kept, summed["doc_id"].eqNullSafe(kept["_kept_id"]) & (summed["_sum"] == kept["_kept_sum"]), "left_semi")
    return one.dropDuplicates(["doc_id", "_sum"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_pigeonring_simhash(spark, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))
