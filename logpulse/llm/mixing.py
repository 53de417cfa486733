"""Mixing sources to target weights by a hypergeometric splitting tree.

Every document is cut into blocks of ``BLOCK_WORDS`` words. A source is
walked in passes: a target of 2.4 times its size takes two whole passes and
0.4 of a third. Each pass has its own random order of the blocks, a hash of
(seed, pass, document, block); the last pass stops where the target is
reached, inside a block if need be, so a source's words meet its target.

The block quotas of all sources are then split among ``OUTPUT_SHARDS``
shards by a tree: a node's quota vector goes to its two halves by a
multivariate hypergeometric draw, down to one vector per shard. Shard j
takes the next disjoint run of each source's permuted blocks and sorts its
blocks by another hash.

Ranks in a source's order come from counts per (source, pass, hash bucket),
added up over the buckets, and a window inside each bucket, so no task holds
a source. Only one row per source enters the tree.

Defined cases: a null or blank text has size 0 and takes nothing; null source is
a source of its own, the last in order; whole texts are counted; repeated
rows with one doc_id, source and size are separate documents; sources
without words have target 0; an empty table gives no rows; other columns
are ignored (and kept by ``mixed_documents``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, document_columns, documents, text_or_empty, uniform64, written

WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
BLOCK_WORDS = 256
OUTPUT_SHARDS = 64
HASH_BUCKETS = 1024
SEED = 2024
#: numpy draws from populations below 10^9; blocks grow with larger corpora.
MAX_BLOCKS = 500_000_000


def n_words(col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, size) rows -> (source, source_size, target): shares of all words by
    weight, none above ``max_passes`` times its source, the excess reshared.

    A source is capped while the level of the rest, (words left) / (weight
    left), lifts it above its cap; in order of cap per weight the capped ones
    come first.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    w = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_passes)
    everything = Window.partitionBy()
    ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumns({
        "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))})
    w = w.withColumn("level", F.col("left") / F.col("weight_left"))
    # the first source that stays below its cap sets the level for all after it
    fits = F.col("weight") * F.col("level") <= F.col("cap")
    w = w.withColumn("final", F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), "source", "level")))
                     .over(everything)["level"])
    return w.select("source", "source_size", F.least(
        F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("final"), F.col("cap").cast("double")))
        .alias("target"))


def _tree(shards: int, seed: int):
    """Quotas of all sources, one row each -> the run of each shard in each source's blocks."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        quotas = pd.concat(list(frames), ignore_index=True)  # one row per source
        if not len(quotas):
            return
        quotas = quotas.sort_values("source_key")
        vectors = {(0, shards): quotas["quota"].to_numpy(dtype=np.int64)}
        leaves: dict[int, np.ndarray] = {}
        while vectors:
            (a, b), vector = vectors.popitem()
            if b - a == 1:
                leaves[a] = vector
                continue
            mid = (a + b) // 2
            take = int(vector.sum()) * (mid - a) // (b - a)
            rng = np.random.Generator(np.random.Philox(key=[seed, a * 2**32 + b]))
            left = (rng.multivariate_hypergeometric(vector, take, method="marginals")
                    if len(vector) > 1 else np.array([take]))
            vectors[(a, mid)], vectors[(mid, b)] = left, vector - left
        matrix = np.array([leaves[j] for j in range(shards)]).reshape(shards, -1)  # shard x source
        ends = matrix.cumsum(axis=0)
        for s, key in enumerate(quotas["source_key"]):
            yield pd.DataFrame({"source_key": [key], "ends": [ends[:, s].tolist()]})

    return split


def mixed_blocks(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES,
                 shards: int = OUTPUT_SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """documents -> (sizes, blocks).

    sizes: (doc_id, source, size, copy, source_key, source_size, target), a row
    per row. blocks: (doc_id, source_key, size, copy, pass, block, first, drawn,
    shard, place): ``drawn`` words from word ``first``; sorting a shard by
    ``place`` is its local shuffle.
    """
    base = document_columns(docs, "doc_id", "source", "text").select("doc_id", "source", n_words().alias("size"))
    counted = written(base.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix_sizes")
    targets = source_targets(counted.select("source", (F.col("size") * F.col("n")).alias("size")), weights, max_passes)
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    plan = written(targets.select(key.alias("source_key"), "source_size", "target",
                                  F.round("target").cast("long").alias("words")), "mix_targets")
    total = plan.agg(F.sum("source_size")).first()[0] or 0
    block = max(BLOCK_WORDS, -(-total // MAX_BLOCKS))
    sizes = (counted.withColumn("source_key", key)
             .select("doc_id", "source", "size", "source_key", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
             .join(plan, "source_key"))

    # a row per document, pass and block; the last pass is cut where the target is met
    passes = F.greatest(F.ceil(F.col("words") / F.greatest("source_size", F.lit(1))).cast("int"), F.lit(1))
    blocks = (sizes.where("size > 0 and words > 0")
              .select("doc_id", "source_key", "size", "copy", "words", "source_size",
                      F.explode(F.sequence(F.lit(0), passes - 1)).alias("pass"))
              .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) div {block}"))).alias("block")))
    blocks = blocks.withColumns({
        "first": F.col("block") * block,
        "length": F.least(F.lit(block), F.col("size") - F.col("block") * block),
        "key": uniform64(seed, "pass", "doc_id", "copy", "block")})
    blocks = blocks.withColumn("bucket", F.shiftrightunsigned("key", 54).cast("int"))  # 1024 buckets
    order = Window.partitionBy("source_key", "pass", "bucket").orderBy("key", "doc_id", "copy", "size", "block")
    ranked = blocks.withColumns({
        "words_before": F.sum("length").over(order) - F.col("length"),
        "blocks_before": F.row_number().over(order) - 1})
    per_bucket = blocks.groupBy("source_key", "pass", "bucket").agg(
        F.sum("length").alias("bucket_words"), F.count(F.lit(1)).alias("bucket_blocks"))
    along = Window.partitionBy("source_key").orderBy("pass", "bucket")
    offsets = per_bucket.select("source_key", "pass", "bucket",
                                (F.sum("bucket_words").over(along) - F.col("bucket_words")).alias("words_offset"),
                                (F.sum("bucket_blocks").over(along) - F.col("bucket_blocks")).alias("blocks_offset"))
    drawn = (ranked.join(offsets, ["source_key", "pass", "bucket"])
             .withColumn("at", F.col("words_offset") + F.col("words_before"))
             .withColumn("drawn", F.least(F.col("length"), F.col("words") - F.col("at")))
             .where("drawn > 0")
             .select("doc_id", "source_key", "size", "copy", "pass", "block", "first", "drawn",
                     (F.col("blocks_offset") + F.col("blocks_before")).alias("rank")))
    drawn = written(drawn, "mix_drawn")
    quotas = drawn.groupBy("source_key").agg(F.count(F.lit(1)).alias("quota"))
    runs = written(quotas.coalesce(1).mapInPandas(_tree(shards, seed), "source_key string, ends array<long>"),
                   "mix_tree")
    placed = drawn.join(runs, "source_key").select(
        "doc_id", "source_key", "size", "copy", "pass", "block", "first", "drawn",
        # the ends of a source's shards ascend: count those at or before the rank
        F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"),
        uniform64(seed + 1, "pass", "doc_id", "copy", "block").alias("place"))
    return sizes, placed


def mix_report(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, size, source_size, target, taken, shards), a row per row: ``shards`` lists
    shard:words of every shard that takes from the document."""
    sizes, blocks = mixed_blocks(docs)
    # blocks of one document lie in several shards; their words add up
    taken = blocks.groupBy("shard", "doc_id", "source_key", "size", "copy").agg(F.sum("drawn").alias("t"))
    ids = ["doc_id", "source_key", "size", "copy"]
    every = sizes.select(*ids, "source_size", "target", F.lit(0).cast("long").alias("t"), F.lit(None).cast("int").alias("shard")
                         ).unionByName(taken.select(*ids, F.lit(None).cast("long").alias("source_size"),
                                                    F.lit(None).cast("double").alias("target"), "t", "shard"))
    from_shard = F.when(F.col("shard").isNotNull(), F.struct("shard", "t"))  # at most OUTPUT_SHARDS
    return every.groupBy(*ids).agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"),
        F.sum("t").alias("taken"), F.array_sort(F.collect_list(from_shard)).alias("s")).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["shard"], x["t"])), ",").alias("shards"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document taken twice is two
    rows, a partly taken one a row whose text holds the drawn words (space-joined,
    in order). ``n_chars``, where there is one, follows the text.

    A row lies where the tree has put its first drawn block: a task writes its rows by shard and by the
    block's random place in the shard, without another exchange of the texts."""
    _, blocks = mixed_blocks(docs)
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    drawn = blocks.groupBy(
        "doc_id", F.col("source_key").alias("_source_key"), F.col("size").alias("_size"),
        F.col("copy").alias("_copy"), "pass").agg(
        F.sum("drawn").alias("_drawn"), F.array_sort(F.collect_list(F.struct("first", "drawn"))).alias("_runs"),
        F.min_by(F.struct("shard", "place"), "first").alias("_at"))
    passes = drawn.groupBy(F.col("doc_id").alias("_id"), "_source_key", "_size", "_copy").agg(
        F.array_sort(F.collect_list(F.struct("pass", "_drawn", "_runs", "_at"))).alias("_passes"))  # three at most
    rows = docs.select("*", n_words().alias("_words"), key.alias("_key"))
    # rows of one doc_id, source and size are dealt their copies in the order of their texts
    same = Window.partitionBy("doc_id", "_key", "_words").orderBy(F.xxhash64("text"))
    rows = rows.withColumn("_nth", F.row_number().over(same))
    joined = rows.join(passes, rows["doc_id"].eqNullSafe(passes["_id"]) & (F.col("_key") == F.col("_source_key"))
                       & (F.col("_words") == F.col("_size")) & (F.col("_nth") == F.col("_copy")))
    out = joined.select(*[F.col(f"`{c}`") for c in docs.columns], "_words", F.explode("_passes").alias("_pass"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    cut = F.array_join(F.flatten(F.transform(
        "_pass._runs", lambda r: F.slice(words, (r["first"] + 1).cast("int"), r["drawn"].cast("int")))), " ")
    whole = F.col("_pass._drawn") == F.col("_words")
    changed = {"text": F.when(whole, F.col("text")).otherwise(cut)}
    out = out.withColumns(changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    at = [F.col("_pass._at.shard").alias("_shard"), F.col("_pass._at.place").alias("_place")]
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns], *at)
    return out.sortWithinPartitions("_shard", "_place").drop("_shard", "_place")


def op4_splitting_tree(spark, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir))
