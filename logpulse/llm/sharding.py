"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

Rows lie in logical partitions by a hash of doc_id. The matrix says how many
rows each partition sends to each shard: its row sums are the partition
sizes, its column sums the shard sizes (at most one apart), and it is drawn
from the distribution a uniform permutation would give. The draw goes down a
binary tree over the partitions: a node's shard vector is split between its
halves by a multivariate hypergeometric draw. Each partition then permutes
its rows and cuts the order at its matrix row, the rows are exchanged, and
every shard permutes what it got, in sub-ranges of a second hash whose counts
give the slots, so no task holds a shard.

A hypergeometric number is drawn by inverting its distribution function
around the mode, from the ratio of neighbouring probabilities; twelve
standard deviations hold all that a double can tell.

SQL functions only.

Defined cases: a null text has size 1 and the checksum of an empty one; empty
shards occur only with fewer rows than shards; null doc_ids share one
partition; repeated rows are separate rows; an empty table gives no rows;
other columns are carried by ``shuffled`` and dropped by the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import document_columns, documents, partitions, text_or_empty, uniform64, written

SHARDS = 8
SEED = 5150
ROWS_PER_PARTITION = 4096
#: One row holds the sizes of all partitions at the root of the tree.
MAX_PARTITIONS = 1 << 16


def _unit(seed: int, *cols: Column) -> Column:
    return uniform64(seed, *cols).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def hypergeometric(pop: Column, good: Column, n: Column, u: Column) -> Column:
    """How many of ``n`` draws from ``pop`` without return are among the ``good``; u uniform in [0, 1)."""
    low = F.greatest(F.lit(0).cast("long"), n + good - pop)
    high = F.least(good, n)
    share = good / F.greatest(pop, F.lit(1))
    sd = F.sqrt(F.greatest(n * share * (1 - share) * (pop - n) / F.greatest(pop - 1, F.lit(1)), F.lit(0.0)))
    mode = F.floor((n + 1.0) * (good + 1.0) / (pop + 2.0))
    reach = F.ceil(12 * sd) + 12
    a = F.least(F.greatest(low, mode - reach), high)
    b = F.greatest(F.least(high, mode + reach), a)

    def up(w: Column, k: Column) -> Column:  # weight of k + 1 from that of k
        return w * (good - k) * (n - k) / ((k + 1.0) * F.greatest(pop - good - n + k + 1, F.lit(1)))

    one = F.lit(1.0)
    total = F.aggregate(F.sequence(a, b), F.struct(one.alias("w"), F.lit(0.0).alias("sum")),
                        lambda acc, k: F.struct(up(acc["w"], k).alias("w"), (acc["sum"] + acc["w"]).alias("sum")),
                        lambda acc: acc["sum"])
    def below(target: Column) -> Column:  # numbers whose distribution function stays under the target
        return F.aggregate(
            F.sequence(a, b), F.struct(one.alias("w"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("below")),
            lambda acc, k: F.struct(up(acc["w"], k).alias("w"), (acc["sum"] + acc["w"]).alias("sum"),
                                    (acc["below"] + F.when(acc["sum"] + acc["w"] <= target, 1).otherwise(0))
                                    .alias("below")),
            lambda acc: acc["below"])

    # the one-element array computes the total once, not in every step
    return F.least(a + F.transform(F.array(u * total), below)[0], b)


def split_vector(vector: str, n: Column, shards: int, seed: int, *name: Column) -> Column:
    """Multivariate draw of ``n`` from the counts in column ``vector``."""
    left, pop = n, F.aggregate(vector, F.lit(0).cast("long"), lambda a, x: a + x)

    def step(acc: Column, k: Column) -> Column:
        good = F.get(vector, k)
        x = F.when(acc["pop"] == good, acc["n"]).otherwise(
            hypergeometric(acc["pop"], good, acc["n"], _unit(seed, *name, k)))
        # x is read three times; a one-element array keeps it computed once
        return F.transform(F.array(x), lambda v: F.struct(
            (acc["n"] - v).alias("n"), (acc["pop"] - good).alias("pop"),
            F.concat(acc["out"], F.array(v)).alias("out")))[0]

    start = F.struct(left.alias("n"), pop.alias("pop"), F.expr("cast(array() as array<bigint>)").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, step, lambda acc: acc["out"])


def communication_matrix(sizes: DataFrame, n_rows: int, n_partitions: int, shards: int, seed: int) -> DataFrame:
    """(part, n) for some parts of 0..n_partitions-1 (a power of two) -> (part, ends):
    running totals of the rows each part sends to shards 0, 1, ..."""
    spark = sizes.sparkSession
    quota = [n_rows // shards + (k < n_rows % shards) for k in range(shards)]
    every = (spark.range(n_partitions).withColumnRenamed("id", "part").join(sizes, "part", "left")
             .select("part", F.coalesce("n", F.lit(0).cast("long")).alias("n")))
    nodes = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "n"))), lambda s: s["n"])
                      .alias("counts")).select(
        F.lit(0).cast("long").alias("first"), "counts",
        F.array(*[F.lit(q).cast("long") for q in quota]).alias("vector"))
    width, level = n_partitions, 0
    while width > 1:
        half = width // 2
        if level == 6:
            nodes = nodes.repartition(partitions(spark))
        n_left = F.aggregate(F.slice("counts", 1, half), F.lit(0).cast("long"), lambda a, x: a + x)
        nodes = nodes.withColumn("left", split_vector("vector", n_left, shards, seed, F.lit(level), F.col("first")))
        nodes = nodes.select(F.explode(F.array(
            F.struct("first", F.slice("counts", 1, half).alias("counts"), F.col("left").alias("vector")),
            F.struct((F.col("first") + half).alias("first"), F.slice("counts", half + 1, half).alias("counts"),
                     F.zip_with("vector", "left", lambda v, x: v - x).alias("vector")))).alias("node")).select("node.*")
        width, level = half, level + 1
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda k: F.aggregate(
        F.slice("vector", F.lit(1), k), F.lit(0).cast("long"), lambda a, x: a + x))
    return nodes.select(F.col("first").alias("part"), ends.alias("ends"))


def shuffled(rows: DataFrame, shards: int = SHARDS, seed: int = SEED,
             rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Adds shard (0..shards-1) and slot (gapless from 0) to rows with a doc_id.

    ``rows`` should be cheap to read again or written: it is counted first."""
    n_rows = rows.count()
    n_partitions = 1
    while n_partitions * rows_per_partition < n_rows and n_partitions < MAX_PARTITIONS:
        n_partitions *= 2
    cols = [F.col(f"`{c}`") for c in rows.columns]
    data = rows.select(F.struct(*cols).alias("row"), rows["doc_id"].alias("doc_id")).select(
        "row", uniform64(seed, "doc_id").bitwiseAND(F.lit(n_partitions - 1)).alias("part"),
        F.xxhash64(F.lit(seed + 1), "row").alias("first_key"), F.xxhash64(F.lit(seed + 2), "row").alias("second_key"))
    sizes = data.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    matrix = written(communication_matrix(sizes, n_rows, n_partitions, shards, seed), "shard_matrix")
    local = Window.partitionBy("part").orderBy("first_key", "row")
    sent = (data.withColumn("rank", F.row_number().over(local) - 1)
            .join(F.broadcast(matrix), "part")  # at most 65,536 rows of nine numbers
            .select("row", "second_key", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard")))
    bits = max(1, n_partitions.bit_length() - 1)
    sent = written(sent.withColumn("range", F.shiftrightunsigned("second_key", 64 - bits)), "shard_rows")
    per_range = sent.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("range")
    offsets = per_range.select("shard", "range", (F.sum("n").over(before) - F.col("n")).alias("offset"))
    again = Window.partitionBy("shard", "range").orderBy("second_key", "row")
    return (sent.withColumn("at", F.row_number().over(again) - 1).join(offsets, ["shard", "range"])
            .select("row.*", F.col("shard").cast("int").alias("shard"),
                    (F.col("offset") + F.col("at")).alias("slot")))


def op5_communication_matrix(spark, sf_dir: str) -> DataFrame:
    text = text_or_empty()
    rows = written(document_columns(documents(spark, sf_dir), "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")), "shard_sizes")
    return shuffled(rows).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                 F.lit(None).cast("int").alias("grown_shard"))
