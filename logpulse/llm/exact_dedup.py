"""Exact deduplication by content sort.

Splitters sampled by Spark range-partition the normalised texts; each
partition is sorted on disk, so equal texts are neighbours, and a pass over
the sorted rows compares each full text with the one before. A group of
equal texts may cross partition borders (a third of all rows may be one
text): the range key ends in ``doc_id``, so such a group is dealt to as many
partitions as its size asks for, and the few groups that touch a border are
joined afterwards from two rows per partition.

The range key is (first bytes, SHA-256, doc_id) of the normalised text, so a
splitter has a fixed size however long the texts are; the order inside a
partition is (first bytes, SHA-256, whole text, doc_id).

Defined cases: a null text counts as empty; empty texts equal each other;
texts are compared whole; of repeated rows with one doc_id and equal texts
exactly one is kept (equal range keys never part, so they meet in one run);
null doc_ids sort last and stay only if their group has no other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import document_columns, documents, text_or_empty, written

HEAD_CHARS = 64
NO_ID = 2**63 - 1

_RUNS = ("doc_id long, text_sha256 string, pid int, run long, keep_id long, group_size long,"
         " first_of_run boolean, edge string, edge_text string")


def normalised(col: str = "text") -> F.Column:
    return F.regexp_replace(text_or_empty(col), r"[\x20\x09-\x0D]+", " ")


def _mark_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, sha, norm) rows -> one row per document with its run of equal
    neighbours. Only the ids of the current run are held."""
    ctx = TaskContext.get()
    pid = ctx.partitionId() if ctx else 0
    text = sha = None
    ids: list[int] = []
    run = 0
    names = [f.split()[0] for f in _RUNS.split(", ")]
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("pid", pa.int32()),
                        ("run", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()),
                        ("first_of_run", pa.bool_()), ("edge", pa.string()),
                        ("edge_text", pa.string())])
    assert schema.names == names
    out: list[list] = [[] for _ in names]

    def close(last: bool) -> None:
        """The run is over; its ids are sorted. The first and last run of a partition keep their text."""
        edge = ("both" if last else "first") if run == 0 else ("last" if last else None)
        for i, d in enumerate(ids):
            row = (None if d == NO_ID else d, sha, pid, run, ids[0], len(ids), i == 0,
                   edge if i == 0 else None, text if edge and i == 0 else None)
            for values, v in zip(out, row, strict=True):
                values.append(v)

    def flush() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)],
                                schema=schema)
        for v in out:
            v.clear()
        return batch

    for batch in batches:
        for d, s, t in zip(batch["id"].to_pylist(), batch["sha"].to_pylist(),
                           batch["norm"].to_pylist(), strict=True):
            if ids and t == text:
                ids.append(d)
                continue
            if ids:
                close(False)
                run += 1
            text, sha, ids = t, s, [d]
        if len(out[0]) >= 4096:
            yield flush()
    if ids:
        close(True)
        yield flush()


def exact_groups(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, keep_id, group_size, kept, text_sha256, stays), a row per row."""
    norm = document_columns(docs, "doc_id", "text").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), normalised().alias("norm"))
    keyed = norm.select("id", "norm", F.substring("norm", 1, HEAD_CHARS).alias("head"),
                        F.sha2("norm", 256).alias("sha"))
    ranged = (keyed.repartitionByRange("head", "sha", "id")
              .sortWithinPartitions("head", "sha", "norm", "id").select("id", "sha", "norm"))
    runs = written(ranged.mapInArrow(_mark_runs, _RUNS), "exact_runs")

    # Two segments per partition at most: its first and its last run, in order.
    edges = runs.where("edge is not null").select("pid", "run", "keep_id", "group_size",
                                                  "text_sha256", "edge_text")
    order = Window.orderBy("pid", "run")
    before = edges.select("pid", "run").withColumns({
        "pid_before": F.lag("pid").over(order), "run_before": F.lag("run").over(order)})
    same = (before.alias("b")
            .join(edges.alias("e"), ["pid", "run"])
            .join(edges.select(F.col("pid").alias("pid_before"), F.col("run").alias("run_before"),
                               F.col("edge_text").alias("text_before")),
                  ["pid_before", "run_before"], "left")
            .select("pid", "run", "keep_id", "group_size",
                    F.coalesce(F.col("edge_text") == F.col("text_before"), F.lit(False))
                    .alias("joined")))
    chains = same.withColumn("chain", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(order))
    whole = Window.partitionBy("chain")
    crossing = (chains.withColumns({"n": F.count(F.lit(1)).over(whole),
                                    "chain_keep": F.min("keep_id").over(whole),
                                    "chain_size": F.sum("group_size").over(whole)})
                .where("n > 1")
                .select(F.col("pid").alias("c_pid"), F.col("run").alias("c_run"),
                        "chain_keep", "chain_size"))
    # at most two rows per partition, whatever the data: a proven bound
    joined = runs.join(F.broadcast(crossing),
                       (runs["pid"] == crossing["c_pid"]) & (runs["run"] == crossing["c_run"]), "left")
    keep = F.coalesce("chain_keep", "keep_id")
    own = F.coalesce("doc_id", F.lit(NO_ID))
    return joined.select(
        "doc_id", F.nullif(keep, F.lit(NO_ID)).alias("keep_id"),
        F.coalesce("chain_size", "group_size").alias("group_size"),
        (F.col("first_of_run") & (own == keep)).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of equal texts the one with the smallest doc_id."""
    kept = exact_groups(docs).where("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    keyed = docs.withColumn("_sha", F.sha2(normalised(), 256))
    return (keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["_kept_id"])
                       & (keyed["_sha"] == kept["_kept_sha"]), "left_semi")
            .dropDuplicates(["doc_id", "_sha"]).select(*[F.col(f"`{c}`") for c in docs.columns]))


def op10_content_sort(spark, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))
