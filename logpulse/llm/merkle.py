"""Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf. Per language the leaves stand in order of doc_id; each two
consecutive nodes become one, up to the language's subroot, and the subroots
likewise become the root.

Nodes keep the place of their first leaf. At level k the rows whose place is
divisible by 2^k hold the nodes, so a node's sibling is 2^k rows ahead (even
slot) or behind (odd slot): a lead and a lag column of fixed offset, masked by
slot, by level (a language with no more than 2^k leaves has its subroot
already) and by the length of the last run. The first child's row hashes the
parent. ``LEVELS`` levels are climbed in one window over (language, block of
2^LEVELS places): one shuffle, one sort, bounded memory, and no language is held
by one task. The blocks' tops are the leaves of the next round, a table smaller
by 2^LEVELS; rounds grow with the logarithm of the rows. Paths come down
the same way: a row takes the siblings of its block's nodes (the last ones seen
at or before its place) and its block's path from the round above.

Places are counted from a range partitioning by (language, doc_id, leaf, row) and
the number of rows per partition, without a window over a language. The row number
breaks ties, so that one doc_id, or one row repeated, may hold any share.

Defined cases: nulls hash as ``-``; null doc_ids come first and are never
tampered with; rows with one doc_id follow in order of their leaves, and equal rows
are leaves each; empty and very long texts hash whole; a language with one row
has its leaf as subroot, one language its subroot as root; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import document_columns, documents, written

#: Levels climbed by one window; blocks of 2^LEVELS rows, about 1 MB each.
LEVELS = 10
TAMPER_EVERY = 7

_STEP = "struct<left:string,right:string>"
_NO_STEPS = f"cast(array() as array<{_STEP}>)"


def _field(c: Column) -> Column:
    """``-`` or the value with its number of UTF-8 bytes before it."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def _leaf(n_chars: Column) -> Column:
    return F.sha2(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang")],
                           _field(n_chars), _field(F.col("text"))), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """documents -> (g, doc_id, leaf, shown, row): ``g`` orders languages, null first;
    ``shown`` is the leaf of a row that was tampered with, else null."""
    d = document_columns(docs, "doc_id", "source", "lang", "n_chars", "text")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0, F.lit(False))
    more = F.col("n_chars").cast("decimal(20,0)") + F.lit(1).cast("decimal(20,0)")  # no overflow
    return d.select(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("g"), "doc_id",
                    _leaf(F.col("n_chars")).alias("leaf"), F.when(hit, _leaf(more)).alias("shown"),
                    F.monotonically_increasing_id().alias("row"))


def placed(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """Rows with ``pos``, their place from 0 in their group ``g`` by ``order``, and ``n``, the
    group's rows; and the largest n."""
    at = written(rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
                 .withColumn("at", F.monotonically_increasing_id()), "merkle_sorted")
    at = at.withColumn("pid", F.shiftright("at", 33))
    parts = at.groupBy("pid", "g").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("g")
    starts = written(parts.select(
        "pid", "g", (F.sum("rows").over(whole.orderBy("pid")) - F.col("rows") - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n")), "merkle_starts")  # a row per partition and group
    most = starts.agg(F.max("n")).first()[0] or 0
    return at.join(starts, ["pid", "g"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "pid", "shift"), most


def _climbed(nodes: DataFrame) -> DataFrame:
    """Nodes (g, pos, n, digest) with their ``block``, ``s0``.. (the sibling, empty if there is
    none, on rows that hold a node of the level) and ``top``, on a block's first row."""
    d = nodes.withColumns({"block": F.shiftright("pos", LEVELS), "top": F.col("digest")})
    window = Window.partitionBy("g", "block").orderBy("pos")
    for k in range(LEVELS):
        run = 1 << k
        node = F.col("top")
        open_ = F.col("n") > run
        ahead = F.col("pos").bitwiseAND(F.lit(run)) == 0
        sibling = F.coalesce(F.when(ahead, F.lead(node, run).over(window)).otherwise(F.lag(node, run).over(window)), F.lit(""))
        d = d.withColumn(f"s{k}", F.when((F.col("pos").bitwiseAND(F.lit(run - 1)) == 0) & open_, sibling))
        d = d.withColumn("top", F.when(F.col("pos").bitwiseAND(F.lit(2 * run - 1)) == 0,
                                       F.when(open_, F.sha2(F.concat(node, F.col(f"s{k}")), 256)).otherwise(node)))
    return d


def rounds(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The nodes, then the tops of their blocks, and so on until every group has one top."""
    out = [nodes]
    while True:
        tops = _climbed(out[-1]).where(F.col("pos").bitwiseAND(F.lit((1 << LEVELS) - 1)) == 0)
        out.append(written(tops.select("g", F.col("block").alias("pos"), F.col("top").alias("digest"),
                                       F.ceil(F.col("n") / (1 << LEVELS)).cast("long").alias("n")), "merkle_tops"))
        if most <= 1 << LEVELS:
            return out
        most = -(-most >> LEVELS)


def descended(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths from ``above`` ((g, pos, path, ...) of the last table) down to the first table's rows."""
    for nodes in levels[-2::-1]:
        seen = Window.partitionBy("g", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        d = _climbed(nodes).drop("top")
        d = d.withColumns({f"s{k}": F.last(f"s{k}", ignorenulls=True).over(seen) for k in range(LEVELS)})
        steps = []
        for k in range(LEVELS):
            ahead = F.col("pos").bitwiseAND(F.lit(1 << k)) == 0
            steps.append(F.when(F.col(f"s{k}").isNotNull(), F.struct(
                F.when(ahead, "").otherwise(F.col(f"s{k}")).alias("left"),
                F.when(ahead, F.col(f"s{k}")).otherwise("").alias("right"))))
        own = d.withColumn("own", F.filter(F.array(*steps), lambda s: s.isNotNull())).drop(*[f"s{k}" for k in range(LEVELS)])
        up = above.withColumnsRenamed({"pos": "block", "path": "up"}).drop("digest", "n")
        above = (own.join(up, ["g", "block"]).withColumn("path", F.concat("own", "up")).drop("own", "up", "block"))
    return above


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, leaf, shown, subroot, root, path), a row per row; ``path`` lists what
    stands left and right of the node at each level, at most one of them."""
    table = written(leaves(docs), "merkle_leaves")
    nodes, most = placed(table, "doc_id", "leaf", "row")
    tree = rounds(nodes.select("g", "pos", "n", "doc_id", F.col("leaf").alias("digest"), "shown"), most)
    subroots = tree[-1].select(F.lit("").alias("g"), F.col("g").alias("own_g"), F.col("digest"))
    langs, most = placed(subroots, "own_g")
    upper = rounds(langs, most)
    root = upper[-1].select("g", "pos", F.expr(_NO_STEPS).alias("path"), F.col("digest").alias("root"))
    langs = descended(upper, root).select(F.col("own_g").alias("g"), "path", "root", F.col("digest").alias("subroot"))
    above = tree[-1].join(langs, "g")  # a row per language
    return descended(tree, above).select("doc_id", F.col("digest").alias("leaf"), "shown", "subroot", "root", "path")


def op13_lag_lead_merkle(spark, sf_dir: str) -> DataFrame:
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    m = manifest(documents(spark, sf_dir)).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
        folded(F.coalesce("shown", "leaf")).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))
