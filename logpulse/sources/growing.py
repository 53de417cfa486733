"""Log files that grow, rotate and are truncated, read once line by line.

Spark's file streams take a file once, when it appears. :class:`LineLedger` keeps, per
file, how many bytes of whole lines were taken; a poll lists the files, scans those
that changed, and takes the lines from there on. Lines end at line feeds, so a
line's place is exact: within a split of the file it is a running sum of line
lengths (splits are read in order), and a split's first line starts where the splits
before it end.

A file is known again by its content, not only by its name: the ledger keeps a
checksum of the lines taken, and a file continues its own entry only if its first
bytes still are those lines. Otherwise it was replaced, and is read from its start,
unless its first bytes are what was taken under a name that has gone or was replaced
(a rotated file): then it continues that entry. So nothing is taken twice by
renaming and nothing is lost by truncating.

A line without its line feed is left until it is whole, or until two polls in a row find
the file at the same size; what is added to it after that is a line of its own. A file that
is emptied or gone loses its entry. What a poll takes is written before the ledger moves on,
and the ledger is published as a whole, so a poll that fails is run again in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logpulse.functions.text import repaired
from logpulse.sources.published import publish, published_version, read_published

LEDGER_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("taken", T.LongType()),       # bytes of whole lines taken, from the file's start
    T.StructField("checksum", T.LongType()),    # of those lines and their places
    T.StructField("head", T.LongType()),        # of the first of them
    T.StructField("open_bytes", T.LongType()),  # taken of the line after them, which had no line feed
    T.StructField("size", T.LongType()),        # when last listed, and so is the time
    T.StructField("modified", T.TimestampType()),
])
LINE_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("line_bytes", T.LongType()),  # with the line feed
    T.StructField("line", T.BinaryType()),
    T.StructField("skip", T.LongType()),        # bytes of the line taken before
    T.StructField("whole", T.BooleanType()),
])


def list_files(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """(file_path, size, modified) of the matching files below ``path``; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .load(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size"),
                               F.col("_metadata.file_modification_time").alias("modified")))


_PLACED = "file_path string, block long, place long, line_bytes long, line binary"


def _place_in_split():
    """Lines of a task in order -> the bytes of the same split before each.

    Made here, so that it goes to the workers by value: they need no package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            path = batch["file_path"].dictionary_encode()
            code, block = path.indices.to_numpy(zero_copy_only=False), batch["block"].to_numpy(zero_copy_only=False)
            size = pc.binary_length(batch["line"]).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            new = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (block[1:] != block[:-1])])
            before = np.cumsum(size) - size
            first = (path.dictionary[int(code[0])].as_py(), int(block[0]))
            base = before[new]
            if first == last:
                base[0] -= done  # the split goes on from the batch before
            place = before - np.repeat(base, np.diff(np.r_[new, n]))
            last, done = (path.dictionary[int(code[-1])].as_py(), int(block[-1])), int(place[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([batch["file_path"], batch["block"], pa.array(place), pa.array(size), batch["line"]],
                                             names=["file_path", "block", "place", "line_bytes", "line"])

    return run


#: Up to so many changed files are named to the scan, which then opens no other; of more, the lines of others are dropped.
NAMED_FILES = 5_000


def placed_lines(spark: SparkSession, path: str, glob: str, changed: DataFrame) -> DataFrame:
    """(file_path, start, line_bytes, line) of the files in ``changed``: raw lines and where in the file they begin."""
    names = changed.select("file_path")
    files = [r["file_path"] for r in names.limit(NAMED_FILES + 1).collect()]
    named = len(files) <= NAMED_FILES
    # only the line feed ends a line here, so that lengths add up; other ends are cut afterwards
    lines = (spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .text(path))
    raw = (lines.where(F.col("_metadata.file_path").isin(files)) if named else lines).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    splits = raw.groupBy("file_path", "block").agg(F.sum(F.octet_length("line") + 1).alias("bytes"))
    along = Window.partitionBy("file_path").orderBy("block")
    starts = splits.select("file_path", "block", (F.sum("bytes").over(along) - F.col("bytes")).alias("from"))
    placed = raw.mapInArrow(_place_in_split(), _PLACED).join(starts, ["file_path", "block"])  # placed in the order of the scan
    return ((placed if named else placed.join(names, "file_path", "left_semi"))
            .select("file_path", (F.col("from") + F.col("place")).alias("start"), "line_bytes", "line"))


def _line_sum() -> Column:
    return F.xxhash64("start", "line")


def log_lines(lines: DataFrame) -> DataFrame:
    """Taken lines as :func:`logpulse.sources.logs.read_log_lines` gives them: damaged bytes
    repaired, and cut at carriage returns too. (file_path, value)"""
    fresh = lines.where((F.col("skip") == 0) | (F.octet_length("line") > F.col("skip")))
    rest = F.substring("line", (F.col("skip") + 1).cast("int"), F.octet_length("line"))
    text = F.regexp_replace(repaired(rest), "\r$", "")
    return fresh.select("file_path", F.explode(F.split(text, "\r")).alias("value"))


class LineLedger:
    """What was taken from the log files below a folder; kept below ``path`` in the shared store."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._next: DataFrame | None = None

    def version(self) -> int:
        """How many polls were committed."""
        return published_version(self.spark, f"{self.path}/ledger")

    def entries(self) -> DataFrame:
        if not self.version():
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return read_published(self.spark, f"{self.path}/ledger", "files", LEDGER_SCHEMA)

    def _written(self, df: DataFrame, name: str, version: int) -> DataFrame:
        path = f"{self.path}/{name}/turn={version % 2}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _verified(self, placed: DataFrame, claims: DataFrame) -> DataFrame:
        """Of the claims (a file, and an entry ``of`` that it may go on from) those whose file begins with the lines taken."""
        found = (placed.join(claims.select("file_path", "of", "taken"), "file_path").where(F.col("start") < F.col("taken"))
                 .groupBy("file_path", "of").agg(F.bit_xor(_line_sum()).alias("got"),
                                                 F.max(F.col("start") + F.col("line_bytes")).alias("until")))
        return (claims.join(found, ["file_path", "of"])
                .where((F.col("got") == F.col("checksum")) & (F.col("until") == F.col("taken"))).drop("got", "until"))

    def _starts(self, placed: DataFrame, listed: DataFrame, changed: DataFrame, version: int) -> DataFrame:
        """(file_path, of, taken, checksum, head, open_bytes): the entries that changed files go on from."""
        entry = ["taken", "checksum", "head", "open_bytes"]
        own = changed.where("taken > 0 and now > 0").select("file_path", F.col("file_path").alias("of"), *entry)
        held = own if own.isEmpty() else self._verified(placed, own)
        held = self._written(held, "held", version)
        # entries whose file has gone or was replaced may go on under another name
        at_rest = listed.where("rested").select(F.col("file_path").alias("of"))
        free = (listed.where("taken > 0").select(F.col("file_path").alias("of"), *entry)
                .join(held.select("of").unionByName(at_rest), "of", "left_anti"))
        strangers = changed.where("now > 0").join(held, "file_path", "left_anti").select("file_path")
        if free.isEmpty() or strangers.isEmpty():
            return held
        heads = placed.where("start = 0").select("file_path", F.xxhash64("line").alias("head"))
        moved = self._verified(placed, strangers.join(heads, "file_path").join(free, "head"))
        best = Window.partitionBy("file_path").orderBy(F.col("taken").desc(), "of")
        moved = moved.withColumn("nth", F.row_number().over(best)).where("nth = 1").drop("nth")
        return self._written(held.unionByName(moved), "starts", version)

    def poll(self, log_dir: str, glob: str = "*.log") -> tuple[int, DataFrame]:
        """The next version's number and its lines (LINE_SCHEMA, written; see :func:`log_lines`).

        :meth:`commit` moves the ledger on; until then a poll gives the same version anew."""
        spark, version = self.spark, self.version() + 1
        now = list_files(spark, log_dir, glob).select(
            "file_path", F.col("size").alias("now"), F.col("modified").alias("now_modified"))
        # one listing for all that follows
        listed = self._written(now.join(self.entries(), "file_path", "full"), "listed", version)
        rested = F.col("now").isNotNull() & (F.col("now") == F.col("taken") + F.col("open_bytes")) & (
            F.col("now_modified") == F.col("modified"))
        listed = listed.withColumn("rested", F.coalesce(rested, F.lit(False)))
        changed = listed.where("now is not null and not rested")
        placed = placed_lines(spark, log_dir, glob, changed.where("now > 0"))
        starts = self._starts(placed, listed, changed, version)

        state = changed.select("file_path", "now", F.col("size").eqNullSafe(F.col("now")).alias("quiet"))
        zero = F.lit(0).cast("long")
        began = starts.select("file_path", F.col("taken").alias("from"), "open_bytes")
        after = placed.join(began, "file_path", "left").join(state, "file_path").withColumns({
            "from": F.coalesce("from", zero), "skip": F.when(F.col("start") == F.col("from"), F.col("open_bytes")),
            "whole": F.col("start") + F.col("line_bytes") <= F.col("now")}).withColumn("skip", F.coalesce("skip", zero))
        left_open = (F.col("quiet") & (F.col("start") + F.col("line_bytes") == F.col("now") + 1)
                     & (F.col("line_bytes") - 1 > F.col("skip")))
        new = after.where((F.col("start") >= F.col("from")) & (F.col("whole") | left_open)).select(*LINE_SCHEMA.names)
        lines = self._written(new, "lines", version)

        whole = lambda c: F.when(F.col("whole"), c)
        sums = lines.groupBy("file_path").agg(
            F.bit_xor(whole(_line_sum())).alias("more"), F.max(whole(F.col("start") + F.col("line_bytes"))).alias("until"),
            F.max(F.when(~F.col("whole"), F.col("line_bytes") - 1)).alias("opened"),
            F.max(whole(F.when(F.col("start") == 0, F.xxhash64("line")))).alias("first"))
        rest = listed.where("now is not null").join(changed.select("file_path"), "file_path", "left_anti")
        moved_on = (changed.select("file_path", "now", F.col("now_modified").alias("modified")).join(starts, "file_path", "left").join(sums, "file_path", "left")
                    .select("file_path", F.coalesce("until", "taken", zero).alias("taken"),
                            F.coalesce("checksum", zero).bitwiseXOR(F.coalesce("more", zero)).alias("checksum"),
                            F.coalesce("head", "first").alias("head"),
                            F.coalesce("opened", F.when(F.col("until").isNull(), F.col("open_bytes")), zero).alias("open_bytes"),
                            F.col("now").alias("size"), "modified"))
        self._next = moved_on.unionByName(rest.select("file_path", "taken", "checksum", "head", "open_bytes",
                                                      F.col("now").alias("size"), "modified"))
        return version, lines

    def commit(self) -> int:
        """The lines of the last poll count as taken."""
        if self._next is None:
            raise ValueError("poll first")
        version = publish(self.spark, f"{self.path}/ledger", {"files": self._next.select(*LEDGER_SCHEMA.names)})
        self._next = None
        return version
